"""Pluggable models inside vectorised functions.

A model is given as a function without arguments that builds it. Each Python worker calls
it once per task and then feeds it Arrow batches, so any encoder, classifier or generator
with the small interfaces below can be used. The defaults need no downloads.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import chain
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from tallyloom.functions.batches import few_rows
from tallyloom.functions.vectors import SCORE_DIGITS

# The width of the default vectors and the length of generated answers.
DEFAULT_DIM = 384
MAX_ANSWER_TOKENS = 300
# Texts that are given to an encoder at a time.
ENCODED_TEXTS = 256
# Labelled texts that a classifier is fitted on, at most.
MAX_EXAMPLES = 1000

# Letters and digits of any script; ASCII punctuation and blanks separate words.
WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


class Encoder(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray: ...


class Classifier(Protocol):
    def classify(self, texts: list[str]) -> list[str]: ...


class Generator(Protocol):
    def generate(self, prompts: list[list[dict]], max_tokens: int) -> list[str]: ...


def word_bucket(word: str, dim: int) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim


class HashingEncoder:
    """Feature hashing: word counts folded into ``dim`` buckets, scaled to unit length."""

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim = dim
        self.bucket = lru_cache(maxsize=1 << 18)(partial(word_bucket, dim=dim))

    def encode(self, texts: list[str]) -> np.ndarray:
        words = [WORD.findall((text or "").lower()) for text in texts]
        row = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        bucket = np.fromiter(map(self.bucket, chain.from_iterable(words)), np.int64, len(row))
        out = np.bincount(row * self.dim + bucket, minlength=len(texts) * self.dim).reshape(len(texts), self.dim).astype(float)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(length == 0, 1.0, length)).astype(np.float32)


class NearestExample:
    """The label of the example that is closest to the text by cosine; among equally close ones the
    first. ``examples`` are (text, label) pairs, up to ``MAX_EXAMPLES`` of them."""

    def __init__(self, examples: list[tuple[str, str]], encoder: Encoder | None = None):
        if not examples or len(examples) > MAX_EXAMPLES:
            raise ValueError(f"give between 1 and {MAX_EXAMPLES} labelled examples")
        self.encoder = encoder or HashingEncoder()
        self.labels = [label for _, label in examples]
        self.known = self.encoder.encode([text for text, _ in examples]).astype(float)

    def classify(self, texts: list[str]) -> list[str]:
        scores = np.round(self.encoder.encode(texts).astype(float) @ self.known.T, SCORE_DIGITS)
        return [self.labels[i] for i in scores.argmax(axis=1)]


class ExtractiveAnswer:
    """Answers with the sentence of the context that shares most words with the question."""

    def generate(self, prompts: list[list[dict]], max_tokens: int) -> list[str]:
        return [self._answer(messages[-1]["content"], max_tokens) for messages in prompts]

    def _answer(self, content: str, max_tokens: int) -> str:
        context, _, question = content.rpartition("Question:")
        wanted = set(WORD.findall(question.lower()))
        sentences = re.split(r"(?<=[.!?])\s+|\n+", context or content)
        best = max(sentences, key=lambda s: len(wanted & set(WORD.findall(s.lower()))))
        return " ".join(best.split()[:max_tokens])


def embed(text: Column, make_encoder: Callable[[], Encoder] = HashingEncoder) -> Column:
    """The vector of a text, ARRAY<FLOAT>."""

    @F.arrow_udf("array<float>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = make_encoder()
        for texts in batches:
            # A few texts at a time: words and counts take many times the room of vectors.
            parts = [np.asarray(encoder.encode(few.to_pylist()), dtype=np.float32) for few in few_rows([texts], ENCODED_TEXTS)]
            vectors = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
            width = vectors.shape[1] if vectors.size else 0
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * width
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    return encoded(text)


def classify(text: Column, examples: list[tuple[str, str]], make_classifier: Callable[..., Classifier] = NearestExample) -> Column:
    """The label that fits a text best, learnt from (text, label) examples."""
    make_classifier(examples)  # fails here rather than in tasks

    @F.arrow_udf("string")
    def classified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make_classifier(examples)
        for texts in batches:
            yield pa.array(model.classify(texts.to_pylist()), pa.string())

    return classified(text)


def generate(messages: Column, make_generator: Callable[[], Generator] = ExtractiveAnswer,
             max_tokens: int = MAX_ANSWER_TOKENS) -> Column:
    """The text a model writes for an array of (role, content) messages."""

    @F.arrow_udf("string")
    def generated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make_generator()
        for prompts in batches:
            yield pa.array(model.generate(prompts.to_pylist(), max_tokens), pa.string())

    return generated(messages)

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyloom.functions import models
from tallyloom.operators.context import INSTRUCTION, NOTHING_FOUND, answer, assemble_context, prompt_rows


def test_context_prompt_answer(spark):
    hits = spark.createDataFrame([(1, 2, 0.5, "b.pdf", 7, "Second."), (1, 1, 0.876, "a.pdf", 3, "Cats sleep. Dogs bark loudly.")],
                                 "query_id INT, rank INT, score DOUBLE, source_file STRING, page_number INT, content STRING")
    asked = spark.createDataFrame([(1, "Do dogs bark?"), (2, "Why?")], "query_id INT, text STRING")
    plain = {r.query_id: r.context for r in assemble_context(hits, asked).collect()}
    assert plain == {1: "[a.pdf, page 3]\nCats sleep. Dogs bark loudly.\n\n[b.pdf, page 7]\nSecond.", 2: NOTHING_FOUND}
    scored = {r.query_id: r.context for r in assemble_context(hits, asked, True).collect()}
    assert scored[1].startswith("[a.pdf, page 3, relevance 0.88]\n")
    prompts = prompt_rows(assemble_context(hits, asked), asked)
    messages = {r.query_id: r.messages for r in prompts.collect()}
    assert [(m.role, m.content) for m in messages[1]] == [
        ("system", INSTRUCTION), ("user", f"Context:\n{plain[1]}\n\nQuestion: Do dogs bark?")]
    assert {r.query_id: r.answer for r in answer(prompts).collect()}[1] == "Dogs bark loudly."


class Fixed:
    """A model of one's own."""

    def encode(self, texts):
        return np.array([[len(t), 1.0] for t in texts])

    def __init__(self, examples=()):
        self.labels = [label for _, label in examples]

    def classify(self, texts):
        return [self.labels[len(t) % len(self.labels)] for t in texts]

    def generate(self, prompts, max_tokens):
        return [f"{m[-1]['content']}/{max_tokens}" for m in prompts]


def test_models_can_be_plugged_in(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the test
    df = spark.createDataFrame([("abc",), ("",)], "t STRING")
    assert [r.v for r in df.select(models.embed(F.col("t"), Fixed).alias("v")).collect()] == [[3.0, 1.0], [0.0, 1.0]]
    assert [r.c for r in df.select(models.classify(F.col("t"), [("p", "x"), ("q", "y")], Fixed).alias("c")).collect()] == ["y", "x"]
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content")))
    assert [r.g for r in df.select(models.generate(messages, Fixed, 5).alias("g")).collect()] == ["abc/5", "/5"]


def test_default_encoder():
    e = models.HashingEncoder(16)
    a, b, none = e.encode(["The dog, the DOG!", "dog the the dog", ""])
    assert np.allclose(a, b) and np.isclose(np.linalg.norm(a), 1) and not none.any()


def test_classifier_reads_the_text(spark):
    examples = [("stock is low, order now", "urgent"), ("plenty left on the shelf", "calm"), ("order now", "urgent")]
    df = spark.createDataFrame([("please order now",), ("plenty on the shelf",), (None,)], "t STRING")
    assert [r.c for r in df.select(models.classify(F.col("t"), examples).alias("c")).collect()] == ["urgent", "calm", "urgent"]
    for wrong in ([], [("a", "b")] * (models.MAX_EXAMPLES + 1)):
        with pytest.raises(ValueError, match="labelled examples"):
            models.classify(F.col("t"), wrong)

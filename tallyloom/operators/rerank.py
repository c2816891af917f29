"""A second look at hits: the chunks around them as one text, and a ranking by a closer comparison."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.models import WORD
from tallyloom.functions.vectors import SCORE_DIGITS
from tallyloom.operators.joins import sent_if_few
from tallyloom.operators.retrieval import TOP_K
from tallyloom.session import materialize

# Words whose vectors a task remembers.
REMEMBERED = 200_000


def expanded(hits: DataFrame, chunks: DataFrame, before: int = 1, after: int = 1, id_column: str = "chunk_id") -> DataFrame:
    """(query_id, rank, source_file, page_number, first_chunk, last_chunk, content): each hit (query_id, rank, id) with the chunks around it.

    Stretches of one page that touch or overlap are one, under their best rank, and ranks are counted anew; so no chunk is twice in a
    query's texts. What a chunk repeats of the one before is left out, by ``start`` and ``stop``. Only places of hits are grouped, a few
    for each query; the chunks are read once more for the texts alone."""
    places = sent_if_few(hits.select("query_id", "rank", id_column)).join(chunks.select(id_column, "source_file", "page_number", "chunk_index"), id_column)
    page = ["query_id", "source_file", "page_number"]
    along = Window.partitionBy(*page).orderBy("chunk_index")
    apart = F.coalesce(F.col("chunk_index") - F.lag("chunk_index").over(along) > before + after + 1, F.lit(True))
    islands = places.withColumn("apart", apart.cast("int")).withColumn("island", F.sum("apart").over(along)).groupBy(*page, "island").agg(
        F.min("rank").alias("best"), F.greatest(F.min("chunk_index") - before, F.lit(0)).alias("low"), (F.max("chunk_index") + after).alias("high"))
    wanted = islands.select(*page, "island", "best", F.explode(F.sequence("low", "high")).alias("chunk_index"))
    wanted = materialize(wanted, "stretches")
    parts = sent_if_few(wanted).join(chunks.select("source_file", "page_number", "chunk_index", "start", "stop", "content"), ["source_file", "page_number", "chunk_index"])
    row = F.array_sort(F.collect_list(F.struct("chunk_index", "start", "stop", "content")))

    def joined(text, part):
        new = F.substring(part["content"], (F.greatest(text["stop"] - part["start"], F.lit(0)) + 1).cast("int"), F.length(part["content"]))
        gap = F.when((text["stop"] >= 0) & (part["start"] > text["stop"]), " ").otherwise("")
        return F.struct(F.greatest(text["stop"], part["stop"]).alias("stop"), F.concat(text["content"], gap, new).alias("content"))

    whole = F.aggregate("parts", F.struct(F.lit(-1).cast("long").alias("stop"), F.lit("").alias("content")), joined, lambda t: t["content"])
    texts = parts.groupBy(*page, "island", "best").agg(row.alias("parts")).select(
        *page, "best", F.col("parts")[0]["chunk_index"].alias("first_chunk"), F.col("parts")[F.size("parts") - 1]["chunk_index"].alias("last_chunk"), whole.alias("content"))
    first = Window.partitionBy("query_id").orderBy("best")
    return texts.withColumn("rank", F.row_number().over(first)).select("query_id", "rank", "source_file", "page_number", "first_chunk", "last_chunk", "content")


class PairScorer(Protocol):
    def score(self, questions: list[str], texts: list[str]) -> list[float]:
        """How well each text answers its question."""


class LateInteraction:
    """Every word of the question is matched with the word of the text that is most like it; the score is the mean of these
    likenesses. A word's vector marks its runs of three letters, ends included, so forms of a word are alike."""

    def __init__(self):
        self.grams: dict[str, frozenset[str]] = {}

    def _grams(self, word: str) -> frozenset[str]:
        if word not in self.grams:
            if len(self.grams) >= REMEMBERED:
                self.grams.clear()
            ends = f"^{word}$"
            self.grams[word] = frozenset(ends[i:i + 3] for i in range(len(ends) - 2))
        return self.grams[word]

    def score(self, questions: list[str], texts: list[str]) -> list[float]:
        return [self._score(q or "", t or "") for q, t in zip(questions, texts)]

    def _score(self, question: str, text: str) -> float:
        asked, given = set(WORD.findall(question.lower())), list(set(WORD.findall(text.lower())))
        if not asked or not given:
            return 0.0
        at = defaultdict(list)
        for i, word in enumerate(given):
            for gram in self._grams(word):
                at[gram].append(i)
        sizes = np.array([len(self._grams(w)) for w in given], float)
        total = 0.0
        for word in sorted(asked):
            grams = self._grams(word)
            shared = np.bincount([i for g in grams for i in at.get(g, ())], minlength=len(given))
            total += float((shared / np.sqrt(sizes * len(grams))).max())
        return total / len(asked)


def reranked(candidates: DataFrame, chunks: DataFrame, questions: DataFrame, k: int = TOP_K, make_scorer: Callable[[], PairScorer] = LateInteraction,
             id_column: str = "chunk_id") -> DataFrame:
    """(query_id, rank, id, score, first_rank): the k best of the candidates (query_id, rank, id) by a scorer that reads question (query_id, text)
    and text of each pair. Only candidates are scored, side by side in batches; ties keep their first order."""
    @F.arrow_udf("double")
    def scored(asked: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array(np.round(make_scorer().score(asked.to_pylist(), texts.to_pylist()), SCORE_DIGITS), pa.float64())

    pairs = sent_if_few(candidates.select("query_id", F.col("rank").alias("first_rank"), id_column)).join(chunks.select(id_column, "content"), id_column).join(
        sent_if_few(questions.select("query_id", F.col("text").alias("asked"))), "query_id")
    judged = pairs.select("query_id", "first_rank", id_column, scored("asked", "content").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "first_rank")
    return judged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", id_column, "score", "first_rank")

"""Exact vector search over byte codes: an index that is searched without reading its vectors.

Beside each vector the index holds one byte a number: the vector at length one, rounded to whole steps, with the step
and the length of what rounding lost. A score computed from the code is off by at most that length, so codes alone say
which rows may be among the best k, and only these are read whole. Nothing is missed, however the vectors lie, and what
is read of all rows is a quarter of single-precision numbers, an eighth of double-precision ones.

The index is sorted by id in small pages, so that the few rows read whole are found by the statistics of their pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyloom.functions.vectors import NORM_GUARD, SCORE_DIGITS, comparable, cosine
from tallyloom.operators.joins import sent_if_few
from tallyloom.operators.retrieval import SENT_NUMBERS, TOP_K, UNEQUAL
from tallyloom.session import materialize

# Steps from zero to the largest number of a vector, and what is added to bounds since scores are rounded.
STEPS, SLACK = 127, 1e-8
# Rows per page of a stored index, and rows up to which they are looked up by id in place of a join.
PAGE_ROWS, NAMED = 1024, 200
# Scores that a task holds at a time.
HELD_SCORES = 500_000


def _rows(vectors: pa.Array) -> np.ndarray:
    widths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(widths) > 1:
        raise ValueError(UNEQUAL)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), widths[0] if widths else 0)
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + NORM_GUARD)


def with_codes(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector can be scored, with ``code``, ``step`` and ``lost``. A vector of zeros has the step 0."""
    known = vectors.where(comparable(F.col(vector)))
    schema = T.StructType(known.schema.fields + [T.StructField("code", T.BinaryType()), T.StructField("step", T.DoubleType()),
                                                 T.StructField("lost", T.DoubleType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column(vector))
            step = np.abs(rows).max(axis=1, initial=0.0) / STEPS
            codes = np.rint(rows / np.where(step > 0, step, 1.0)[:, None])
            lost = np.linalg.norm(rows - codes * step[:, None], axis=1)
            data, width = codes.astype(np.int8).tobytes(), rows.shape[1]
            code = pa.array([data[i * width:(i + 1) * width] for i in range(len(rows))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, code, pa.array(step), pa.array(lost)], names=schema.names)

    return known.mapInArrow(encode, schema)


def write_index(vectors: DataFrame, path: str, vector: str = "embedding", id_column: str = "vec_id", page_rows: int = PAGE_ROWS) -> None:
    """Store the index of some vectors, sorted by id, with statistics for every ``page_rows`` rows."""
    with_codes(vectors, vector).orderBy(id_column).write.option("parquet.page.row.count.limit", str(page_rows)).mode("overwrite").parquet(path)


def _may_be_best(index: DataFrame, asked: DataFrame, k: int, id_column: str, schema: str) -> DataFrame:
    """(query_id, hit_id, low, high): the rows that may be among the best k of their task, for some queries that all
    tasks get. A task holds the k best lower bounds of each query and nothing else."""
    table = asked.toArrow()
    sent = index.sparkSession.sparkContext.broadcast((table["query_id"].combine_chunks(), _rows(table["q"].combine_chunks())))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        best = np.full((k, len(ids)), -np.inf)
        rows_at_once = max(1, HELD_SCORES // max(1, len(ids)))
        for batch in batches:
            for start in range(0, batch.num_rows if len(ids) else 0, rows_at_once):
                part = batch.slice(start, rows_at_once)
                width = queries.shape[1]
                if not pc.all(pc.equal(pc.binary_length(part["code"]), width)).as_py():
                    raise ValueError(UNEQUAL)
                codes = np.frombuffer(b"".join(part["code"].to_pylist()), np.int8).reshape(part.num_rows, width)
                about = (codes.astype(np.float64) @ queries.T) * part["step"].to_numpy()[:, None]
                lost = part["lost"].to_numpy()[:, None] + SLACK
                low, high = about - lost, about + lost
                top = np.concatenate([best, low])
                best = np.partition(top, len(top) - k, axis=0)[len(top) - k:]
                row, col = np.nonzero(high >= best.min(axis=0))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(col)), part["hit_id"].take(pa.array(row)), pa.array(low[row, col]), pa.array(high[row, col])],
                                                 names=["query_id", "hit_id", "low", "high"])

    return index.select(F.col(id_column).alias("hit_id"), "code", "step", "lost").mapInArrow(score, schema)


def candidates(index: DataFrame, queries: DataFrame, k: int = TOP_K, vector: str = "embedding", id_column: str = "vec_id",
               query_id: str = "query_id") -> DataFrame:
    """(query_id, hit_id): all rows that may be among the best k of a query, by their codes. Rows that
    score alike cannot be told apart, so a group of copies at the border is in it whole."""
    asked = queries.where(comparable(F.col(vector))).select(F.col(query_id).alias("query_id"), F.col(vector).alias("q"))
    schema = f"query_id {asked.schema['query_id'].dataType.simpleString()}, hit_id {index.schema[id_column].dataType.simpleString()}, low double, high double"
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dim")).first()
    if not size.n or k < 1:
        return index.sparkSession.createDataFrame([], schema).select("query_id", "hit_id")
    slices = math.ceil(size.n * size.dim / SENT_NUMBERS)
    own = F.pmod(F.xxhash64("query_id"), F.lit(slices))
    parts = [_may_be_best(index, asked.where(own == s), k, id_column, schema) for s in range(slices)]
    found = materialize(reduce(DataFrame.unionAll, parts), "candidates")
    # The k-th best lower bound of a query; equal ones are counted before they meet.
    down = Window.partitionBy("query_id").orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = found.groupBy("query_id", "low").agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.sum("n").over(down))
    floor = bounds.groupBy("query_id").agg(F.max(F.when(F.col("n") >= k, F.col("low"))).alias("floor"))
    return found.join(floor, "query_id").where(F.col("floor").isNull() | (F.col("high") >= F.col("floor"))).select("query_id", "hit_id").distinct()


def _any(tests: list[Column]) -> Column:
    """One of some tests, as a tree of little depth."""
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def rows_of(index: DataFrame, ids: DataFrame, id_column: str = "vec_id") -> DataFrame:
    """The rows of an index with the ids in ``hit_id``. Up to ``NAMED`` of them are looked up by the statistics of pages; more are joined."""
    wanted = ids.select("hit_id").distinct()
    few = wanted.limit(NAMED + 1).collect()
    if 0 < len(few) <= NAMED:
        return index.where(_any([F.col(id_column) == F.lit(r.hit_id) for r in few]))
    return index.join(sent_if_few(wanted), F.col(id_column) == F.col("hit_id"), "left_semi")


def coded_hits(index: DataFrame, queries: DataFrame, k: int = TOP_K, vector: str = "embedding", id_column: str = "vec_id",
               query_id: str = "query_id") -> DataFrame:
    """(query_id, rank, hit_id, score): the exact k best rows of an index for every query vector, ties by id.

    Queries that are null or hold nulls or non-finite numbers have no hits, nor do empty indexes. A vector
    of zeros scores 0. Vectors and queries of unequal length are an error. Each query id occurs once."""
    may = materialize(candidates(index, queries, k, vector, id_column, query_id), "candidates")
    rows = rows_of(index.drop("code", "step", "lost"), may, id_column).select(F.col(id_column).alias("hit_id"), F.col(vector).alias("v"))
    asked = queries.where(comparable(F.col(vector))).select(F.col(query_id).alias("query_id"), F.col(vector).alias("q"))
    scored = may.join(rows, "hit_id").join(asked, "query_id").select(
        "query_id", "hit_id", F.round(cosine(F.col("v"), F.col("q")), SCORE_DIGITS).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "hit_id", "score")

"""Ranking vectors by cosine similarity: one question, many questions, or each other.

One question is a literal. Many questions travel to the vectors in slices of bounded size,
one pass over the vectors per slice, and each task keeps only its best k per question, so
hits are all that is shuffled. All pairs above a score are found exactly, by comparing
bounded blocks; blocks too far apart to hold a pair never meet, but a low score leaves
few of these, and the work then grows with the square of the rows.

Vectors that are null or hold nulls or non-finite numbers are never scored. Vectors and
questions of unequal length are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.batches import few_rows
from tallyloom.functions.models import Encoder, HashingEncoder
from tallyloom.functions.scalars import preview
from tallyloom.functions.vectors import NORM_GUARD, SCORE_DIGITS, comparable, cosine, dot, norm, unit
from tallyloom.session import materialize

# Fixed value: hits per question unless asked otherwise.
TOP_K = 4

# Questions are sent to every task in slices of about this many numbers (64 MB as doubles).
SENT_NUMBERS = 8_000_000
# Scores that a task holds at a time.
HELD_SCORES = 1_000_000
# Vectors that a task turns into numbers at a time.
HELD_ROWS = 2048
# Hits up to which they are sent to the rows they point at.
SENT_HITS = 250_000
UNEQUAL = "vectors and questions differ in length"
# Random planes that divide an index into 2**PLANES buckets, and how many of these a question reads.
PLANES, PROBES = 4, 13
# Rows per block when vectors meet in a task, at least and at most, and blocks that these should make.
BLOCK_ROWS, MOST_BLOCK_ROWS, BLOCKS = 2048, 32_768, 24


def top_hits(vectors: DataFrame, query: list[float], k: int = TOP_K, vector: str = "embedding",
             tie: str = "vec_id") -> DataFrame:
    """The k rows closest to one vector, with ``score``. A sort that keeps k rows per task."""
    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        return pa.concat_arrays([_scores(few, query) for few in few_rows([rows], HELD_ROWS)] or [pa.array([], pa.float64())])

    return vectors.withColumn("score", score(F.col(vector))).where("score IS NOT NULL").orderBy(F.desc("score"), tie).limit(k)


def _scores(rows: pa.Array, query: list[float]) -> pa.Array:
    """The cosine of each row and a query, null where it cannot be scored."""
    at = np.flatnonzero(_comparable(rows))
    units = _unit_rows(rows.take(pa.array(at)), len(query))
    asked = np.asarray(query, float)
    out, known = np.zeros(len(rows)), np.zeros(len(rows), bool)
    out[at], known[at] = np.round(units @ (asked / (np.linalg.norm(asked) + NORM_GUARD)), SCORE_DIGITS), True
    return pa.array(out, mask=~known)


def _comparable(rows: pa.Array) -> np.ndarray:
    """Which vectors can be scored, as ``comparable`` says of a column."""
    whole = np.ones(len(rows), bool) if not rows.null_count else rows.is_valid().to_numpy(zero_copy_only=False)
    flat = rows.flatten()
    odd = ~np.isfinite(flat.to_numpy(zero_copy_only=False))  # a null becomes NaN
    if odd.any():
        length = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        whole[np.repeat(np.arange(len(rows)), length)[odd]] = False
    return whole


def similarity_search(index: DataFrame, columns: list[str], text: str | None = None, vector: list[float] | None = None,
                      k: int = TOP_K, encoder: Encoder | None = None, tie: str = "chunk_id", approximate: bool = False) -> DataFrame:
    """The chosen columns and the score of the k best rows for a text or a vector."""
    if (text is None) == (vector is None):
        raise ValueError("give either a text or a vector")
    if vector is None:
        vector = [float(x) for x in (encoder or HashingEncoder()).encode([text])[0]]
    rank = approximate_hits if approximate else top_hits
    return rank(index, vector, k, tie=tie).select(*columns, "score")


def _unit_rows(vectors: pa.Array, width: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(vectors) and not pc.all(pc.equal(pc.list_value_length(vectors), width)).as_py():
        raise ValueError(UNEQUAL)
    rows = flat.reshape(len(vectors), width)
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + NORM_GUARD)


def _best(scores: np.ndarray, ids: pd.Index, pages: pd.Index | None, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The best k rows per query (a column of ``scores``), one per page if these are given, ties by id."""
    tops = scores
    if pages is not None:
        order = np.argsort(codes := pd.factorize(pages)[0], kind="stable")
        tops = np.maximum.reduceat(scores[order], np.flatnonzero(np.diff(codes[order], prepend=-1)), axis=0)
    keep = min(k, len(tops))
    floor = np.partition(tops, len(tops) - keep, axis=0)[len(tops) - keep]
    row, col = np.nonzero(scores >= floor)
    hits = pd.DataFrame({"query_id": queries[col], "hit_id": ids[row], "score": scores[row, col]})
    return _cut(hits if pages is None else hits.assign(page=pages[row]), k)


def _cut(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    hits = hits.sort_values(["query_id", "score", "hit_id"], ascending=[True, False, True])
    if "page" in hits:
        hits = hits.drop_duplicates(["query_id", "page"])
    return hits.groupby("query_id", sort=False).head(k)


def batch_hits(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, vector: str = "embedding",
               id_column: str = "vec_id", query_id: str = "query_id", page: list[str] | None = None) -> DataFrame:
    """(query_id, rank, hit_id, score): the exact k best rows for every query vector. Each
    query id occurs once. With ``page``, columns that say where a row belongs, only the best
    row of each page counts, so k hits come from k pages."""
    index = vectors.select(
        F.col(id_column).alias("hit_id"), F.col(vector).alias("v"), *([F.to_json(F.struct(*page)).alias("page")] if page else []))
    asked = queries.where(comparable(F.col(vector))).select(F.col(query_id).alias("query_id"), F.col(vector).alias("q"))
    types = {f.name: f.dataType.simpleString() for f in (*index.schema, *asked.schema)}
    schema = f"query_id {types['query_id']}, hit_id {types['hit_id']}, score double" + ", page string" * bool(page)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dim"), F.min(F.size("q")).alias("least")).first()
    if not size.n:
        return vectors.sparkSession.createDataFrame([], f"{schema}, rank int").select("query_id", "rank", "hit_id", "score")
    if size.dim != size.least:
        raise ValueError(UNEQUAL)
    slices = math.ceil(size.n * size.dim / SENT_NUMBERS)
    own = F.pmod(F.xxhash64("query_id"), F.lit(slices))
    parts = [_send_queries(index, asked.where(own == s), size.dim, k, schema) for s in range(slices)]
    found = reduce(DataFrame.unionAll, parts)
    if page:
        first = Window.partitionBy("query_id", "page").orderBy(F.desc("score"), "hit_id")
        found = found.withColumn("place", F.row_number().over(first)).where("place = 1")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    hits = (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "hit_id", "score"))
    # There are at most k hits per question, so their number is known before they are found: two ids and two numbers each.
    return F.broadcast(hits) if size.n * k <= SENT_HITS else hits


def _send_queries(index: DataFrame, asked: DataFrame, width: int, k: int, schema: str) -> DataFrame:
    """The best k rows of each task for some queries, which are sent to all of them."""
    table = asked.toArrow()
    sent = index.sparkSession.sparkContext.broadcast(
        (table["query_id"].to_pandas().to_numpy(), _unit_rows(table["q"].combine_chunks(), width)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        step = min(max(k, HELD_SCORES // max(1, len(ids))), max(k, HELD_ROWS))
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows if len(ids) else 0, step):
                part = batch.slice(start, step)
                if not (known := _comparable(part["v"])).all():
                    part = part.filter(pa.array(known))
                if not part.num_rows:
                    continue
                scores = np.round(_unit_rows(part["v"], width) @ matrix.T, SCORE_DIGITS)
                pages = pd.Index(part["page"].to_pandas()) if "page" in part.schema.names else None
                hits = _best(scores, pd.Index(part["hit_id"].to_pandas()), pages, ids, k)
                held = hits if held is None else _cut(pd.concat([held, hits]), k)
        if held is not None:
            yield pa.RecordBatch.from_pandas(held, preserve_index=False)

    return index.mapInArrow(score, schema)


def hit_rows(hits: DataFrame, chunks: DataFrame, id_column: str = "chunk_id") -> DataFrame:
    """Hits with the chunk they point at and a preview. Only hits reach the join, so the
    chunk text is read once and never sorted."""
    wanted = chunks.select(F.col(id_column).alias("hit_id"), "source_file", "page_number", "chunk_index", "content")
    return hits.join(wanted, "hit_id").select(
        "query_id", "rank", "score", F.col("hit_id").alias(id_column), "source_file", "page_number", "chunk_index",
        preview(F.col("content")).alias("preview"), "content")


def label_votes(hits: DataFrame, labelled: DataFrame, label: str = "label", id_column: str = "vec_id") -> DataFrame:
    """(query_id, label, votes, best_score): the most frequent label among each query's hits,
    ties by score."""
    known = labelled.select(F.col(id_column).alias("hit_id"), F.col(label).alias("label"))
    counted = hits.join(known, "hit_id").groupBy("query_id", "label").agg(
        F.count(F.lit(1)).alias("votes"), F.max("score").alias("best_score"))
    first = Window.partitionBy("query_id").orderBy(F.desc("votes"), F.desc("best_score"), "label")
    return counted.withColumn("place", F.row_number().over(first)).where(F.col("place") == 1).drop("place")


def labelled_hits(hits: DataFrame, labelled: DataFrame, label: str, text: str, id_column: str) -> DataFrame:
    """(query_id, rank, score, label, text): what each question is closest to."""
    known = labelled.select(F.col(id_column).alias("hit_id"), F.col(label).alias("label"), F.col(text).alias("text"))
    return hits.join(known, "hit_id").select("query_id", "rank", "score", "label", "text")


def score_pairs(pairs: DataFrame, vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(left_id, right_id, score) for given pairs of ids."""
    def side(name: str) -> DataFrame:
        return vectors.select(F.col(id_column).alias(f"{name}_id"), F.col(vector).alias(f"{name}_v"))

    return pairs.join(side("left"), "left_id").join(side("right"), "right_id").select(
        "left_id", "right_id", F.round(cosine(F.col("left_v"), F.col("right_v")), SCORE_DIGITS).alias("score"))


def similar_pairs(vectors: DataFrame, min_score: float, vector: str = "embedding", id_column: str = "vec_id",
                  block_rows: int | None = None) -> DataFrame:
    """(left_id, right_id, score, left_copies, right_copies): all pairs of distinct vectors
    that score at least ``min_score``, exactly. Equal vectors are one row under their
    smallest id, with the number of copies, so a large group of copies stays one row. A
    group of copies is paired with itself (left_id = right_id) if it has more than one.

    Unit vectors scoring s are sqrt(2 - 2s) apart, and a projection never lies further
    apart than the vectors themselves. So with cells that wide along one axis, a pair lies
    in the same or in adjacent cells. Cells are cut into blocks of ``block_rows`` rows,
    and each pair of blocks that may hold a pair is one small group. A row goes to all blocks it meets, so blocks grow with
    the table up to ``MOST_BLOCK_ROWS`` rows, and their number stays the same until then; scores are held a strip at a time."""
    # A little wider than needed, since scores are rounded before they are compared.
    reach = math.sqrt(max(2 - 2 * min_score, 0.0)) + 1e-4
    copies = vectors.where(comparable(F.col(vector))).groupBy(F.col(vector).alias("v")).agg(
        F.min(id_column).alias("id"), F.count(F.lit(1)).alias("copies"))
    rows = materialize(copies.select("id", "copies", unit(F.col("v")).alias("v")), "unit-vectors")
    mean = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x"))
    axis = [r.x for r in mean.orderBy("at").collect()]  # one number per dimension
    length = math.sqrt(sum(x * x for x in axis)) or 1.0
    along = dot(F.col("v"), F.array(*[F.lit(x / length) for x in axis]))
    celled = rows.withColumn("cell", F.floor(along / F.lit(reach)).cast("int"))
    alike = F.when(norm(F.col("v")) > 0.5, F.lit(1.0)).otherwise(0.0)  # a zero vector scores 0, with its copies too
    selves = rows.where("copies > 1").select(F.col("id").alias("left_id"), F.col("id").alias("right_id"), alike.alias("score"),
                                             F.col("copies").alias("left_copies"), F.col("copies").alias("right_copies")).where(F.col("score") >= min_score)
    # Projections lie in [-1, 1], so there are at most 2 / reach + 2 cells.
    held = {r.cell: r.n for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    block_rows = block_rows or min(max(BLOCK_ROWS, math.ceil(sum(held.values()) / BLOCKS)), MOST_BLOCK_ROWS)
    blocks = {cell: math.ceil(n / block_rows) for cell, n in held.items()}
    if not blocks:
        return selves
    known = F.create_map(*[F.lit(x) for cell, n in sorted(blocks.items()) for x in (cell, n)])

    def count(cell):
        return F.coalesce(F.try_element_at(known, cell), F.lit(0))

    def numbers(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    cell, block = F.col("cell"), F.col("block")
    placed = celled.withColumn("block", F.pmod(F.xxhash64("id"), count(cell).cast("bigint")).cast("int"))

    def meeting(left_cell, left_block, right_cell, right_block, left):
        return F.struct(left_cell.alias("c1"), left_block.alias("b1"), right_cell.alias("c2"), right_block.alias("b2"),
                        F.lit(left).alias("is_left"))

    meetings = F.concat(
        F.transform(F.sequence(block, count(cell) - 1), lambda b: meeting(cell, block, cell, b, True)),
        F.transform(numbers(block), lambda b: meeting(cell, b, cell, block, False)),
        F.transform(numbers(count(cell + 1)), lambda b: meeting(cell, block, cell + 1, b, True)),
        F.transform(numbers(count(cell - 1)), lambda b: meeting(cell - 1, b, cell, block, False)))
    met = placed.select("id", "copies", "v", F.inline(meetings))
    id_type = rows.schema["id"].dataType.simpleString()

    schema = f"left_id {id_type}, right_id {id_type}, score double, left_copies bigint, right_copies bigint"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(batches)
        is_left = group["is_left"].combine_chunks()
        left, right = group.filter(is_left).combine_chunks(), group.filter(pc.invert(is_left)).combine_chunks()
        alone = not right.num_rows and group["c1"][0] == group["c2"][0] and group["b1"][0] == group["b2"][0]
        right = left if alone else right

        def matrix(side: pa.Table) -> np.ndarray:
            flat = side["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(side.num_rows, -1)

        step = max(1, HELD_SCORES // max(1, right.num_rows))
        rows, columns = (matrix(left), matrix(right).T) if left.num_rows and right.num_rows else (None, None)
        for start in range(0, left.num_rows if rows is not None else 0, step):
            scores = np.round(rows[start:start + step] @ columns, SCORE_DIGITS)
            i, j = np.nonzero(scores >= min_score)
            found, i = scores[i, j], i + start
            if alone:
                found, i, j = found[i < j], i[i < j], j[i < j]
            a, b = left.select(["id", "copies"]).take(i), right.select(["id", "copies"]).take(j)
            swap = pc.greater(a["id"], b["id"])

            def pick(name: str, when_swapped: pa.Table, otherwise: pa.Table):
                return pc.if_else(swap, when_swapped[name], otherwise[name])

            yield from pa.table({
                "left_id": pick("id", b, a), "right_id": pick("id", a, b), "score": pa.array(found),
                "left_copies": pick("copies", b, a), "right_copies": pick("copies", a, b)}).to_batches()

    return met.groupBy("c1", "b1", "c2", "b2").applyInArrow(compare, schema).unionByName(selves)


def _planes(width: int, planes: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(planes, width))


def with_buckets(vectors: DataFrame, width: int, vector: str = "embedding", planes: int = PLANES, seed: int = 0) -> DataFrame:
    """The rows with ``bucket``: on which side of each of some random planes their vector lies. Stored
    partitioned by it, an index lets ``approximate_hits`` read a part of its files."""
    bits = [F.when(dot(F.col(vector), F.array(*map(F.lit, plane.tolist()))) >= 0, 1 << i).otherwise(0) for i, plane in enumerate(_planes(width, planes, seed))]
    return vectors.withColumn("bucket", reduce(lambda a, b: a + b, bits))


def nearest_buckets(query: list[float], probes: int, planes: int = PLANES, seed: int = 0) -> list[int]:
    """The buckets to read for a question, its own first, then those behind the planes it lies closest to."""
    side = _planes(len(query), planes, seed) @ np.asarray(query, float)
    own = sum(1 << i for i, s in enumerate(side) if s >= 0)
    cost = [sum(side[i] ** 2 for i in range(planes) if (bucket ^ own) >> i & 1) for bucket in range(1 << planes)]
    return [int(b) for b in np.argsort(cost, kind="stable")[:probes]]


def approximate_hits(vectors: DataFrame, query: list[float], k: int = TOP_K, vector: str = "embedding",
                     tie: str = "vec_id", probes: int = PROBES, planes: int = PLANES, seed: int = 0) -> DataFrame:
    """Like ``top_hits`` over the buckets nearest to the question: scores are exact, hits in other buckets
    are missed. A hit at angle a lies across one plane in a/180 of all cases; with the defaults, 13 of
    16 parts are read. What is found depends on the vectors: ``recall`` measures it.
    Rows without ``bucket`` get it here, which saves scoring but no reading."""
    if "bucket" not in vectors.columns:
        vectors = with_buckets(vectors.where(comparable(F.col(vector))), len(query), vector, planes, seed)
    near = vectors.where(F.col("bucket").isin(nearest_buckets(query, probes, planes, seed)))
    return top_hits(near, query, k, vector, tie).drop("bucket")


def recall(vectors: DataFrame, queries: DataFrame, width: int, k: int = TOP_K, vector: str = "embedding", id_column: str = "vec_id",
           query_id: str = "query_id", probes: int = PROBES, planes: int = PLANES, seed: int = 0) -> DataFrame:
    """One row (right, hits): how many of the exact k best rows of all queries ``approximate_hits`` finds. Scores in
    the buckets it reads are exact, so it finds those that lie in them."""
    sides = [dot(F.col(vector), F.array(*map(F.lit, plane.tolist()))) for plane in _planes(width, planes, seed)]
    asked = queries.select(F.col(query_id).alias("query_id"), F.array(*sides).alias("sides"))
    own = lambda i: F.col("sides")[i] >= 0
    cost = [F.struct(reduce(lambda a, b: a + b, [F.when(own(i) == bool(bucket >> i & 1), 0.0).otherwise(F.pow(F.col("sides")[i], 2)) for i in range(planes)]).alias("cost"),
                     F.lit(bucket).alias("bucket")) for bucket in range(1 << planes)]
    read = asked.select("query_id", F.transform(F.slice(F.array_sort(F.array(*cost)), 1, probes), lambda c: c["bucket"]).alias("read"))
    places = with_buckets(vectors, width, vector, planes, seed).select(F.col(id_column).alias("hit_id"), "bucket")
    hits = batch_hits(vectors, queries, k, vector, id_column, query_id).join(places, "hit_id").join(read, "query_id")
    return hits.agg(F.count_if(F.array_contains("read", F.col("bucket"))).alias("right"), F.count(F.lit(1)).alias("hits"))

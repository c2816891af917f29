"""Search by words: an inverted index stored by term, BM25, and rankings fused with those of vectors.

Chunks lie in shards of bounded size, those read together; only chunks whose id may repeat are moved, dealt by it. A chunk has a number in its shard
that counts upwards with the id. A posting row holds all that a shard knows of a term: the numbers of its chunks, as steps from one to the next, and
how often each has it, both packed into few bytes. The index is four tables: postings (term, shard, n, places, tfs), terms (term, df), shards (shard,
hit_ids, lengths, rows) and totals, the first two in folders by a hash of the term and sorted by it, so that a question reads the folders and row
groups of its own words. A shard's rows are written by the task that made them: texts and postings cross no shuffle.

All scores of a chunk are made in its shard, so a search moves the postings of the words asked for once, however many questions share them,
and each shard gives its best few chunks for a question. A frequent word is spread over all shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.functions.batches import few_rows
from tallyloom.functions.text import collapse_whitespace
from tallyloom.operators.joins import sent_if_few
from tallyloom.operators.retrieval import TOP_K, batch_hits
from tallyloom.session import materialize

# The usual parameters of BM25, and the offset of reciprocal rank fusion.
SATURATION, LENGTH_WEIGHT, RANK_OFFSET = 1.2, 0.75, 60
WORDS = r"[\p{L}\p{N}]+"
# Folders of an index; words up to which a search names them to the scan.
FOLDERS, NAMED = 64, 2000
# Chunks of a shard, about; pairs of a question and a word that are sent to the shards at a time.
SHARD_CHUNKS, SENT_WORDS = 20_000, 500_000
# The folder of the rows that say which chunks a shard has.
SHARDS = -1
# Candidates of each ranking that are fused or reranked, for each hit asked for.
CANDIDATES = 10
SCORE_DIGITS = 9


@dataclass
class KeywordIndex:
    postings: DataFrame
    terms: DataFrame
    totals: DataFrame
    shards: DataFrame


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def _folder(term: str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


def _new(values: pa.Array) -> np.ndarray:
    """Where a sorted column has another value than in the row before; nulls are equal."""
    codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.diff(codes, prepend=-1) != 0


def _packed(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Lists of whole numbers as bytes: one, two or four a number, as the largest of the list needs."""
    sizes = np.diff(begin, append=len(values))
    most = np.maximum.reduceat(values, begin) if len(begin) else values
    width = np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))
    kept = values.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < np.repeat(width, sizes)[:, None]]
    ends = np.append(0, np.cumsum(width * sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


def _unpacked(lists: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all lists, one list after the other."""
    width = pc.binary_length(lists).to_numpy(zero_copy_only=False) // np.maximum(sizes, 1)
    whole = np.zeros((sizes.sum(), 4), np.uint8)
    whole[np.arange(4) < np.repeat(width, sizes)[:, None]] = np.frombuffer(b"".join(lists.to_pylist()), np.uint8)
    return whole.view("<u4").ravel().astype(np.int64)


def _places(steps: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The places of all lists, from the steps between them."""
    step = _unpacked(steps, sizes)
    reached, begin = np.cumsum(step), np.cumsum(sizes) - sizes
    return reached - np.repeat(reached[begin] - step[begin], sizes)


def write_keyword_index(chunks: DataFrame, path: str, id_column: str = "chunk_id", text: str = "content") -> KeywordIndex:
    """Index the words of chunks. Chunks without words count, and are never found. Rows of one id and length are one place."""
    spark, size, key = chunks.sparkSession, SHARD_CHUNKS, F.xxhash64(id_column)
    # Rows of one id must meet in a shard. A hash may also say of different ids that they repeat, which moves them and no more.
    again = materialize(chunks.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-ids")
    repeated = again.agg(F.sum("n")).first()[0] or 0
    id_type = chunks.schema[id_column].dataType.simpleString()

    def build(at: int, group: pa.Table) -> pa.Table:
        group = group.append_column("length", pc.list_value_length(group["words"]))
        group = group.take(pc.sort_indices(group, [("hit_id", "ascending"), ("length", "ascending")], null_placement="at_start")).combine_chunks()
        ids, length = group["hit_id"].combine_chunks(), group["length"].combine_chunks()
        first = _new(ids) | _new(length)
        place, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        spelled = group["words"].combine_chunks().flatten().dictionary_encode()
        key = spelled.indices.to_numpy().astype(np.int64) * len(starts) + np.repeat(place, length.to_numpy())
        key, tf = np.unique(key, return_counts=True)
        term, where = np.divmod(key, len(starts))
        begin = np.flatnonzero(np.diff(term, prepend=-1))
        steps = np.diff(where, prepend=0)
        steps[begin] = where[begin]
        postings = pa.table({"shard": pa.array([at] * len(begin), pa.int64()), "term": spelled.dictionary.take(pa.array(term[begin])),
                             "n": pa.array(np.diff(begin, append=len(key)).astype(np.int32)), "places": _packed(steps, begin), "tfs": _packed(tf, begin)})
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), values)
        known = pa.table({"shard": pa.array([at], pa.int64()), "hit_ids": one(ids.take(pa.array(starts))), "lengths": one(length.take(pa.array(starts))),
                          "rows": one(pa.array(np.diff(starts, append=len(ids)).astype(np.int32)))})
        return pa.concat_tables([postings, known], promote_options="default").select(names)

    def build_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, rows = TaskContext.get().partitionId() << 32, [], 0
        for batch in few_rows(batches, size):
            held.append(batch)
            rows += batch.num_rows
            if rows >= size:
                yield from build(at, pa.Table.from_batches(held)).to_batches()
                at, held, rows = at + 1, [], 0
        if rows:
            yield from build(at, pa.Table.from_batches(held)).to_batches()

    schema = f"shard bigint, term string, n int, places binary, tfs binary, hit_ids array<{id_type}>, lengths array<int>, rows array<int>"
    names = [part.split(" ")[0] for part in schema.split(", ")]
    cut = words(F.coalesce("text", F.lit(""))).alias("words")
    rows = chunks.select(key.alias("key"), F.col(id_column).alias("hit_id"), F.col(text).alias("text"))
    if not repeated:
        built = rows.select("hit_id", cut).mapInArrow(build_here, schema)
    else:
        moved, number = sent_if_few(again.select("key")), math.ceil(repeated / size)
        built = rows.join(moved, "key", "left_anti").select("hit_id", cut).mapInArrow(build_here, schema)
        # Texts are dealt out as they are, and cut into words where they arrive. Their shards count downwards from -1.
        dealt = rows.join(moved, "key", "left_semi").select((-1 - F.pmod("key", F.lit(number))).alias("shard"), "hit_id", "text").repartition(number, "shard").sortWithinPartitions("shard")
        built = built.unionAll(dealt.select("shard", "hit_id", cut).groupBy("shard").applyInArrow(lambda group: build(group["shard"][0].as_py(), group), schema))
    folder = F.when(F.col("term").isNull(), SHARDS).otherwise(_folder("term"))
    built.withColumn("folder", folder).sortWithinPartitions("folder", "term").write.mode("overwrite").option("compression", "zstd").partitionBy("folder").parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    stored.where(F.col("folder") != SHARDS).groupBy("folder", "term").agg(F.sum("n").alias("df")).repartition("folder").sortWithinPartitions(
        "folder", "term").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/terms")
    sizes = stored.where(F.col("folder") == SHARDS).select(F.inline(F.arrays_zip("lengths", "rows")))
    sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("chunks"), (F.sum(F.col("lengths").cast("bigint") * F.col("rows")) / F.sum("rows")).alias("length")).write.mode(
        "overwrite").parquet(f"{path}/totals")
    return read_keyword_index(spark, path)


def read_keyword_index(spark: SparkSession, path: str) -> KeywordIndex:
    postings, terms, totals, shards = (spark.read.parquet(f"{path}/{name}") for name in ("postings", "terms", "totals", "postings"))
    return KeywordIndex(postings.where(F.col("folder") != SHARDS).select("folder", "term", "shard", "n", "places", "tfs"), terms, totals,
                        shards.where(F.col("folder") == SHARDS).select("shard", "hit_ids", "lengths"))


def _named(table: DataFrame, asked: DataFrame) -> DataFrame:
    """The part of an index table that holds the words asked for: its folders, and its row groups if the words are not too many."""
    folders = [r.folder for r in asked.select("folder").distinct().collect()]  # FOLDERS at most
    table = table.where(F.col("folder").isin(folders))
    some = [r.term for r in asked.select("term").distinct().limit(NAMED + 1).collect()]
    return table.where(F.col("term").isin(some)) if len(some) <= NAMED else table


def _asked(index: KeywordIndex, questions: DataFrame, query_id: str, text: str) -> DataFrame:
    """(query_id, term, folder, df): the distinct words of each question that the index knows."""
    rows = questions.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(words(F.col(text)))).alias("term")).withColumn("folder", _folder("term"))
    return rows.join(_named(index.terms, rows), ["folder", "term"])


def best_per_query(scored: DataFrame, k: int, parts: int = 32) -> DataFrame:
    """(query_id, rank, hit_id, score): the k best rows of each query, ties by id. Chosen among parts of a query's rows first, so that one that
    fits nearly all chunks is no single group."""
    best = [F.desc("score"), F.asc("hit_id")]
    some = Window.partitionBy("query_id", "part").orderBy(*best)
    few = scored.withColumn("part", F.pmod(F.xxhash64("hit_id"), F.lit(parts))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best))).where(F.col("rank") <= k).select("query_id", "rank", "hit_id", "score")


def keyword_hits(index: KeywordIndex, questions: DataFrame, k: int = TOP_K, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """(query_id, rank, hit_id, score): the k best chunks for each question by BM25 over its distinct words. A question
    none of whose words is known has no hits."""
    total = index.totals.first()
    df = F.col("df")
    asked = materialize(_asked(index, questions, query_id, text).select(
        "query_id", "folder", "term", F.log(1 + (total.chunks - df + 0.5) / (df + 0.5)).alias("idf")), "asked-words")
    slices = max(1, math.ceil(asked.count() / SENT_WORDS))
    own = F.pmod(F.xxhash64("query_id"), F.lit(slices))
    found = reduce(DataFrame.unionAll, [_best_of_shards(index, asked.where(own == s), k, total.length or 1.0) for s in range(slices)])
    return best_per_query(found, k)


def _best_of_shards(index: KeywordIndex, asked: DataFrame, k: int, mean: float) -> DataFrame:
    """(query_id, hit_id, score): the k best chunks of each shard for some questions, whose words are sent to all of them."""
    table = asked.select("query_id", "term", "idf").toArrow().combine_chunks()
    queries = table["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(queries.indices)
    terms = table["term"].combine_chunks().take(order).dictionary_encode()
    starts = np.searchsorted(queries.indices.take(order).to_numpy(), np.arange(len(queries.dictionary) + 1))
    sent = index.postings.sparkSession.sparkContext.broadcast(
        (queries.dictionary, terms.dictionary, terms.indices.to_numpy(), table["idf"].combine_chunks().take(order).to_numpy(), starts))
    parts = max(1, index.shards.count())
    asked_types = asked.schema["query_id"].dataType.simpleString()
    schema = f"query_id {asked_types}, hit_id {index.shards.schema['hit_ids'].dataType.elementType.simpleString()}, score double"

    def score(postings: pa.Table, shard: pa.Table) -> pa.Table:
        ids, words_of, term_of, idf, starts = sent.value
        known = pc.index_in(postings["term"].combine_chunks(), words_of)
        postings = postings.filter(known.is_valid()).combine_chunks()
        row_of = np.full(len(words_of), -1)
        row_of[known.drop_null().to_numpy()] = np.arange(postings.num_rows)
        hit_ids, length = shard["hit_ids"].combine_chunks().flatten(), shard["lengths"].combine_chunks().flatten().to_numpy()
        held = postings["n"].to_numpy()
        places, tf = (read(postings[name].combine_chunks(), held) if len(held) else np.zeros(0, np.int64) for read, name in ((_places, "places"), (_unpacked, "tfs")))
        part = tf * (SATURATION + 1) / (tf + SATURATION * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * length[places] / mean))
        ends = np.cumsum(held)
        firsts = np.flatnonzero(_new(hit_ids))
        found = []
        for q in range(len(ids)):
            scores = np.zeros(len(length))
            for i in range(starts[q], starts[q + 1]):
                if (row := row_of[term_of[i]]) >= 0:
                    span = slice(ends[row - 1] if row else 0, ends[row])
                    scores[places[span]] += idf[i] * part[span]
            if len(firsts) < len(scores):  # an id with texts of several lengths
                scores = np.add.reduceat(scores, firsts)
            (some,) = np.nonzero(scores)
            if len(some):
                rounded = np.round(scores[some], SCORE_DIGITS)
                floor = np.partition(rounded, len(rounded) - min(k, len(rounded)))[len(rounded) - min(k, len(rounded))]
                some, rounded = some[rounded >= floor], rounded[rounded >= floor]
                best = np.argsort(-rounded, kind="stable")[:k]  # places go by id, and so do ties
                found.append((np.full(len(best), q), firsts[some[best]], rounded[best]))
        query, place, values = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table({"query_id": ids.take(pa.array(query)), "hit_id": hit_ids.take(pa.array(place)), "score": pa.array(values)})

    # Words that are too many to be named are passed over before they move.
    words_asked = sent_if_few(asked.select("folder", "term").distinct())
    wanted = _named(index.postings, asked).join(words_asked, ["folder", "term"], "left_semi").select("shard", "term", "n", "places", "tfs")
    return wanted.repartition(parts, "shard").groupBy("shard").cogroup(index.shards.repartition(parts, "shard").groupBy("shard")).applyInArrow(score, schema)


def fused(rankings: dict[str, DataFrame], k: int = TOP_K) -> DataFrame:
    """(query_id, rank, hit_id, score, <name>_rank ...): rankings (query_id, rank, hit_id) joined by reciprocal ranks, ties by id. Each has a
    bounded number of hits for a query."""
    parts = [r.select("query_id", "hit_id", F.lit(name).alias("name"), "rank") for name, r in rankings.items()]
    of = {name: F.max(F.when(F.col("name") == name, F.col("rank"))) for name in rankings}
    score = reduce(lambda a, b: a + b, [F.coalesce(1.0 / (RANK_OFFSET + r), F.lit(0.0)) for r in of.values()])
    joined = reduce(DataFrame.unionByName, parts).groupBy("query_id", "hit_id").agg(
        F.round(score, SCORE_DIGITS).alias("score"), *[r.alias(f"{name}_rank") for name, r in of.items()])
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    return joined.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "hit_id", "score", *[f"{name}_rank" for name in rankings])


def hybrid_hits(vectors: DataFrame, index: KeywordIndex, questions: DataFrame, k: int = TOP_K, candidates: int | None = None,
                min_score: float | None = None, id_column: str = "chunk_id") -> DataFrame:
    """The k best chunks for each question (query_id, text, embedding) by vectors and words together. ``min_score`` is the cosine that
    a chunk must reach to count as found by its vector; words may still find it. The search is made here and now, so its hits may be read many times."""
    wide = candidates or CANDIDATES * k
    near = batch_hits(vectors, questions, wide, id_column=id_column)
    if min_score is not None:
        near = near.where(F.col("score") >= min_score)
    return materialize(fused({"vector": near, "keyword": keyword_hits(index, questions, wide)}, k), "hybrid-hits")


def holding_documents(index: KeywordIndex, questions: DataFrame, chunks: DataFrame, documents: DataFrame, id_column: str = "chunk_id") -> DataFrame:
    """(query_id, source_file): the documents (source_file, text) whose text, white space collapsed, holds a question's whole text.

    Only documents that hold the question's rarest word are looked at; the first and the last word are passed over, since they may be parts
    of longer ones there, unless there are no others."""
    inner = F.when(F.size("w") > 2, F.slice(F.col("w"), 2, F.size("w") - 2)).otherwise(F.col("w"))
    passages = questions.select("query_id", collapse_whitespace(F.col("text")).alias("passage"))
    inside = passages.withColumn("w", words(F.col("passage"))).select("query_id", F.array_join(inner, " ").alias("text"))
    asked = _asked(index, inside, "query_id", "text").groupBy("query_id").agg(F.min_by(F.struct("folder", "term"), F.struct("df", "term")).alias("rare")).select("query_id", "rare.*")
    asked = materialize(asked, "rare-words")

    @F.arrow_udf("array<int>")
    def each_place(steps: pa.Array, sizes: pa.Array) -> pa.Array:
        held = sizes.to_numpy().astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)).astype(np.int32)), pa.array(_places(steps, held).astype(np.int32)))

    ids = index.shards.select("shard", F.posexplode("hit_ids").alias("place", "hit_id"))
    places = materialize(_named(index.postings, asked).join(sent_if_few(asked), ["folder", "term"]).select("query_id", "shard", F.explode(each_place("places", "n")).alias("place")), "rare-places")
    rare = materialize(sent_if_few(places).join(ids, ["shard", "place"]).select("query_id", F.col("hit_id").alias(id_column)).distinct(), "rare-chunks")
    likely = materialize(sent_if_few(rare).join(chunks.select(id_column, "source_file"), id_column).select("query_id", "source_file").distinct(), "likely-documents")
    texts = documents.select("source_file", collapse_whitespace(F.col("text")).alias("whole"))
    # The few likely pairs go to the documents, whose texts stay where they are read.
    return sent_if_few(likely.join(passages, "query_id")).join(texts, "source_file").where(F.contains("whole", "passage")).select("query_id", "source_file").distinct()


def ranking_quality(hits: DataFrame, relevant: DataFrame, k: int, query_id: str = "query_id") -> DataFrame:
    """(query_id, found, known, recall, reciprocal_rank, ndcg) for each query that has relevant documents, hits or none.

    ``hits``: (query_id, rank, source_file, grade), grade 0 where the hit is of no use; ``relevant``: (query_id, source_file, grades), the grades of all
    its chunks, best first. Recall counts documents; the ideal ranking of nDCG has the k best chunks of all relevant documents."""
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    got = hits.where(F.col("rank") <= k).groupBy("query_id").agg(
        F.countDistinct(F.when(F.col("grade") > 0, F.col("source_file"))).alias("found"), F.min(F.when(F.col("grade") > 0, F.col("rank"))).alias("first"),
        F.sum(gain(F.col("grade")) / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    best = Window.partitionBy("query_id").orderBy(F.desc("grade"))
    # At most k grades of each document, then of each query.
    ideal = relevant.select("query_id", F.explode(F.slice("grades", 1, k)).alias("grade")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    ideal = ideal.groupBy("query_id").agg(F.sum(gain(F.col("grade")) / F.log2(F.col("place") + 1.0)).alias("ideal"))
    known = relevant.groupBy("query_id").agg(F.count("source_file").alias("known"))
    found = F.coalesce("found", F.lit(0))
    return known.join(ideal, "query_id").join(got, "query_id", "left").select(
        "query_id", found.alias("found"), "known", F.round(found / F.least("known", F.lit(k)), 6).alias("recall"),
        F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 6).alias("reciprocal_rank"), F.round(F.coalesce(F.col("dcg"), F.lit(0.0)) / F.col("ideal"), 6).alias("ndcg"))

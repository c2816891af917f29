import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import models
from tallyloom.functions.vectors import cosine, norm, unit
from tallyloom.operators import retrieval
from tallyloom.operators.joins import sent_if_few
from tallyloom.operators.retrieval import (approximate_hits, batch_hits, hit_rows, label_votes, recall, score_pairs, similar_pairs,
                                           similarity_search, top_hits, with_buckets)

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row], i % 4) for i, row in enumerate(matrix)], SCHEMA)


def cosines(a, b):
    a, b = a.astype(np.float32).astype(float), b.astype(np.float32).astype(float)
    a, b = (m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-10) for m in (a, b))
    return np.round(a @ b.T, 9)


def best(scores, k):
    return {(q, r + 1, int(i)) for q in range(scores.shape[0]) for r, i in enumerate(np.lexsort((np.arange(scores.shape[1]), -scores[q]))[:k])}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    return np.concatenate([c + rng.normal(scale=0.15, size=(40, 8)) for c in centres])


def test_expressions(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a ARRAY<FLOAT>, b ARRAY<FLOAT>, z ARRAY<FLOAT>").select(
        norm(F.col("a")), cosine(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("z")), unit(F.col("a"))[0]).first()
    assert [round(x, 6) for x in row] == [5.0, 0.96, 0.0, 0.6]


@pytest.mark.parametrize("sent", [10**9, 70])
def test_batch_hits(spark, clustered, monkeypatch, sent):
    monkeypatch.setattr(retrieval, "SENT_NUMBERS", sent)  # 70: questions are sent in four slices
    monkeypatch.setattr(retrieval, "HELD_SCORES", 500)
    data = np.concatenate([clustered, clustered[:100]])  # copies tie, the smaller id wins
    df = vectors(spark, data).repartition(5)
    asked = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(clustered[:30])], "query_id INT, embedding ARRAY<FLOAT>")
    got = batch_hits(df, asked, 7).collect()
    assert {(r.query_id, r.rank, r.hit_id) for r in got} == best(cosines(clustered[:30], data), 7)


def test_batch_hits_edges(spark, clustered):
    df = vectors(spark, clustered[:3])
    none = spark.createDataFrame([], "query_id STRING, embedding ARRAY<FLOAT>")
    assert batch_hits(df, none).columns == ["query_id", "rank", "hit_id", "score"] and batch_hits(df, none).count() == 0
    asked = spark.createDataFrame([("a", [0.0] * 8), ("b", [1.0] * 8)], "query_id STRING, embedding ARRAY<FLOAT>")
    rows = batch_hits(df, asked, 10).collect()
    assert len(rows) == 6 and {r.score for r in rows if r.query_id == "a"} == {0.0}


def test_one_query(spark, clustered):
    got = top_hits(vectors(spark, clustered), [float(x) for x in clustered[9]], 5).collect()
    assert {(0, i + 1, r.vec_id) for i, r in enumerate(got)} == best(cosines(clustered[9:10], clustered), 5)


@pytest.mark.parametrize("threshold, block", [(0.9, 16), (0.9, 4096), (0.2, 64), (-1.0, 100), (0.999, 8)])
def test_similar_pairs(spark, clustered, threshold, block):
    data = clustered[::3]
    df = vectors(spark, data).repartition(4)
    scores = cosines(data, data)
    want = {(i, j): scores[i, j] for i in range(len(data)) for j in range(i + 1, len(data)) if scores[i, j] >= threshold}
    rows = similar_pairs(df, threshold, block_rows=block).collect()
    got = {(r.left_id, r.right_id): r.score for r in rows}
    assert len(rows) == len(got) and set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-8 for p in got)


def test_copies_are_one_row(spark, clustered):
    data = np.concatenate([clustered[:5], np.repeat(clustered[:1], 400, axis=0)])
    rows = similar_pairs(vectors(spark, data), 0.5, block_rows=32).collect()
    assert len(rows) <= 11 and (0, 0, 401) in {(r.left_id, r.right_id, r.left_copies) for r in rows} and all((r.left_copies == 401) == (r.left_id == 0) for r in rows)
    assert similar_pairs(vectors(spark, data[:0]), 0.5).count() == 0


def test_pairs_votes_and_pages(spark, clustered):
    df = vectors(spark, clustered)
    scores = cosines(clustered, clustered)
    pairs = spark.createDataFrame([(1, 2), (3, 100)], "left_id BIGINT, right_id BIGINT")
    assert {(r.left_id, r.score) for r in score_pairs(pairs, df).collect()} == {(1, scores[1, 2]), (3, scores[3, 100])}
    hits = spark.createDataFrame([(1, i + 1, i, s) for i, s in enumerate([0.9, 0.8, 0.7, 0.6, 0.5])], "query_id INT, rank INT, hit_id BIGINT, score DOUBLE")
    assert tuple(label_votes(hits, df).first()) == (1, 0, 2, 0.9)
    chunks = spark.createDataFrame([(i, "f", i // 3, i, f"text {i}" * 40) for i in range(9)],
                                   "chunk_id BIGINT, source_file STRING, page_number INT, chunk_index INT, content STRING")
    rows = hit_rows(hits, chunks)
    assert [r.preview for r in rows.where("rank = 1").collect()] == [("text 0" * 40)[:160] + "..."]


def test_k_hits_come_from_k_pages(spark, clustered):
    df = vectors(spark, clustered).withColumn("page", F.floor(F.col("vec_id") / 7)).repartition(5)
    asked = spark.createDataFrame([(i, [float(x) for x in clustered[i]]) for i in (0, 50, 200)], "query_id INT, embedding ARRAY<FLOAT>")
    got = {(r.query_id, r["rank"], r.hit_id) for r in batch_hits(df, asked, 6, page=["page"]).collect()}
    scores, want = cosines(clustered[[0, 50, 200]], clustered), set()
    for q, row in zip((0, 50, 200), scores):
        seen = []
        for i in np.lexsort((np.arange(len(row)), -row)):
            if i // 7 not in [j // 7 for j in seen] and len(seen) < 6:
                seen.append(int(i))
        want |= {(q, r + 1, i) for r, i in enumerate(seen)}
    assert got == want


def test_odd_vectors_are_not_scored(spark, clustered):
    nan = float("nan")
    good = [(i, [float(x) for x in row], 0) for i, row in enumerate(clustered[:8])]
    odd = [(100, [nan] * 8, 0), (101, None, 0), (102, [1.0] * 7 + [None], 0), (103, [float("inf")] + [1.0] * 7, 0)]
    df = spark.createDataFrame(good + odd, SCHEMA)
    queries = [(0, good[3][1]), (1, good[5][1]), (2, None), (3, [nan] * 8)]
    asked = spark.createDataFrame(queries, "query_id INT, embedding ARRAY<FLOAT>")
    batch = {(r.query_id, r["rank"], r.hit_id) for r in batch_hits(df, asked, 4).collect()}
    single = {(q, i + 1, r.vec_id) for q, v in queries[:2] for i, r in enumerate(top_hits(df, v, 4).collect())}
    assert batch == single and len(batch) == 8
    assert {(r.left_id, r.right_id) for r in similar_pairs(df, -1.0).collect()} == {(i, j) for i in range(8) for j in range(i + 1, 8)}


def test_unequal_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0], 0), (2, [1.0] * 5, 0)], SCHEMA)
    with pytest.raises(Exception, match="differ in length"):
        top_hits(df, [1.0] * 4).collect()
    with pytest.raises(Exception, match="differ in length"):
        batch_hits(df, spark.createDataFrame([(1, [1.0] * 4)], "query_id INT, embedding ARRAY<FLOAT>")).collect()


def test_copies_are_paired_with_themselves(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0)], SCHEMA)
    assert [tuple(r) for r in similar_pairs(df, 0.9).collect()] == [(1, 1, 1.0, 2, 2)]


def test_search_by_text_or_vector(spark):
    texts = ["the dog plays in the park", "a puppy in the park", "stocks fell today"]
    index = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "chunk_id STRING, content STRING").withColumn(
        "embedding", models.embed(F.col("content")))
    best = similarity_search(index, ["content"], text="dog in the park", k=2).collect()
    assert [r.content for r in best] == texts[:2]
    query = [float(x) for x in models.HashingEncoder().encode([texts[2]])[0]]
    for approximate in (False, True):
        assert similarity_search(index, ["chunk_id"], vector=query, k=1, approximate=approximate).first().chunk_id == "2"
    with pytest.raises(ValueError):
        similarity_search(index, ["chunk_id"])


def test_few_rows_are_sent_and_many_are_not(spark):
    assert "broadcast" in sent_if_few(spark.range(10), 10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in sent_if_few(spark.range(11), 10)._jdf.queryExecution().analyzed().toString()
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS t", "array(id) AS a")
    assert "broadcast" in sent_if_few(wide, 10, 11_000)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in sent_if_few(wide, 10, 10_000)._jdf.queryExecution().analyzed().toString()


def test_approximate_recall(spark, clustered, tmp_path):
    df = vectors(spark, clustered)
    query = [float(x) for x in clustered[0]]
    exact = {r.vec_id for r in top_hits(df, query, 10).collect()}
    stored = str(tmp_path / "index")
    with_buckets(df, 8).write.partitionBy("bucket").parquet(stored)
    hits = approximate_hits(spark.read.parquet(stored), query, 10)
    assert "PartitionFilters: [bucket" in hits._jdf.queryExecution().executedPlan().toString()
    found = hits.collect()
    assert found == approximate_hits(df, query, 10).collect()
    assert len(exact & {r.vec_id for r in found}) >= 7 and found[0].score == pytest.approx(1.0)


def test_recall_of_the_given_vectors(spark):
    """At least nine tenths, and just what the approximate search finds."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").cache()
    asked = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    width = len(df.first().embedding)
    for k in (4, 10):
        r = recall(df, asked, width, k).first()
        assert r.hits == k * asked.count() and r.right >= 0.9 * r.hits
    two = asked.orderBy("query_id").limit(2)
    right = 0
    for q in two.collect():
        vector = [float(x) for x in q.embedding]
        right += len({x.vec_id for x in top_hits(df, vector, 10).collect()} & {x.vec_id for x in approximate_hits(df, vector, 10).collect()})
    assert recall(df, two, width, 10).first().right == right


def test_ann_recall_runs_the_search_of_each_label(spark, tmp_path):
    """Each label's question goes through the approximate search, beside the measure of recall."""
    from tallyloom.plans import catalogue

    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in row], i % 3) for i, row in enumerate(rng.normal(size=(200, 64)))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = catalogue.ann_recall(spark, str(tmp_path)).orderBy("k").collect()
    assert [(r.k, r.hits, r.questions, r.returned) for r in got] == [(4, 16, 3, 12), (10, 40, 3, 12)]


def test_one_question_is_scored_in_batches(spark, clustered):
    """Not number by number in the JVM; odd vectors of a slice are passed over."""
    nan = float("nan")
    odd = spark.createDataFrame([(1000, [nan] * 8, 0), (1001, None, 0), (1002, [1.0] * 7 + [None], 0), (1003, [float("inf")] + [1.0] * 7, 0)], SCHEMA)
    hits = top_hits(vectors(spark, clustered).unionAll(odd).repartition(1), [float(x) for x in clustered[9]], 600)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "zip_with" not in plan
    assert {(0, i + 1, r.vec_id) for i, r in enumerate(hits.collect())} == best(cosines(clustered[9:10], clustered), 600)


def test_blocks_grow_with_the_table_and_meet_in_strips(spark, clustered, monkeypatch):
    for name, value in (("BLOCK_ROWS", 4), ("BLOCKS", 3), ("MOST_BLOCK_ROWS", 64), ("HELD_SCORES", 50)):
        monkeypatch.setattr(retrieval, name, value)
    data = clustered[::3]
    scores = cosines(data, data)
    want = {(i, j) for i in range(len(data)) for j in range(i + 1, len(data)) if scores[i, j] >= -0.5}
    rows = similar_pairs(vectors(spark, data), -0.5).collect()
    assert len(rows) == len(want) and {(r.left_id, r.right_id) for r in rows} == want

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import codes
from tallyloom.operators.codes import candidates, coded_hits, rows_of, with_codes, write_index

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def frame(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], SCHEMA)


def asked(spark, matrix):
    return frame(spark, matrix).withColumnRenamed("vec_id", "query_id")


def best(data, queries, k):
    a, b = (m.astype(np.float32).astype(float) for m in (data, queries))
    a, b = (m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-10) for m in (a, b))
    scores = np.round(b @ a.T, 9)
    return {(q, r + 1, int(i)) for q, row in enumerate(scores) for r, i in enumerate(np.lexsort((np.arange(len(row)), -row))[:k])}


def found(df):
    return {(r.query_id, r["rank"], r.hit_id) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    spread, centre = rng.normal(size=(600, 24)), rng.normal(size=24)
    return np.concatenate([spread, centre + rng.normal(scale=1e-3, size=(200, 24)), np.repeat(spread[:1], 50, axis=0), np.zeros((3, 24))])


def index_of(spark, data, path, page_rows=100):
    write_index(frame(spark, data), str(path), page_rows=page_rows)
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("sent, held, named", [(10**9, 10**9, 200), (50, 300, 5)])
def test_hits_are_exact(spark, data, tmp_path, monkeypatch, sent, held, named):
    """Spread vectors, ones closer than a step of their codes, copies, and zeros; the second case slices everything."""
    for name, value in (("SENT_NUMBERS", sent), ("HELD_SCORES", held), ("NAMED", named)):
        monkeypatch.setattr(codes, name, value)
    queries = np.concatenate([data[::150], data[700:701], data[-1:]])
    index = index_of(spark, data, tmp_path / "index")
    for k in (1, 7, 2000):
        assert found(coded_hits(index, asked(spark, queries), k)) == best(data, queries, k)


def test_codes_bound_scores(spark, data):
    rows = with_codes(frame(spark, data)).collect()
    query = data[5] / np.linalg.norm(data[5])
    for r in rows:
        v = np.array(r.embedding)
        v = v / (np.linalg.norm(v) + 1e-10)
        assert abs(r.step * (np.frombuffer(r.code, np.int8) @ query) - v @ query) <= r.lost + 1e-12 and r.lost < 0.05
    assert [(r.step, r.lost) for r in rows[-3:]] == [(0.0, 0.0)] * 3


def test_few_rows_are_read(spark, tmp_path):
    """Codes alone are scanned, what they leave in doubt is little, and looking it up reads few pages."""
    data = np.random.default_rng(4).normal(size=(20_000, 32))
    index = index_of(spark, data, tmp_path / "index")
    may = candidates(index, asked(spark, data[:1]), 10)
    assert 10 <= may.count() <= 30
    first = codes._may_be_best(index, asked(spark, data[:1]).select("query_id", F.col("embedding").alias("q")), 10, "vec_id",
                               "query_id long, hit_id long, low double, high double")
    assert "embedding" not in first._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    rows = rows_of(index, may)
    assert {r.vec_id for r in rows.collect()} == {r.hit_id for r in may.collect()}
    leaf = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() <= 0.3 * len(data)


def test_odd_rows(spark, data, tmp_path):
    nan = float("nan")
    odd = [(900, None), (901, [nan] * 24), (902, [1.0] * 23 + [None]), (903, [float("inf")] * 24)]
    good = [(i, [float(x) for x in row]) for i, row in enumerate(data[:20])]
    write_index(spark.createDataFrame(good + odd, SCHEMA).withColumn("step_name", F.lit("x")), str(tmp_path / "odd"))
    index = spark.read.parquet(str(tmp_path / "odd"))
    queries = spark.createDataFrame([*good[:2], *odd], "query_id BIGINT, embedding ARRAY<FLOAT>")
    assert found(coded_hits(index, queries, 4)) == best(data[:20], data[:2], 4)
    assert coded_hits(index, queries.limit(0)).count() == 0
    empty = index_of(spark, data[:0], tmp_path / "none")
    assert coded_hits(empty, queries).columns == ["query_id", "rank", "hit_id", "score"] and coded_hits(empty, queries).count() == 0
    with pytest.raises(Exception, match="differ in length"):
        coded_hits(index, asked(spark, data[:1, :5])).collect()


def test_other_types(spark, data, tmp_path):
    named = frame(spark, data[:30]).select(F.format_string("id %03d", "vec_id").alias("key"), F.col("embedding").cast("array<double>").alias("v"))
    write_index(named, str(tmp_path / "named"), "v", "key")
    got = coded_hits(spark.read.parquet(str(tmp_path / "named")), named.where("key = 'id 004'").withColumnRenamed("key", "query_id"), 1, "v", "key").first()
    assert (got.hit_id, got.score) == ("id 004", 1.0)


def test_a_task_holds_few_scores():
    """About eight matrices of scores are held side by side, so a worker needs tens of MB for them."""
    assert 8 * 8 * codes.HELD_SCORES <= 64_000_000

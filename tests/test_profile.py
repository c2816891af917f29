import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest

from tallyloom.operators import profile as profiles
from tallyloom.operators.profile import inferred_keys, profile_table, with_declared_keys

BUOYS = [("Skerry", 57.25, -6.125), ("Old Tom", 51.5, 0.75), ("O'Rourke's", 53.375, -9.5), ("North \"Q\"", 60.0, 1.25), ("Mudflat", 52.625, 2.5)]


def columns(df):
    return {r.column_name: r for r in df.collect()}


def test_small_profile(spark):
    got = columns(profile_table(spark.createDataFrame(BUOYS, ["buoy", "north", "east"]), "f"))
    for name, values in (("north", [b[1] for b in BUOYS]), ("east", [b[2] for b in BUOYS])):
        r = got[name]
        assert (r.min_number, r.max_number, r.median) == (min(values), max(values), statistics.median(values))
        assert (r.mean, r.stddev) == (round(statistics.fmean(values), 4), round(statistics.stdev(values), 4))
    assert got["buoy"].is_inferred_primary_key and not got["north"].is_inferred_primary_key
    assert {(v.value, v.n) for v in got["buoy"].value_counts} == {(b[0], 1) for b in BUOYS}


@pytest.mark.parametrize("bins", [4, 64])
def test_no_task_ranks_more_than_its_bound(spark, monkeypatch, bins):
    """Brackets are narrowed by counting until they hold few rows or one value; medians stay exact."""
    monkeypatch.setattr(profiles, "MAX_RANKED", 40)
    monkeypatch.setattr(profiles, "BINS", bins)
    rng = random.Random(12)
    rows = [(rng.gauss(1e6, 1), rng.choice([3, 3, 3, 9, rng.randrange(1000)]), rng.random() if i % 9 == 0 else None, float("nan") if i % 3 else float(i), 2.5 ** rng.randrange(300))
            for i in range(20001)]
    df = spark.createDataFrame(rows, "x DOUBLE, hot INT, sparse DOUBLE, odd DOUBLE, far DOUBLE").repartition(5)
    got = columns(profile_table(df, "t"))
    for i, name in enumerate(("x", "hot", "sparse")):
        assert got[name].median == statistics.median_low([r[i] for r in rows if r[i] is not None])
    assert got["far"].median == statistics.median_low([r[4] for r in rows])
    numbers = profiles.profiled_columns(df)
    brackets = profiles._narrowed(df, numbers, profiles._brackets(df, numbers, len(rows)))
    for i, c in enumerate(numbers):
        if c.name != "odd":
            inside = [r[i] for r in rows if r[i] is not None and brackets[i][0] <= r[i] <= brackets[i][1]]
            assert len(inside) <= 40 or len(set(inside)) <= 2


def test_words_the_estimate_took_for_many_are_listed(spark, monkeypatch):
    monkeypatch.setattr(profiles, "MAYBE_CATEGORY", 0.06)  # as if the sketch were far off
    got = columns(profile_table(spark.createDataFrame([(f"w{i % 20}",) for i in range(100)], "a STRING"), "t"))
    assert len(got["a"].value_counts) == 10 and not got["a"].high_cardinality


def test_all_types(spark):
    rows = [
        (i, i % 3 == 0 if i % 5 else None, Decimal(i % 4) / 4, dt.date(2024, 1, 1 + i % 28), dt.datetime(2024, 1, 1, i % 24, 0, 0, i),
         f"w{i % 7}", bytes([i % 2]), [i % 3], {"a": i % 2, "b": 1}, None) for i in range(100)]
    df = spark.createDataFrame(rows, "i BIGINT, flag BOOLEAN, price DECIMAL(12,2), day DATE, at TIMESTAMP, word STRING,"
                                     "raw BINARY, list ARRAY<INT>, map MAP<STRING, INT>, nothing STRING")
    got = columns(profile_table(df, "t"))
    assert {c: r.distinct_count for c, r in got.items()} == {
        "i": 100, "flag": 2, "price": 4, "day": 28, "at": 100, "word": 7, "raw": 2, "list": 3, "map": 2, "nothing": 0}
    assert {c: r.kind for c, r in got.items() if r.kind != "categorical"} == {
        "i": "numerical", "price": "numerical", "day": "temporal", "at": "temporal"}
    assert (got["day"].min_time, got["day"].max_time) == ("2024-01-01", "2024-01-28")
    assert got["at"].max_time == "2024-01-01 23:00:00.000095" and got["price"].data_type == "DECIMAL"
    assert (got["price"].min_number, got["price"].max_number, got["price"].median) == (0.0, 0.75, 0.25)
    assert got["flag"].null_count == 20 and got["flag"].null_pct == 20.0
    assert [(v.value, v.n) for v in got["flag"].value_counts] == [("false", 53), ("true", 27)]
    assert got["nothing"].value_counts == [] and got["nothing"].null_pct == 100.0 and not got["nothing"].high_cardinality
    assert got["word"].value_counts[0].value == "w0" and got["word"].value_counts[0].n == 15


def test_odd_names_and_values(spark):
    df = spark.sql("""
        SELECT CAST(x AS DOUBLE) AS `a.b``c`, INTERVAL '1' DAY * i AS gap, named_struct('k', i % 2) AS `s p`
        FROM VALUES ('NaN', 1), ('NaN', 2), ('-0.0', 3), ('0.0', 4), ('Infinity', 5) AS t(x, i)""")
    got = columns(profile_table(df, "t"))
    assert {c: r.distinct_count for c, r in got.items()} == {"a.b`c": 3, "gap": 5, "s p": 2}
    assert got["a.b`c"].min_number == 0.0 and got["gap"].kind == "categorical"
    assert [(v.value, v.n) for v in got["s p"].value_counts] == [('{"k":1}', 3), ('{"k":0}', 2)]


def test_empty_table(spark):
    got = columns(profile_table(spark.createDataFrame([], "id INT, word STRING"), "t"))
    assert [(r.row_count, r.null_pct, r.distinct_count, r.is_inferred_primary_key) for r in got.values()] == [(0, 0.0, 0, False)] * 2
    assert got["word"].value_counts == []


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    values = [rng.choice([7.5, 7.5, rng.gauss(1e9, 1), rng.uniform(-5, 5), float(rng.randrange(50))]) for _ in range(30001)]
    few = [rng.randrange(10**6) for _ in range(30001)]
    df = spark.createDataFrame(list(zip(values, few)), "x DOUBLE, y BIGINT").repartition(7)
    got = columns(profile_table(df, "t"))
    for name, data in (("x", values), ("y", few)):
        assert got[name].distinct_count == len(set(data))
        assert got[name].median == statistics.median_low(data)
        assert got[name].mean == pytest.approx(statistics.fmean(data), rel=1e-9)
        assert got[name].stddev == pytest.approx(statistics.stdev(data), rel=1e-9)


@pytest.mark.parametrize("errors", [6, 0, -1])
def test_sampled_brackets(spark, monkeypatch, errors):
    """Too narrow a bracket misses some medians: they are found from all rows instead."""
    monkeypatch.setattr(profiles, "SAMPLE_ROWS", 500)
    monkeypatch.setattr(profiles, "SAMPLE_ERRORS", errors)
    rng = random.Random(9)
    rows = [(rng.gauss(0, 1), rng.choice([3, 3, 3, 9, rng.randrange(1000)]), rng.random() if i % 400 == 0 else None) for i in range(20001)]
    got = columns(profile_table(spark.createDataFrame(rows, "x DOUBLE, hot INT, sparse DOUBLE").repartition(5), "t"))
    for i, name in enumerate(("x", "hot", "sparse")):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[name].median == statistics.median_low(values)
        assert (got[name].distinct_count, got[name].null_count) == (len(set(values)), len(rows) - len(values))


def test_spread_far_from_zero_keeps_its_digits(spark):
    df = spark.createDataFrame([(1e12 + i,) for i in range(5)], "x DOUBLE")
    assert columns(profile_table(df, "t"))["x"].stddev == 1.5811


def test_long_text_that_is_a_category_is_listed_whole(spark):
    long = ["x" * 5000 + str(i % 3) for i in range(30)]
    many = ["y" * 5000 + str(i) for i in range(300)]
    got = columns(profile_table(spark.createDataFrame(zip(long * 10, many), "a STRING, b STRING"), "t"))
    assert [v.value for v in got["a"].value_counts] == sorted(set(long))
    assert got["b"].high_cardinality and got["b"].distinct_count == 300
    assert got["b"].note.startswith("300 unique values across 300 rows")


@pytest.mark.parametrize("exact", [True, False])
def test_limits_are_arguments(spark, exact):
    df = spark.createDataFrame([(str(i % 60), str(i % 70)) for i in range(4200)], "a STRING, b STRING")
    got = columns(profile_table(df, "t", exact, profiles.Limits(category=60, values=25)))
    assert len(got["a"].value_counts) == 25 and got["b"].high_cardinality


def test_category_limit_is_exact(spark):
    df = spark.createDataFrame([(str(i % 50), str(i % 51)) for i in range(510)], "a STRING, b STRING")
    got = columns(profile_table(df, "t"))
    assert not got["a"].high_cardinality and len(got["a"].value_counts) == 10
    assert got["b"].high_cardinality and got["b"].value_counts is None


def test_wide_tables_take_several_scans(spark, monkeypatch):
    monkeypatch.setattr(profiles, "COLUMNS_PER_SCAN", 4)
    df = spark.range(20).selectExpr(*[f"id * {i} AS c{i}" for i in range(1, 11)])
    got = columns(profile_table(df, "t"))
    assert len(got) == 10 and all(r.distinct_count == 20 for r in got.values())
    assert [r.max_number for r in got.values()] == [19.0 * i for i in range(1, 11)]


def test_estimates_stay_close(spark):
    df = spark.range(20000).selectExpr("id AS n", "CAST(id % 13 AS STRING) AS word", "CAST(id AS STRING) AS key")
    got = columns(profile_table(df, "t", exact=False))
    assert got["n"].distinct_count == pytest.approx(20000, rel=0.15) and got["n"].median == pytest.approx(10000, rel=0.01)
    assert got["word"].distinct_count == 13 and len(got["word"].value_counts) == 10
    assert got["key"].high_cardinality and (got["n"].min_number, got["n"].max_number) == (0.0, 19999.0)


def test_key_inference_prefers_id_names(spark):
    df = spark.createDataFrame([(1, 10, 5), (2, 20, 5)], "valid INT, order_id INT, x INT")
    assert inferred_keys(profile_table(df, "t")).first().inferred_primary_key == "order_id"
    df = spark.createDataFrame([(1, 7), (2, 7)], "grid INT, x INT")
    assert inferred_keys(profile_table(df, "t")).first().inferred_primary_key == "grid"


def test_declared_keys(spark):
    p = profile_table(spark.createDataFrame([(1, 2)], "order_id INT, customer_id INT"), "orders")
    got = columns(with_declared_keys(p, {"orders": ["order_id"]}, {"orders": {"customer_id": "customers.customer_id"}}))
    assert (got["order_id"].is_primary_key, got["order_id"].is_foreign_key) == (True, False)
    assert got["customer_id"].is_foreign_key and got["customer_id"].references == "customers.customer_id"


def test_columns_of_large_stored_tables_are_counted_apart(spark, tmp_path, monkeypatch):
    """The same profile from a scan of each column, where no row is made for a cell."""
    monkeypatch.setattr(profiles, "MAX_RANKED", 40)
    rng = random.Random(5)
    rows = [(i, rng.choice([3, 3, 9, None, rng.randrange(500)]), rng.choice([0.0, -0.0, float("nan"), rng.random(), None]), f"w{i % 7}" if i % 5 else None,
             "x" * 300 + str(i), dt.date(2024, 1, 1 + i % 28), Decimal(i % 9) / 4, None) for i in range(2000)]
    spark.createDataFrame(rows, "i BIGINT, hot INT, part DOUBLE, word STRING, long STRING, day DATE, price DECIMAL(9,2), nothing INT").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = columns(profile_table(df, "t", columnar=True))
    plans, plain = [], type(df).collect
    monkeypatch.setattr(profiles, "APART_ROWS", 2000)
    monkeypatch.setattr(type(df), "collect", lambda f: plans.append(f._jdf.queryExecution().executedPlan().toString()) or plain(f))
    apart = profile_table(df, "t", columnar=True)
    assert plans and not any("Expand" in p for p in plans)
    plans.clear()
    profile_table(df, "t")
    assert any("Expand" in p for p in plans)
    monkeypatch.undo()
    assert {k: str(v) for k, v in columns(apart).items()} == {k: str(v) for k, v in before.items()}

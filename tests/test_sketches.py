import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sketches
from tallyloom.operators.profile import Limits, profile_table
from tallyloom.operators.sketches import merged_profile, update_states

SCHEMA = "id BIGINT, price DOUBLE, `a.b` STRING, word STRING, day DATE, flag BOOLEAN, none INT"


def rows(spark, low, high):
    return spark.range(low, high, 1, 4).select(
        "id", F.when(F.col("id") % 7 != 0, 1e6 + (F.col("id") * 37 % 1001) / 8).alias("price"), F.concat(F.lit("k"), F.col("id") % 5).alias("a.b"),
        F.when(F.col("id") % 3 == 0, F.lit("most")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("word"),
        F.date_add(F.lit(datetime.date(2020, 1, 1)), (F.col("id") % 900).cast("int")).alias("day"), (F.col("id") % 2 == 0).alias("flag"), F.lit(None).cast("int").alias("none"))


def by_column(df):
    return {r.column_name: r for r in df.collect()}


def agree(merged, exact):
    """Exact fields equal, estimates within their bounds."""
    assert set(merged) == set(exact)
    for name, m in merged.items():
        e = exact[name]
        for field in ("ordinal", "kind", "row_count", "null_count", "min_number", "max_number", "mean", "stddev", "min_time", "max_time", "value_counts"):
            assert m[field] == e[field], (name, field, m[field], e[field])
        assert abs(m.distinct_count - e.distinct_count) <= 0.04 * e.distinct_count


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "table of rows"), str(tmp_path / "states")


def test_grows_with_its_table(spark, places):
    folder, path = places
    rows(spark, 0, 6000).write.parquet(folder)
    assert update_states(spark, folder, path) == 4
    agree(by_column(merged_profile(spark, folder, path)), by_column(profile_table(spark.read.parquet(folder), "t")))
    rows(spark, 6000, 20_000).write.mode("append").parquet(folder)
    assert update_states(spark, folder, path) == 4 and update_states(spark, folder, path) == 0
    merged = by_column(merged_profile(spark, folder, path))
    agree(merged, by_column(profile_table(spark.read.parquet(folder), "t")))
    for name in ("id", "price"):
        got = spark.read.parquet(folder).select(F.avg((F.col(name) < merged[name].median).cast("int")), F.avg((F.col(name) <= merged[name].median).cast("int"))).first()
        assert got[0] <= 0.51 and got[1] >= 0.49  # nulls do not count
    assert merged["none"].median is None and merged["word"].value_counts is None and len(merged["a.b"].value_counts) == 5


def test_rewritten_and_lost_files(spark, places):
    folder, path = places
    rows(spark, 0, 500).write.parquet(folder)
    update_states(spark, folder, path)
    rows(spark, 100, 900).write.mode("overwrite").parquet(folder)
    assert update_states(spark, folder, path) == 4
    agree(by_column(merged_profile(spark, folder, path)), by_column(profile_table(spark.read.parquet(folder), "t")))
    spark.read.schema(sketches.STATE).parquet(path).write.mode("append").parquet(path + "2")  # states that were written twice count once
    spark.read.schema(sketches.STATE).parquet(path).write.mode("append").parquet(path + "2")
    assert by_column(merged_profile(spark, folder, path + "2"))["id"].row_count == 800


def test_empty_tables_and_one_file(spark, places):
    folder, path = places
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(folder)
    update_states(spark, folder, path)
    assert update_states(spark, folder, path) <= 1
    assert all(r.row_count == 0 for r in merged_profile(spark, folder, path).collect())
    with pytest.raises(ValueError):
        merged_profile(spark, folder, path, Limits(category=251))
    update_states(spark, "/root/testdata/sf0.001/orders.parquet", path + "3")
    merged = by_column(merged_profile(spark, "/root/testdata/sf0.001/orders.parquet", path + "3"))
    agree(merged, by_column(profile_table(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "t")))

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalars
from tallyloom.operators.report import distinct_values, monthly_trend, value_counts
from tallyloom.sources.catalog import not_empty


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_numbers_as_text(spark):
    shown = {0.0: "0.0", 5.25: "5.25", 1e7: "10000000.0", -12345678.5: "-12345678.5", 1000.0: "1000.0", 0.125: "0.125"}
    for x, text in shown.items():
        assert one(spark, scalars.plain_number(F.lit(x))) == text
    assert one(spark, scalars.plain_number(F.lit(1e300))) == "1.0E300"
    assert one(spark, scalars.plain_number(F.lit(None).cast("double"))) is None


def test_percent_preview_label_month(spark):
    assert one(spark, scalars.percent(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, scalars.percent(F.lit(0), F.lit(0))) == 0.0
    assert one(spark, scalars.preview(F.lit("x" * 200))) == "x" * 160 + "..."
    assert one(spark, scalars.preview(F.lit("short"))) == "short..."
    assert one(spark, scalars.short_label(F.lit("x" * 28))) == "x" * 28
    assert one(spark, scalars.short_label(F.lit("x" * 29))) == "x" * 28 + "..."
    assert one(spark, scalars.month_of(F.lit(dt.date(2024, 3, 9)))) == "2024-03"


def test_counts_trends_and_empty_frames(spark):
    df = spark.createDataFrame([("b", dt.date(2024, 1, 5)), ("a", None), ("b", dt.date(2024, 1, 9)), (None, dt.date(2023, 12, 1))],
                               "word STRING, day DATE")
    assert [tuple(r) for r in value_counts(df, "word").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in monthly_trend(df, "day").collect()] == [(None, 1), ("2023-12", 1), ("2024-01", 2)]
    assert [r[0] for r in distinct_values(df, "word").collect()] == [None, "a", "b"]
    assert not_empty(df, "words") is df
    with pytest.raises(ValueError, match="words has no rows"):
        not_empty(df.limit(0), "words")

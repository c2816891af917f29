"""Report datasets, example questions, schema text and the data dictionary.

All of them read the profile, which has one row per column of the data. Only the monthly
trends go back to the tables, with one small aggregate each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.identifiers import id_like
from tallyloom.functions.scalars import month_of, plain_number

# How much a report shows.
CATEGORY_CHARTS = 2
MAX_QUESTIONS = 6
SAMPLE_VALUES = 4
DICTIONARY_VALUES = 5

# The wording of the four example questions.
QUESTION_TOP = "What are the top 5 %s values in `%s` by total %s?"
QUESTION_RANGE = "What's the range and average %s in `%s`?"
QUESTION_TREND = "How does the row count in `%s` trend over %s?"
QUESTION_SPLIT = "How many rows fall into each %s category in `%s`?"


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent non-null values."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def monthly_trend(df: DataFrame, column: str) -> DataFrame:
    """Row count per calendar month. Rows without a date form the null period."""
    return df.groupBy(month_of(F.col(column)).alias("period")).agg(F.count(F.lit(1)).alias("n")).orderBy("period")


def _category() -> Column:
    return (F.col("kind") == "categorical") & ~F.col("high_cardinality")


def chart_columns(profile: DataFrame, limit: int = CATEGORY_CHARTS) -> DataFrame:
    """Per table the first categories worth a bar chart, and the first temporal column."""
    bar = _category() & ~F.col("is_inferred_primary_key") & (F.col("distinct_count") >= 2)
    chart = F.when(bar, "top").when(F.col("kind") == "temporal", "trend")
    first = F.row_number().over(Window.partitionBy("table_name", "chart").orderBy("ordinal"))
    return (
        profile.withColumn("chart", chart).where(F.col("chart").isNotNull()).withColumn("place", first)
        .where(F.col("place") <= F.when(F.col("chart") == "top", limit).otherwise(1))
        .select("table_name", "column_name", "chart", "place"))


def report_datasets(profile: DataFrame, tables: dict[str, DataFrame], limit: int | None = None,
                    charts_per_table: int = CATEGORY_CHARTS) -> DataFrame:
    """Every dataset of the report in one frame (dataset, label, n): row counts, top values
    and monthly trends. Counts and top values are taken from the profile as they are. All
    tables are covered, or the first ``limit`` by name; then the row ``ds_not_shown`` says how
    many are left out."""
    names = [r.table_name for r in profile.select("table_name").distinct().orderBy("table_name").collect()]
    covered = names[:limit]
    profile = profile.where(F.col("table_name").isin(covered))
    charts = chart_columns(profile, charts_per_table)
    rows = profile.where(F.col("ordinal") == 0).select(
        F.format_string("ds_%s_rows", "table_name").alias("dataset"),
        F.lit(None).cast("string").alias("label"), F.col("row_count").alias("n"))
    tops = (
        profile.join(charts.where(F.col("chart") == "top").select("table_name", "column_name"),
                     ["table_name", "column_name"])
        .select(F.format_string("ds_%s_%s_top", "table_name", "column_name").alias("dataset"), F.inline("value_counts"))
        .toDF("dataset", "label", "n"))
    trends = [
        monthly_trend(tables[r.table_name], r.column_name).select(
            F.lit(f"ds_{r.table_name}_{r.column_name}_trend").alias("dataset"), F.col("period").alias("label"), "n")
        for r in charts.where(F.col("chart") == "trend").collect()]
    left_out = [profile.sparkSession.createDataFrame([("ds_not_shown", None, len(names) - len(covered))], rows.schema)]
    return reduce(DataFrame.unionByName, [rows, tops, *trends, *(left_out if len(covered) < len(names) else [])])


def question_columns(profile: DataFrame) -> DataFrame:
    """Per table the first category, measure and temporal column, one row per table. Keys
    and identifiers are no measures, and free text is no category."""
    measure = (F.col("kind") == "numerical") & ~F.col("is_inferred_primary_key") & ~id_like(F.col("column_name"))

    def first(condition: Column) -> Column:
        return F.min_by(F.when(condition, F.col("column_name")), F.when(condition, F.col("ordinal")))

    return profile.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"), first(_category()).alias("category"),
        first(measure).alias("measure"), first(F.col("kind") == "temporal").alias("moment"))


def example_questions(profile: DataFrame, limit: int = MAX_QUESTIONS) -> DataFrame:
    """The first questions, largest table first, without repeats."""
    category, measure, moment, table = (F.col(c) for c in ("category", "measure", "moment", "table_name"))
    asked = F.array(
        F.when(category.isNotNull() & measure.isNotNull(), F.format_string(QUESTION_TOP, category, table, measure)),
        F.when(measure.isNotNull(), F.format_string(QUESTION_RANGE, measure, table)),
        F.when(moment.isNotNull(), F.format_string(QUESTION_TREND, table, moment)),
        F.when(category.isNotNull(), F.format_string(QUESTION_SPLIT, category, table)))
    rows = question_columns(profile).select("row_count", "table_name", F.posexplode(asked).alias("template", "question"))
    first = rows.where(F.col("question").isNotNull()).groupBy("question").agg(
        F.min(F.struct((-F.col("row_count")).alias("size"), "table_name", "template")).alias("place"))
    place = F.row_number().over(Window.orderBy("place"))  # at most four rows per table
    return first.orderBy("place").limit(limit).select(place.alias("place"), "question")


def _listed(n: int, render) -> Column:
    return F.concat_ws(", ", F.transform(F.slice("value_counts", 1, n), render))


def _by_column(profile: DataFrame, line: Column) -> Column:
    """The lines of one table's columns in column order."""
    return F.transform(F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line")))), lambda r: r["line"])


def schema_text(profile: DataFrame, schema: str, samples: int = SAMPLE_VALUES) -> DataFrame:
    """One row: a compact description of the tables, for a prompt."""
    detail = (
        F.when(_category(), F.concat(F.lit("): e.g. "), _listed(samples, lambda v: v["value"])))
        .when(F.col("kind") == "temporal", F.concat(
            F.lit("): "), F.coalesce("min_time", F.lit("none")), F.lit(" to "), F.coalesce("max_time", F.lit("none"))))
        .otherwise(F.lit(")")))
    line = F.concat(F.lit("  - "), F.col("column_name"), F.lit(" ("), F.col("kind"), detail)
    head = F.format_string("\nTable `%s` (%d rows):", "table_name", F.col("row_count"))
    tables = profile.withColumn("line", line).groupBy("table_name", "row_count").agg(
        _by_column(profile, F.col("line")).alias("lines")).select(
        "table_name", F.concat_ws("\n", F.array(head), F.col("lines")).alias("text"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("table_name", "text"))), lambda r: r["text"])
    return tables.agg(F.concat_ws("\n", F.array(F.lit(f"Schema: {schema}")), texts).alias("schema_text"))


def _dictionary_summary(shown: int) -> Column:
    def named(label: str, column: str) -> Column:
        return F.concat(F.lit(f"{label}="), F.coalesce(plain_number(F.col(column)), F.lit("None")))

    numbers = F.concat_ws(", ", named("min", "min_number"), named("max", "max_number"), named("mean", "mean"),
                          named("median", "median"), named("stddev", "stddev"))
    times = F.concat(F.lit("range: "), F.coalesce("min_time", F.lit("None")), F.lit(" to "),
                     F.coalesce("max_time", F.lit("None")))
    values = _listed(shown, lambda v: F.concat(v["value"], F.lit(" ("), v["n"].cast("string"), F.lit(")")))
    return (
        F.when(F.col("kind") == "numerical", numbers).when(F.col("kind") == "temporal", times)
        .when(F.col("high_cardinality"), F.col("note")).otherwise(values))


def data_dictionary(profile: DataFrame, values: int = DICTIONARY_VALUES) -> DataFrame:
    """One row per table with its section of the markdown data dictionary. Works on inferred
    and on declared keys."""
    declared = "is_primary_key" in profile.columns
    if declared:
        mark = F.when(F.col("is_primary_key"), " (PK)").when(F.col("is_foreign_key"), " (FK)").otherwise("")
        primary, label = F.col("is_primary_key"), "- Primary key: `%s`"
        points = F.when(F.col("is_foreign_key"), F.concat(
            F.lit("`"), F.col("column_name"), F.lit("` -> `"), F.col("references"), F.lit("`")))
    else:
        mark = F.when(F.col("is_inferred_primary_key"), " (PK, inferred)").otherwise("")
        primary, label = F.col("is_inferred_primary_key"), "- Inferred primary key: `%s` (heuristic, not a declared constraint)"
        points = F.lit(None).cast("string")
    line = F.concat(
        F.lit("| "), F.col("column_name"), mark, F.lit(" | "), F.col("kind"), F.lit(" | "),
        F.format_string("%.2f", F.col("null_pct")), F.lit("% | "), F.col("distinct_count").cast("string"),
        F.lit(" | "), _dictionary_summary(values), F.lit(" |"))
    rows = profile.select(
        "table_name", "ordinal", "row_count", "column_count", line.alias("line"),
        F.when(primary, F.col("column_name")).alias("key"), points.alias("points"))
    keys = F.concat_ws(", ", _by_column(rows, F.col("key")))
    links = F.concat_ws(", ", _by_column(rows, F.col("points")))
    sections = rows.groupBy("table_name", "row_count", "column_count").agg(
        _by_column(rows, F.col("line")).alias("lines"), keys.alias("keys"), links.alias("links"))
    head = F.array_compact(F.array(
        F.format_string("## %s", "table_name"),
        F.format_string("- Rows: %d  |  Columns: %d", F.col("row_count"), F.col("column_count")),
        F.when(F.col("keys") != "", F.format_string(label, "keys")),
        F.when(F.col("links") != "", F.concat(F.lit("- Foreign keys: "), F.col("links"))),
        F.lit(""), F.lit("| Column | Kind | Null % | Distinct | Summary |"), F.lit("|---|---|---|---|---|")))
    return sections.select("table_name", F.concat_ws("\n", F.concat(head, F.col("lines"))).alias("section")).orderBy("table_name")

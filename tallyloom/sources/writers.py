"""Where results go: managed tables, JSON, markdown, text and relational databases."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators.constraints import load_order


def save_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Create or replace a managed table, whatever its former columns."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def reconcile(loaded: dict[str, DataFrame], source_rows: dict[str, int]) -> DataFrame:
    """(table_name, loaded_rows, source_rows, status). A mismatch is reported, not raised."""
    counts = reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("loaded_rows")).select(F.lit(table).alias("table_name"), "loaded_rows",
                                                              F.lit(source_rows[table]).cast("bigint").alias("source_rows"))
        for table, df in loaded.items()])
    return counts.withColumn(
        "status", F.when(F.col("loaded_rows") == F.col("source_rows"), "OK").otherwise("MISMATCH"))


def write_profile(profile: DataFrame, path: str) -> None:
    """The flat profile as parquet (to read back) and nested as JSON, a folder per table."""
    profile.write.mode("overwrite").parquet(f"{path}/parquet")
    fields = [F.col(c) for c in profile.columns if c not in ("table_name", "row_count", "column_count")]
    nested = profile.groupBy("table_name", "row_count", "column_count").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("columns"))
    nested.write.mode("overwrite").partitionBy("table_name").json(f"{path}/json")


def write_text(df: DataFrame, column: str, path: str, heading: str | None = None, marked: bool = False) -> None:
    """A few lines or sections as one text file, under a heading and as a list if asked for."""
    line = F.concat(F.lit("- "), F.col(column)) if marked else F.col(column)
    lines = df.select(line.alias("line"), F.monotonically_increasing_id().alias("at"))
    if heading:
        top = df.sparkSession.createDataFrame([(f"# {heading}\n", -1)], "line STRING, at BIGINT")
        lines = top.unionByName(lines)
    lines.coalesce(1).sortWithinPartitions("at").select("line").write.mode("overwrite").text(path)


def jdbc_writer(url: str, properties: dict[str, str]) -> Callable[[DataFrame, str], None]:
    """Add rows to a database table. The number of partitions of the frame is the number of
    connections."""
    def write(df: DataFrame, table: str) -> None:
        df.write.jdbc(url, table, mode="append", properties=properties)

    return write


def jdbc_emptier(spark: SparkSession, url: str, properties: dict[str, str]) -> Callable[[str], None]:
    """Take all rows out of a database table and keep its definition."""
    def empty(table: str) -> None:
        none = spark.read.jdbc(url, table, properties=properties).limit(0)
        none.write.option("truncate", "true").jdbc(url, table, mode="overwrite", properties=properties)

    return empty


def load_relational(frames: dict[str, DataFrame], foreign: dict[str, dict[str, str]],
                    write: Callable[[DataFrame, str], None], empty: Callable[[str], None]) -> list[str]:
    """Empty every table, children before parents, so that no row points at nothing; then write
    them, parents before children. Returns the order of writing. May be run again."""
    order = [t for t in load_order(foreign, frames) if t in frames]
    for table in reversed(order):
        empty(table)
    for table in order:
        write(frames[table], table)
    return order

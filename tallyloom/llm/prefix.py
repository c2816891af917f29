"""Running sums over a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import materialize


def running(df: DataFrame, order: list[Column], size: str | None = None) -> DataFrame:
    """Add ``position`` (rows before this one) and, with ``size``, ``start`` (its sum over them).

    Rows are range-partitioned in the order and written once; each partition's totals (one row a
    partition) become offsets, and a running sum inside the partition does the rest. The order must
    tell rows apart wherever they differ: a hot key is then cut into ranges like any other, and rows
    that tie are alike, so it does not matter which comes first. ``df`` may not use the names
    ``part``, ``position`` and ``start``."""
    spark = df.sparkSession
    placed = materialize(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    amount = F.col(size) if size else F.lit(0)
    totals = placed.groupBy("part").agg(F.count(F.lit(1)), F.sum(amount)).orderBy("part").collect()
    offsets, rows, sums = [], 0, 0
    for part, n, total in totals:
        offsets.append((part, rows, sums))
        rows, sums = rows + n, sums + total
    before = spark.createDataFrame(offsets, "part int, rows_before long, sum_before long")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (placed.withColumn("position", F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long"))
           .withColumn("start", F.sum(amount).over(inside) - amount)
           .join(F.broadcast(before), "part")  # a row for each partition
           .withColumn("position", F.col("position") - 1 + F.col("rows_before"))
           .withColumn("start", F.col("start") + F.col("sum_before")).drop("part", "rows_before", "sum_before"))
    return out if size else out.drop("start")

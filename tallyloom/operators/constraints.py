"""Key checks, typed loading order, and change detection between table states."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, functions as F


# Times as JSON, to the last microsecond.
WHOLE_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """How many child rows point at no parent. Child rows are counted per key before the
    join, so a key held by a third of them is one row per task in the shuffle."""
    held = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    orphans = held.join(parent.select(F.col(pk).alias("key")), "key", "left_anti")
    return orphans.agg(
        F.lit(name).alias("constraint_name"), F.count(F.lit(1)).alias("missing_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("violating_rows")
    ).select("constraint_name", "missing_keys", "violating_rows")


def pk_violations(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """How many keys occur more than once, how many rows share them, and how many rows
    have a null in the key."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).withColumn("has_null", has_null)
    repeated = ~F.col("has_null") & (F.col("n") > 1)
    return counted.agg(
        F.lit(name).alias("constraint_name"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_rows"),
        F.coalesce(F.sum(F.when(F.col("has_null"), F.col("n"))), F.lit(0)).alias("null_rows"),
    ).select("constraint_name", "repeated_keys", "repeated_rows", "null_rows")


def load_order(foreign: dict[str, dict[str, str]], tables: Iterable[str]) -> list[str]:
    """The tables with every parent before its children. ``foreign`` maps table -> column ->
    'parent.column'."""
    parents = {t: {ref.split(".")[0] for ref in foreign.get(t, {}).values()} - {t} for t in sorted(tables)}
    return list(TopologicalSorter(parents).static_order())


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The change feed between two states of a keyed table: the new row of every insert and
    update and the old row of every delete, with ``change``. Unchanged rows are left out.

    Keys and a 256-bit hash of the row meet first; whole rows are then fetched for the keys
    that changed, so wide rows are not shuffled while few of them change. A null in a key is a
    value like any other. Keys should be unique on each side: rows that share a key are compared
    with each of the other side's, and each of them is reported once if any such pair differs."""
    columns = old.columns

    def digests(df: DataFrame, name: str) -> DataFrame:
        cells = F.struct(*[F.struct(F.col(c).alias("v")) for c in columns])  # a null is an empty cell
        return df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)], F.sha2(F.to_json(cells, WHOLE_TIMES), 256).alias(name))

    keys = [f"k{i}" for i in range(len(key))]

    def same(left: DataFrame, right: list[str], *columns: str):
        return reduce(lambda a, b: a & b, [left[a].eqNullSafe(F.col(b)) for a, b in zip(columns, right)])

    change = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").when(F.col("before") != F.col("after"), "update")
    was, now = digests(old, "before"), digests(new, "after").withColumnsRenamed({k: f"new_{k}" for k in keys})
    changed = (
        was.join(now, same(was, [f"new_{k}" for k in keys], *keys), "full_outer").withColumn("change", change).where(F.col("change").isNotNull())
        .select(*[F.when(F.col("change") == "delete", F.col(k)).otherwise(F.col(f"new_{k}")).alias(k) for k in keys], "change").distinct())

    def rows(df: DataFrame, kinds: list[str]) -> DataFrame:
        return df.join(changed.where(F.col("change").isin(kinds)), same(df, keys, *key)).select("change", *columns)

    return rows(new.select(*columns), ["insert", "update"]).unionByName(rows(old, ["delete"]))

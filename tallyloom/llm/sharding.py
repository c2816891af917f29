"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.prefix import running
from tallyloom.session import materialize

# A cut inside a group of equal texts moves to the group's nearer end if that is within this share of a shard.
SLACK = 0.02


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                  slack: float = SLACK) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, text_key, shard, slot.

    Documents are laid out in the order of a 64-bit hash of the text, so equal texts are neighbours,
    and a shard is the stretch between two cuts at multiples of total / shards. A document belongs
    where its first byte lies. Slots count the rows of a shard from 0 in that order.

    Null text counts as empty (size 1). Null ids are kept. Repeated rows are rows of their own, with
    slots of their own. More shards than bytes leave some empty; an empty table gives no rows. Other
    columns are ignored, whatever their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = materialize(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key")), "sizes")
    spread = F.xxhash64("doc_id")  # cuts a group of copies into ranges like any other rows
    laid = materialize(running(narrow.withColumn("spread", spread), [F.col(c) for c in ("text_key", "spread", "doc_id")], "size"), "laid")
    total = laid.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cuts = _moved(laid, [total * k / shards for k in range(1, shards)], slack * total / shards)
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    cut_up = laid.withColumn("shard", shard)
    first = {r.shard: r.first for r in cut_up.groupBy("shard").agg(F.min("position").alias("first")).collect()}
    starts = F.array(*(F.lit(first.get(k, 0)).cast("long") for k in range(shards)))
    return cut_up.select("doc_id", "size", "text_crc32", "text_key", "shard", (F.col("position") - starts[F.col("shard")]).alias("slot"))


def _moved(laid: DataFrame, cuts: list[float], most: float) -> list[float]:
    """The cuts, those near an end of the group of equal texts they fall into moved there.
    At most one group for each cut comes to the driver."""
    if not cuts:
        return []
    hit = [(F.col("start") < c) & (F.col("start") + F.col("size") > c) for c in cuts]
    any_hit = hit[0]
    for h in hit[1:]:
        any_hit = any_hit | h
    keys = [r.text_key for r in laid.where(any_hit).select("text_key").distinct().collect()]
    groups = laid.where(F.col("text_key").isin(keys)).groupBy("text_key").agg(
        F.min("start").alias("low"), F.max(F.col("start") + F.col("size")).alias("high")).collect() if keys else []
    out = []
    for c in cuts:
        ends = [e for g in groups if g.low < c < g.high for e in (g.low, g.high) if abs(e - c) <= most]
        out.append(float(min(ends, key=lambda e: abs(e - c), default=c)))
    return out


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents as Parquet, a folder per shard, and return where each went. Documents meet
    their places by id and text hash; rows alike in both share one place, since equal rows go together."""
    placed = materialize(assign_shards(docs, shards, id_col, text_col), "placed")
    where = placed.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.min("shard").alias("_shard"))
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    (docs.join(where, F.col(id_col).eqNullSafe(F.col("_id")) & (key == F.col("_key"))).drop("_id", "_key")
     .write.mode("overwrite").partitionBy("_shard").parquet(path))
    return placed

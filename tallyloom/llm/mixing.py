"""Mix sources to target weights: hash-random order, distributed prefix sums, exact cuts. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.prefix import running
from tallyloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    """60 bits of an MD5: the same on every run and every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: sources in code point order, null last, carry the
    weights in turn and split ``share`` times all sizes; a target stops at ``most`` times its source,
    and what is over goes to the others by weight. A round of resharing is one aggregate."""
    ranked = running(sizes, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most))), "weights")
    total, level, full = ranked.agg(F.sum("source_size")).first()[0] or 0, -1.0, 0
    while True:
        over = F.col("weight") * F.lit(level) >= F.col("limit")
        held, rest, n = ranked.agg(F.sum(F.when(over, F.col("limit"))), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if not rest or (level >= 0 and n == full):
            break
        level, full = (share * total - (held or 0.0)) / rest, n
    return ranked.select("source", "source_size", F.when(over, F.col("limit")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, taken.

    Documents of a source are sorted by a hash of their id, and the source's budget (its target, rounded
    down) is cut from the running sum of their word counts: whole epochs first, then a prefix of the
    order, the last document in part. So a source's taken words are its budget exactly, and a document
    gives at most ceil(most) times its words.

    Null text has size 0 and gives nothing; null sources are one source, the last; null ids hash like an
    empty id. Equal rows tie, and are alike. An empty table gives no rows. Other columns are
    ignored, whatever their names."""
    narrow = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
                                     F.xxhash64(F.col(text_col)).alias("text_hash"))
                         .withColumn("key", random_key(F.col("doc_id"), seed)), "sizes")
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_hash")]
    summed = materialize(running(narrow, order, "size").select("doc_id", "source", "text_hash", "size", "start"), "summed")
    per_source = summed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("start").alias("source_start"))
    goals = targets(per_source.select("source", "source_size"), weights, share, most)
    budget = (goals.withColumnsRenamed({"source": "_s"})
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
              .withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))))
    begins = per_source.select(F.col("source").alias("_b"), "source_start")
    budget = budget.join(begins, F.col("_s").eqNullSafe(F.col("_b"))).drop("_b")
    before = F.col("start") - F.col("source_start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    return (summed.join(budget, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "source", "text_hash", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")))


def repeated(text: Column, size: Column, taken: Column) -> Column:
    """The texts a document gives to a mix, as an array: its whole text once for each whole epoch, then
    its first words, with the white space before them."""
    epochs = F.when(size > 0, F.floor(taken / size)).otherwise(0).cast("int")
    rest = (taken - epochs * size).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), rest), "")
    return F.concat(F.array_repeat(text, epochs), F.when(rest > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))

"""Profiles that grow with their table: one small state per file and column, merged when asked.

A state holds counts, extremes, mean and spread, and three sketches: of distinct values (HyperLogLog), of quantiles (KLL)
and of frequent values. States of files that have not changed are never computed again, those of files that are
gone or rewritten no longer count. So a profile after new files costs the reading of these files alone.

Counts, extremes, mean and spread are exact. So are the values of a text column and how often each occurs, as long as no more than
three quarters of ``TRACKED`` differ in it. Distinct counts and medians are estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.operators.profile import MAYBE_CATEGORY, VALUE_COUNTS, Limits, ProfiledColumn, profiled_columns
from tallyloom.session import stamp

# Logarithm of the slots of a sketch of distinct values (standard error 0.8%), size of one of quantiles (ranks within
# half a percent), and values that one of frequent values tracks.
SLOTS, QUANTILES, TRACKED = 14, 800, 1000
# What a state holds of a column, beside its file, its name and the number of rows.
HOLDS = {
    "held": "bigint", "min_number": "double", "max_number": "double", "mean": "double", "spread": "double", "min_time": "string", "max_time": "string",
    "distinct": "binary", "quantiles": "binary",
    "frequent": "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"}
OF_FILE = ["file", "modified"]
STATE = ", ".join(["file string, modified timestamp, ordinal int, column_name string, data_type string, kind string, row_count bigint",
                   *(f"{name} {kind}" for name, kind in HOLDS.items())])


def _of_file() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")]


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(file, modified, path) of all files of a folder; nothing of them is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(*_of_file(), "path")


def _state(c: ProfiledColumn) -> list[tuple[str, Column]]:
    """What is aggregated for a column: name and value."""
    held = [("held", F.count(c.ref)), ("distinct", F.hll_sketch_agg(F.when(c.ref.isNotNull(), F.xxhash64(c.key)), F.lit(SLOTS)))]
    if c.kind == "numerical":
        number = c.ref.cast("double")
        return [*held, ("min_number", F.min(number)), ("max_number", F.max(number)), ("mean", F.avg(number)),
                ("spread", F.var_pop(number) * F.count(number)), ("quantiles", F.call_function("kll_sketch_agg_double", number, F.lit(QUANTILES)))]
    if c.kind == "temporal":
        return [*held, ("min_time", F.min(c.ref).cast("string")), ("max_time", F.max(c.ref).cast("string"))]
    return [*held, ("frequent", F.call_function("approx_top_k_accumulate", c.key, F.lit(TRACKED)))]


def states(rows: DataFrame, of: list[str] = OF_FILE) -> DataFrame:
    """The states of all columns but ``of``, for each of its values. One scan; what is shuffled is a row per task and file."""
    columns = profiled_columns(rows.drop(*of))
    found = [_state(c) for c in columns]
    grouped = rows.groupBy(*of).agg(F.count(F.lit(1)).alias("__rows"), *[value.alias(f"__{c.ordinal}_{name}") for c, state in zip(columns, found) for name, value in state])

    def row(c: ProfiledColumn, names: set[str]) -> Column:
        held = [(F.col(f"__{c.ordinal}_{name}") if name in names else F.lit(None)).cast(kind).alias(name) for name, kind in HOLDS.items()]
        return F.struct(F.lit(c.ordinal).alias("ordinal"), F.lit(c.name).alias("column_name"), F.lit(c.type.simpleString()).alias("data_type"), F.lit(c.kind).alias("kind"),
                        F.col("__rows").alias("row_count"), *held)

    return grouped.select(*of, F.inline(F.array(*[row(c, {name for name, _ in state}) for c, state in zip(columns, found)])))


def update_states(spark: SparkSession, folder: str, path: str) -> int:
    """Add the states of a folder's Parquet files that are new, or have changed, to those stored at ``path``.
    Returns how many files were read. A run that fails leaves the stored states as they were."""
    files = listing(spark, folder)
    if stamp(spark, path)[1]:
        files = files.join(spark.read.schema(STATE).parquet(path).select(*OF_FILE).distinct(), OF_FILE, "left_anti")
    new = [r.path for r in files.select("path").collect()]  # names of files to read now
    if new:
        rows = spark.read.parquet(*new)
        states(rows.select("*", *_of_file())).write.mode("append").parquet(path)
    return len(new)


def merged_profile(spark: SparkSession, folder: str, path: str, limits: Limits = Limits()) -> DataFrame:
    """The profile of a folder's files, from their stored states: a row per column, as ``profile.profile_table`` has them.

    A column that some files lack is counted over the others. Texts of over 200 characters are listed by their SHA-256.
    A category has at most a quarter of ``TRACKED`` values."""
    if limits.category > TRACKED // 4:
        raise ValueError(f"a category may have up to {TRACKED // 4} values here")
    now = listing(spark, folder).select(*OF_FILE)
    parts = spark.read.schema(STATE).parquet(path).dropDuplicates([*OF_FILE, "column_name"]).join(now, OF_FILE, "left_semi")
    key = ["column_name", "kind"]
    middle = parts.groupBy(*key).agg((F.sum(F.col("mean") * F.col("held")) / F.nullif(F.sum("held"), F.lit(0))).alias("centre"))
    apart = F.col("spread") + F.col("held") * F.pow(F.col("mean") - F.col("centre"), 2)
    whole = parts.join(F.broadcast(middle), key).groupBy(*key).agg(
        F.min("ordinal").alias("ordinal"), F.max("data_type").alias("data_type"), F.sum("row_count").alias("row_count"), F.sum("held").alias("held"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"), F.max("centre").alias("mean"), F.sum(apart).alias("spread"),
        F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"), F.call_function("kll_merge_agg_double", F.col("quantiles")).alias("quantiles"))
    words = parts.where("kind = 'categorical'").groupBy(*key).agg(F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"))
    listed = F.filter(F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(limits.category + 1)), lambda v: v["item"].isNotNull())
    ordered = F.array_sort(F.transform(listed, lambda v: F.struct((-v["count"]).alias("n"), v["item"].alias("value"))))
    values = F.transform(F.slice(ordered, 1, limits.values), lambda v: F.struct(v["value"].alias("value"), (-v["n"]).cast("bigint").alias("n"))).cast(VALUE_COUNTS)
    words = words.select(*key, values.alias("value_counts"), F.size(ordered).alias("listed"))
    # Only where little differs does the sketch hold all values, and then it counts them exactly.
    few = F.col("distinct_count") <= MAYBE_CATEGORY * limits.category
    numbers = (F.col("kind") == "numerical") & (F.col("held") > 0)
    return whole.join(words, key, "left").select(
        "ordinal", "column_name", "data_type", "kind", "row_count", (F.col("row_count") - F.col("held")).alias("null_count"), "distinct_count",
        "min_number", "max_number", F.round("mean", 4).alias("mean"),
        F.when(numbers, F.call_function("kll_sketch_get_quantile_double", F.col("quantiles"), F.lit(0.5).cast("double"))).alias("median"),
        F.when(F.col("held") > 1, F.round(F.sqrt(F.col("spread") / (F.col("held") - 1)), 4)).alias("stddev"), "min_time", "max_time",
        F.when(few & (F.col("listed") <= limits.category), F.col("value_counts")).alias("value_counts"))

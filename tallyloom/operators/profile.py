"""Column profiles: one row per (table, column) with counts, statistics and top values.

A table is looked at ahead, and then counted:

1. The look ahead counts rows, sketches how many distinct words each text column has, and
   brackets each median from a sample. One row per column comes to the driver.
2. The columns, grouped by storage type, are turned into (column, value) rows and counted
   per distinct value. Each column is read once; the columns of a large table that is stored
   by column are counted one by one, which takes half the time. The counting combines on the map side, so
   a value held by a third of all rows crosses the shuffle once per task. Counts, extremes,
   mean, spread, median and top values are all folded from this one frequency table, in
   one chain of aggregates.

The look ahead only decides which values are kept apart for ranking (those around a median,
the words of a column with few of them). Every number reported is counted exactly, and a
median that fell outside its bracket, which the counts tell, is bracketed anew from all
rows. ``exact=False`` reports estimates instead and shuffles next to nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from tallyloom.functions.identifiers import RESCUED_COLUMN, id_like
from tallyloom.functions.scalars import percent
from tallyloom.session import at_once

# When a text column counts as a category, and how many values it lists.
CATEGORY_LIMIT = 50
TOP_VALUES = 10

# Columns handled by one pair of scans; wider tables take more, each reading only its own.
COLUMNS_PER_SCAN = 48
# Longer text is counted by its SHA-256 digest instead of being shuffled whole.
LONG_TEXT = 200
# percentile_approx is off by at most 1/ACCURACY of the rows.
ACCURACY = 10000
# Rows that bracket the medians: at least this many, and one in SAMPLE_SHARE of a large
# table, so that few values lie within a bracket. It is this many standard errors wide.
SAMPLE_ROWS = 200_000
SAMPLE_SHARE = 500
SAMPLE_ERRORS = 6
# Rows around a median that one task may rank, and the bins that narrow a bracket down to so many.
MAX_RANKED = 200_000
BINS = 512
# Rows from which the columns of a table stored by column are counted apart. Below, the stages cost more than they save.
APART_ROWS = 1_000_000
# Text columns with up to so many times the words of a category, by estimate, may turn out to be one.
MAYBE_CATEGORY = 2

VALUE_COUNTS = "array<struct<value: string, n: bigint>>"


@dataclass(frozen=True)
class Limits:
    """Up to how many different values a text column is a category, and how many of them are listed."""
    category: int = CATEGORY_LIMIT
    values: int = TOP_VALUES


@dataclass(frozen=True)
class ProfiledColumn:
    ordinal: int
    name: str
    type: T.DataType

    @property
    def kind(self) -> str:
        if isinstance(self.type, T.NumericType):
            return "numerical"
        if isinstance(self.type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "temporal"
        return "categorical"

    @property
    def ref(self) -> Column:
        return F.col(f"`{self.name.replace('`', '``')}`")

    @property
    def text(self) -> Column:
        """The value as text, the same for equal values."""
        if isinstance(self.type, (T.StringType, T.BooleanType)) or self.kind != "categorical":
            return self.ref.cast("string")
        if isinstance(self.type, T.BinaryType):
            return F.hex(self.ref)
        if isinstance(self.type, T.MapType):
            return F.to_json(F.array_sort(F.map_entries(self.ref)))
        if isinstance(self.type, (T.ArrayType, T.StructType)):
            return F.to_json(self.ref)
        return self.ref.cast("string")

    @property
    def lane(self) -> str:
        """The typed slot that carries this column's values through the frequency table."""
        if isinstance(self.type, (T.IntegralType, T.DateType, T.TimestampType)):
            return "whole"
        if isinstance(self.type, T.FractionalType) and not isinstance(self.type, T.DecimalType):
            return "fraction"
        return "moment" if isinstance(self.type, T.TimestampNTZType) else "word"

    @property
    def key(self) -> Column:
        if isinstance(self.type, T.DateType):
            return F.unix_date(self.ref).cast("bigint")
        if isinstance(self.type, T.TimestampType):
            return F.unix_micros(self.ref)
        if self.lane == "word":
            return F.when(F.length(self.text) > LONG_TEXT, F.sha2(self.text, 256)).otherwise(self.text)
        return self.ref.cast(LANES[self.lane])


LANES = {"whole": "bigint", "fraction": "double", "moment": "timestamp_ntz", "word": "string"}


def profiled_columns(df: DataFrame) -> list[ProfiledColumn]:
    fields = [f for f in df.schema.fields if f.name != RESCUED_COLUMN]
    return [ProfiledColumn(i, f.name, f.dataType) for i, f in enumerate(fields)]


def _base_type(dtype: T.DataType) -> str:
    return dtype.simpleString().split("(")[0].upper()


def _batches(columns: list[ProfiledColumn]) -> Iterator[list[ProfiledColumn]]:
    for start in range(0, len(columns), COLUMNS_PER_SCAN):
        yield columns[start:start + COLUMNS_PER_SCAN]


def _sketches(df: DataFrame, columns: list[ProfiledColumn], points: list[float] = (), distinct: bool = False, more: list[Column] = ()) -> Row:
    """One row: the row count, and per column the percentiles of a number, the count of its
    values, or with ``distinct`` an estimate of how many differ; and ``more`` aggregates."""
    aggregates = [F.count(F.lit(1)).alias("row_count"), *more]
    for c in columns:
        if points and c.kind == "numerical":
            aggregates.append(F.percentile_approx(c.ref.cast("double"), points, ACCURACY).alias(f"at_{c.ordinal}"))
            aggregates.append(F.count(c.ref).alias(f"held_{c.ordinal}"))
        if distinct:
            value = c.text if c.kind == "categorical" else c.ref
            aggregates.append(F.approx_count_distinct(value).alias(f"distinct_{c.ordinal}"))
    return df.agg(*aggregates).first()


Brackets = dict[int, tuple[float, float]]


def _brackets(df: DataFrame, columns: list[ProfiledColumn], row_count: int, whole: bool = False) -> Brackets:
    """A lower and an upper bound for the median of every number column that has values."""
    numbers = [c for c in columns if c.kind == "numerical"]
    if not numbers or not row_count:
        return {}
    rows = max(SAMPLE_ROWS, row_count // SAMPLE_SHARE)
    whole = whole or 2 * rows > row_count
    # Half of the sampled rows may be null in a column before its error grows beyond this.
    margin = 2 / ACCURACY + (0 if whole else SAMPLE_ERRORS * 0.5 / (rows / 2) ** 0.5)
    looked = df if whole else df.sample(rows / row_count, seed=0)
    found = _sketches(looked, numbers, [0.5 - margin, 0.5 + margin])
    sparse = [] if whole else [c for c in numbers if found[f"held_{c.ordinal}"] < rows / 2]
    known = {c.ordinal: tuple(found[f"at_{c.ordinal}"]) for c in numbers if c not in sparse and found[f"at_{c.ordinal}"]}
    return known | _brackets(df, sparse, row_count, whole=True)


def _counted(df: DataFrame, cells: dict[int, Column], apart: bool) -> DataFrame:
    """(ordinal, value, n): how often each column, given by its ordinal, holds each value that is not null. In one scan of all the columns, or, where
    reading one of them costs no more than that, ``apart``: then the values alone are the keys of the counting, in generated code."""
    count = F.count(F.lit(1)).alias("n")
    if apart:
        return reduce(DataFrame.unionAll, [
            df.select(cell.alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(count).select(F.lit(i).alias("ordinal"), "value", "n")
            for i, cell in cells.items()])
    rows = df.select(*[cell.alias(str(i)) for i, cell in cells.items()]).unpivot([], [str(i) for i in cells], "column", "value")
    return rows.where(F.col("value").isNotNull()).groupBy("column", "value").agg(count).select(F.col("column").cast("int").alias("ordinal"), "value", "n")


def _narrowed(df: DataFrame, columns: list[ProfiledColumn], brackets: Brackets, apart: bool = False) -> Brackets:
    """Brackets that hold at most MAX_RANKED rows each, or a single value. A round counts the rows of every
    bracket in equal bins, which combine on the map side, and goes on in the bin that holds the
    median. A median outside its bracket leaves that as it is; the counts tell later."""
    brackets = dict(brackets)
    wide = {c.ordinal: c for c in columns if c.ordinal in brackets and all(map(math.isfinite, brackets[c.ordinal]))}
    while wide:
        binned = {}
        for i, c in wide.items():
            low, high = brackets[i]
            x = c.ref.cast("double")
            at = F.floor((x - low) / (high - low) * BINS) if high > low else F.lit(0).cast("bigint")
            binned[i] = F.when(x < low, -1).when(x > high, BINS).when(x.isNotNull(), F.least(at, F.lit(BINS - 1))).cast("int")
        counted: dict[int, dict[int, int]] = {}
        for column, place, n in _counted(df, binned, apart).collect():
            counted.setdefault(column, {})[place] = n
        for i in list(wide):
            low, high = brackets[i]
            total, reached, middle = sum(counted.get(i, {}).values()), 0, None
            for place in sorted(counted.get(i, {})):
                reached += counted[i][place]
                if reached * 2 >= total:
                    middle = place
                    break
            if middle is None or middle in (-1, BINS):
                del wide[i]
                continue
            step = (high - low) / BINS
            slack = step * 1e-6 + abs(high) * 1e-15  # rounding may put a value one bin off
            closer = max(low, low + middle * step - slack), min(high, low + (middle + 1) * step + slack)
            brackets[i] = closer
            if counted[i][middle] <= MAX_RANKED or closer[1] - closer[0] >= high - low:
                del wide[i]
    return brackets


def _frequencies(df: DataFrame, columns: list[ProfiledColumn], lane: str, listed: set[int], apart: bool) -> DataFrame:
    """(ordinal, value, n) for the columns of one lane. Each lane scans its own columns only,
    and the narrow typed keys keep the counting in generated code."""
    freq = _counted(df, {c.ordinal: c.text if c.ordinal in listed else c.key for c in columns}, apart)
    return freq.select(
        "ordinal", "n", *[(F.col("value") if name == lane else F.lit(None).cast(dtype)).alias(name) for name, dtype in LANES.items()])


def _count_values(df: DataFrame, columns: list[ProfiledColumn], brackets: Brackets, listed: set[int], values: int, apart: bool = False) -> DataFrame:
    """One row per column, folded from the frequencies of its values. Medians are ranked
    within ``brackets``, and the words of the ``listed`` columns are kept."""
    of_lane = {lane: [c for c in columns if c.lane == lane] for lane in LANES}
    freq = reduce(DataFrame.union, [_frequencies(df, cs, lane, listed, apart) for lane, cs in of_lane.items() if cs])

    def per_column(values: dict[int, object], dtype: str) -> Column:
        slots = [F.lit(values.get(i)).cast(dtype) for i in range(max(c.ordinal for c in columns) + 1)]
        return F.array(*slots)[F.col("ordinal")]

    low = per_column({i: b[0] for i, b in brackets.items()}, "double")
    high = per_column({i: b[1] for i, b in brackets.items()}, "double")
    number = F.coalesce(F.col("whole").cast("double"), F.col("fraction"), F.col("word").try_cast("double"))
    # Only number columns have a bracket, so dates, times and words yield null here.
    freq = freq.withColumn("low", low).withColumn("high", high).withColumn(
        "number", F.when(F.col("low").isNotNull(), number))
    off = F.col("number") - F.col("low")  # sums of squares around the median keep their digits
    near = F.when(F.col("number").between(F.col("low"), F.col("high")), F.col("number"))
    kept = F.when(F.col("ordinal").isin(*listed), F.col("word")) if listed else F.lit(None).cast("string")
    detail = freq.groupBy("ordinal", near.alias("near"), kept.alias("value")).agg(
        F.count(F.lit(1)).alias("distinct"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("number") < F.col("low"), F.col("n")).otherwise(0)).alias("below"),
        F.min("number").alias("min_number"), F.max("number").alias("max_number"),
        F.max("low").alias("low"),
        F.sum(off * F.col("n")).alias("off"), F.sum(off * off * F.col("n")).alias("off2"),
        F.min("whole").alias("min_whole"), F.max("whole").alias("max_whole"),
        F.min("moment").alias("min_moment"), F.max("moment").alias("max_moment"),
    )
    # The windows see, per column, the values near the median or the words to list.
    column = Window.partitionBy("ordinal")
    upward = column.orderBy(F.asc_nulls_first("near")).rowsBetween(Window.unboundedPreceding, 0)
    weight = F.when(F.col("near").isNull(), F.col("below")).otherwise(F.col("n"))
    place = F.row_number().over(column.orderBy(F.col("value").isNull(), F.desc("n"), "value"))
    ranked = (
        detail.withColumn("weight", weight).withColumn("total", F.sum("n").over(column))
        .withColumn("reached", F.sum("weight").over(upward)).withColumn("place", place))
    crossing = (F.col("reached") * 2 >= F.col("total")) & ((F.col("reached") - F.col("weight")) * 2 < F.col("total"))
    top = F.when(
        F.col("value").isNotNull() & (F.col("place") <= values), F.struct("place", "value", "n"))
    folded = ranked.groupBy("ordinal").agg(
        F.sum("distinct").alias("distinct_count"), F.sum("n").alias("held"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.max("low").alias("low"), F.sum("off").alias("off"), F.sum("off2").alias("off2"),
        F.max(F.when(crossing, F.col("near"))).alias("median"),
        F.min("min_whole").alias("min_whole"), F.max("max_whole").alias("max_whole"),
        F.min("min_moment").alias("min_moment"), F.max("max_moment").alias("max_moment"),
        F.array_sort(F.collect_list(top)).alias("top"))
    variance = (F.col("off2") - F.col("off") * F.col("off") / F.col("held")) / (F.col("held") - 1)
    return folded.select(
        "ordinal", "held", "distinct_count", "min_number", "max_number",
        (F.col("low") + F.col("off") / F.col("held")).alias("mean"),
        "median",
        F.when(F.col("low").isNotNull() & (F.col("held") > 1), F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("stddev"),
        _time_text(columns, "min").alias("min_time"), _time_text(columns, "max").alias("max_time"),
        F.transform("top", lambda v: F.struct(v["value"].alias("value"), v["n"].alias("n"))).alias("value_counts"))


def _time_text(columns: list[ProfiledColumn], end: str) -> Column:
    """The first or last moment of a date or time column, as text."""
    out = F.lit(None).cast("string")
    for dtype, back in ((T.DateType, F.date_from_unix_date), (T.TimestampType, F.timestamp_micros)):
        of_type = [c.ordinal for c in columns if isinstance(c.type, dtype)]
        whole = F.col(f"{end}_whole")
        if of_type:
            out = F.when(F.col("ordinal").isin(*of_type),
                         back(whole.cast("int") if dtype is T.DateType else whole).cast("string")).otherwise(out)
    return F.coalesce(out, F.col(f"{end}_moment").cast("string"))


def _count_exactly(df: DataFrame, columns: list[ProfiledColumn], row_count: int, limits: Limits, columnar: bool) -> list[Row]:
    """The statistics per column, one row each."""
    apart = columnar and row_count >= APART_ROWS
    words = [c for c in columns if c.kind == "categorical"]
    listed = _maybe_categories(words, _sketches(df, words, distinct=True), limits) if words else set()
    brackets = _brackets(df, columns, row_count)
    # Brackets from a sample hold some hundredths of the rows.
    brackets = _narrowed(df, columns, brackets, apart) if row_count > 25 * MAX_RANKED else brackets
    rows = {r.ordinal: r for r in _count_values(df, columns, brackets, listed, limits.values, apart).collect()}
    # The estimate said many words, the count says few: their values are still to be listed.
    unlisted = [c for c in words if c.ordinal not in listed and c.ordinal in rows and rows[c.ordinal].distinct_count <= limits.category]
    if unlisted:
        rows |= {r.ordinal: r for r in _count_values(df, unlisted, {}, {c.ordinal for c in unlisted}, limits.values, apart).collect()}
    missed = [c for c in columns if c.kind == "numerical" and c.ordinal in rows and rows[c.ordinal].median is None]
    if missed:
        brackets = _brackets(df, missed, row_count, whole=True)
        brackets = _narrowed(df, missed, brackets, apart) if row_count > 25 * MAX_RANKED else brackets
        again = _count_values(df, missed, brackets, set(), limits.values, apart)
        rows |= {r.ordinal: r for r in again.collect()}
    return list(rows.values())


def _maybe_categories(words: list[ProfiledColumn], sketched: Row, limits: Limits) -> set[int]:
    return {c.ordinal for c in words if sketched[f"distinct_{c.ordinal}"] <= MAYBE_CATEGORY * limits.category}


def _estimate(df: DataFrame, columns: list[ProfiledColumn], limits: Limits) -> tuple[int, list[Row]]:
    """The row count, and the statistics per column from one aggregate: estimated distinct counts
    and medians. Only the words of columns that have few of them are counted one by one."""
    aggregates = [F.count(c.ref).alias(f"held_{c.ordinal}") for c in columns if c.kind != "numerical"]
    for c in columns:
        if c.kind == "numerical":
            number = c.ref.cast("double")
            aggregates += [f(number).alias(f"{f.__name__}_{c.ordinal}") for f in (F.min, F.max, F.avg, F.stddev_samp)]
        elif c.kind == "temporal":
            aggregates += [f(c.ref).cast("string").alias(f"{f.__name__}_{c.ordinal}") for f in (F.min, F.max)]
    sketched = _sketches(df, columns, [0.5], distinct=True, more=aggregates)
    plain = sketched.asDict()
    words = [c for c in columns if c.kind == "categorical"]
    few = _maybe_categories(words, sketched, limits)
    counted = {r.ordinal: r for r in _count_values(df, [c for c in words if c.ordinal in few], {}, few, limits.values).collect()} if few else {}

    def of(c: ProfiledColumn, name: str, kind: str):
        return plain[f"{name}_{c.ordinal}"] if c.kind == kind else None

    rows = []
    for c in columns:
        exact, middle = counted.get(c.ordinal), sketched[f"at_{c.ordinal}"] if c.kind == "numerical" else None
        rows.append(Row(
            ordinal=c.ordinal, held=plain[f"held_{c.ordinal}"],
            distinct_count=exact.distinct_count if exact else sketched[f"distinct_{c.ordinal}"],
            min_number=of(c, "min", "numerical"), max_number=of(c, "max", "numerical"), mean=of(c, "avg", "numerical"),
            median=middle[0] if middle else None, stddev=of(c, "stddev_samp", "numerical"),
            min_time=of(c, "min", "temporal"), max_time=of(c, "max", "temporal"),
            value_counts=exact.value_counts if exact else None))
    return sketched.row_count, rows


STATISTICS = ("held BIGINT, distinct_count BIGINT, min_number DOUBLE, max_number DOUBLE, mean DOUBLE, median DOUBLE,"
              "stddev DOUBLE, min_time STRING, max_time STRING, value_counts " + VALUE_COUNTS)
NO_VALUES = (0, 0, *[None] * 8)
COLLECTED = ("table_name STRING, ordinal INT, column_name STRING, data_type STRING, kind STRING, row_count BIGINT,"
             "column_count INT," + STATISTICS)


def _collected(df: DataFrame, table: str, exact: bool, limits: Limits, columnar: bool = False) -> list[tuple]:
    """What is known of each column of a table, one row per column. A column without a single
    value has no statistics."""
    columns = profiled_columns(df)
    count = df.count() if exact or not columns else 0
    found = {}
    for batch in _batches(columns):
        if exact:
            rows = _count_exactly(df, batch, count, limits, columnar)
        else:
            count, rows = _estimate(df, batch, limits)
        found |= {r.ordinal: tuple(r)[1:] for r in rows}
    return [
        (table, c.ordinal, c.name, _base_type(c.type), c.kind, count, len(columns), *found.get(c.ordinal, NO_VALUES))
        for c in columns]


def profile_table(df: DataFrame, table: str, exact: bool = True, limits: Limits = Limits(), columnar: bool = False) -> DataFrame:
    """The profile of one table. It is computed here and now, and what is returned holds a
    row per column, so it may be used many times over. ``exact=False`` estimates distinct
    counts and medians, so that no value is shuffled except those of columns with few."""
    return profile_tables({table: df}, exact, limits, columnar)


def profile_tables(tables: dict[str, DataFrame], exact: bool = True, limits: Limits = Limits(), columnar: bool = False) -> DataFrame:
    """The profiles of several tables, taken side by side. ``columnar`` says that they are read as they are stored, in a format by
    column: the columns of large ones are then counted apart, each in a scan of its own."""
    named = sorted(tables.items())
    spark = named[0][1].sparkSession
    rows = [row for part in at_once(spark, lambda item: _collected(item[1], item[0], exact, limits, columnar), named) for row in part]
    categorical, distinct = F.col("kind") == "categorical", F.col("distinct_count")
    nulls = F.col("row_count") - F.col("held")
    many = categorical & (distinct > limits.category)
    note = F.concat(
        distinct.cast("string"), F.lit(" unique values across "), F.col("row_count").cast("string"),
        F.lit(" rows; too many to list (an identifier or free text)"))
    listed = F.coalesce(F.col("value_counts"), F.array().cast(VALUE_COUNTS))
    profile = spark.createDataFrame(rows, COLLECTED).select(
        "table_name", "ordinal", "column_name", "data_type", "kind", "row_count", "column_count",
        nulls.alias("null_count"), percent(nulls, F.col("row_count")).alias("null_pct"), "distinct_count",
        "min_number", "max_number", F.round("mean", 4).alias("mean"), "median",
        F.round("stddev", 4).alias("stddev"), "min_time", "max_time",
        F.when(categorical, many).alias("high_cardinality"), F.when(many, note).alias("note"),
        F.when(categorical & ~many, listed).alias("value_counts"))
    return _mark_inferred_key(profile, exact)


def _mark_inferred_key(profile: DataFrame, exact: bool) -> DataFrame:
    """Flag the column that could serve as primary key: never null, never repeated, an
    id-like name first, then the leftmost. The window holds a row per column. Estimates
    cannot tell that a column never repeats, so they infer no key."""
    if not exact:
        return profile.withColumn("is_inferred_primary_key", F.lit(False))
    unique = (F.col("row_count") > 0) & (F.col("null_count") == 0) & (F.col("distinct_count") == F.col("row_count"))
    best_first = Window.partitionBy("table_name").orderBy(
        F.desc(unique), F.desc(id_like(F.col("column_name"))), "ordinal")
    return profile.withColumn(
        "is_inferred_primary_key", unique & (F.row_number().over(best_first) == 1))


def inferred_keys(profile: DataFrame) -> DataFrame:
    """One row per table: its inferred primary key, or null."""
    return profile.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"), F.max("column_count").alias("column_count"),
        F.max(F.when(F.col("is_inferred_primary_key"), F.col("column_name"))).alias("inferred_primary_key"))


def with_declared_keys(profile: DataFrame, primary: dict[str, list[str]],
                       foreign: dict[str, dict[str, str]]) -> DataFrame:
    """Replace the inferred key by declared ones. ``foreign`` maps table -> column ->
    'table.column'."""
    spec = [(t, c, True, None) for t, cols in primary.items() for c in cols]
    spec += [(t, c, False, ref) for t, cols in foreign.items() for c, ref in cols.items()]
    keys = profile.sparkSession.createDataFrame(
        spec, "table_name STRING, column_name STRING, pk BOOLEAN, ref STRING"
    ).groupBy("table_name", "column_name").agg(F.max("pk").alias("pk"), F.max("ref").alias("references"))
    return (
        profile.drop("is_inferred_primary_key")
        .join(F.broadcast(keys), ["table_name", "column_name"], "left")
        .withColumn("is_primary_key", F.coalesce("pk", F.lit(False)))
        .withColumn("is_foreign_key", F.col("references").isNotNull())
        .drop("pk"))

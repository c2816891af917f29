"""Schema-agnostic tools over a set of named tables.

Names, aggregates and operators are checked against what exists before any plan is
built; a wrong one raises ``ValueError`` listing the valid ones. ``as_text`` turns a
result or such a message into the short text a chat assistant reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.identifiers import RESCUED_COLUMN

# The aggregates and comparisons the tools accept.
AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}
COMPARISONS = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
}
# Functions that run code although the query only selects.
CODE_FUNCTIONS = {"java_method", "reflect", "try_reflect"}


def list_tables(tables: dict[str, DataFrame], counted: bool = False) -> DataFrame:
    """Table names and column counts, by name, and row counts if asked for."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, len([c for c in df.columns if c != RESCUED_COLUMN])) for name, df in tables.items()]
    if counted:
        return reduce(DataFrame.unionAll, [
            tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), F.lit(n).alias("column_count"), "row_count")
            for name, n in sorted(rows)])
    return spark.createDataFrame(rows, "table_name STRING, column_count INT").orderBy("table_name")


def list_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Every column of every table, in ordinal order."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for i, field in enumerate(f for f in df.schema.fields if f.name != RESCUED_COLUMN)]
    return spark.createDataFrame(
        rows, "table_name STRING, ordinal INT, column_name STRING, data_type STRING").orderBy("table_name", "ordinal")


def _one_of(what: str, value: str, valid) -> None:
    if value not in valid:
        raise ValueError(f"Unknown {what} '{value}'. Valid: {', '.join(valid)}")


def _table(tables: dict[str, DataFrame], name: str) -> DataFrame:
    _one_of("table", name, sorted(tables))
    return tables[name].drop(RESCUED_COLUMN)


def top_n_group_by(tables: dict[str, DataFrame], table: str, group_by: str, metric: str,
                   n: int = 5, agg: str = "sum", most: int | None = None) -> DataFrame:
    """The n groups with the largest aggregate, at least one, and at most ``most`` if given.
    Nulls form a group; null results come last."""
    df = _table(tables, table)
    _one_of("column", group_by, df.columns)
    _one_of("column", metric, df.columns)
    _one_of("aggregate", agg, AGGREGATES)
    return (
        df.groupBy(F.col(f"`{group_by}`").alias("group_value"))
        .agg(AGGREGATES[agg](F.col(f"`{metric}`")).alias("metric_value"))
        .orderBy(F.desc_nulls_last("metric_value"), "group_value")
        .limit(_rows_wanted(n, most))
    )


def _rows_wanted(n: int, most: int | None) -> int:
    return max(1, int(n) if most is None else min(int(n), most))


def _typed(value, dtype: T.DataType):
    """The threshold as a literal of the column's type."""
    if isinstance(dtype, T.NumericType):
        try:
            number = Decimal(str(value))
        except InvalidOperation:
            raise ValueError(f"'{value}' is not a number") from None
        if not number.is_finite() or isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.lit(float(number))
        return F.lit(int(number)) if number == number.to_integral_value() else F.lit(number)
    return F.lit(str(value)).cast(dtype)


def filter_by_threshold(tables: dict[str, DataFrame], table: str, column: str, operator: str, value,
                        limit: int | None = None, order_by: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Whole rows where the column meets the threshold: all of them, or with ``limit`` so many,
    at least one and at most ``most`` if given. Without ``order_by`` any such rows count."""
    df = _table(tables, table)
    _one_of("column", column, df.columns)
    _one_of("operator", operator, COMPARISONS)
    hits = df.where(COMPARISONS[operator](F.col(f"`{column}`"), _typed(value, df.schema[column].dataType)))
    if order_by:
        hits = hits.orderBy(*order_by)
    return hits if limit is None else hits.limit(_rows_wanted(limit, most))


def _nodes(plan) -> Iterator:
    """The nodes of a plan, with those of its subqueries and named queries."""
    yield plan
    for part in (plan.children(), plan.innerChildren(), plan.subqueries()):
        for i in range(part.size()):
            yield from _nodes(part.apply(i))


def _check_parsed(spark: SparkSession, text: str, tables: list[str]) -> None:
    """Refuse what names other relations than the given ones and its own, or runs code. Looks at the plan as parsed, before
    anything is resolved or opened, so literals are free to say anything."""
    known = {t.lower() for t in tables}
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except PySparkException as error:
        raise ValueError(f"Query failed: {error}") from error
    nodes = list(_nodes(parsed))
    for node in nodes:
        if node.nodeName() == "UnresolvedWith":
            pairs = node.cteRelations()
            known |= {pairs.apply(i)._1().lower() for i in range(pairs.size())}
    for node in nodes:
        if node.nodeName() == "UnresolvedRelation":
            name = node.tableName().replace("`", "")
            if name.lower() not in known:
                raise ValueError(f"Rejected: unknown table '{name}'. Valid: {', '.join(sorted(tables))}")
        if node.nodeName() == "PlanWithUnresolvedIdentifier":
            raise ValueError("Rejected: tables are named, not computed.")
    called = set(re.findall(r"'(\w+)\(", parsed.toString().lower()))
    if called & CODE_FUNCTIONS or any(node.nodeName() == "ScriptTransformation" for node in nodes):
        raise ValueError("Rejected: the query calls out to code.")


def _read(plan) -> set[str]:
    """The views and relations that an analysed plan reads, as they compare equal: a view by its plan, whatever it reads in turn.
    Named queries are read through to what they read; rows that the text itself makes are no relations."""
    if plan.nodeName() == "View":
        return {plan.canonicalized().toString()}
    parts = [part.apply(i) for part in (plan.children(), plan.innerChildren(), plan.subqueries()) for i in range(part.size())]
    if not parts and plan.nodeName() not in ("CTERelationRef", "OneRowRelation", "LocalRelation", "Range"):
        return {plan.canonicalized().toString()}
    return set().union(*map(_read, parts))


def _check_analysed(spark: SparkSession, df: DataFrame, tables: list[str]) -> None:
    """Refuse a query whose analysed plan reads anything but the given tables, whatever names and scopes its text plays with."""
    allowed = set().union(*(_read(spark.table(name)._jdf.queryExecution().analyzed()) for name in tables))
    if not _read(df._jdf.queryExecution().analyzed()) <= allowed:
        raise ValueError(f"Rejected: the query reads other relations than {', '.join(sorted(tables))}.")


def run_readonly_sql(spark: SparkSession, query: str, tables: list[str], limit: int | None = None) -> DataFrame:
    """The rows of a SELECT or WITH query over the given tables, or the first ``limit``. The text is
    placed where the grammar accepts nothing but a query, so commands do not parse; relations
    must be among ``tables``, and files are no relations. This is a guard against mistakes;
    run untrusted queries as a user that may only read."""
    text = query.strip().rstrip(";").strip()
    if not re.match(r"(select|with)\b", text, re.IGNORECASE):
        raise ValueError("Rejected: only SELECT or WITH queries are accepted.")
    placed = f"SELECT * FROM (\n{text}\n)" + ("" if limit is None else f" LIMIT {int(limit)}")
    _check_parsed(spark, placed, tables)
    try:
        rows = spark.sql(placed)
    except PySparkException as error:
        raise ValueError(f"Query failed: {error}") from error
    _check_analysed(spark, rows, tables)
    return rows


def as_text(tool: Callable[..., DataFrame], *args, empty: str = "(no rows)", shown: int = 100, **kwargs) -> str:
    """A tool's result as lines of text, or its error message. Says so if there are more rows
    than ``shown``."""
    try:
        rows = tool(*args, **kwargs).limit(shown + 1).collect()
    except (ValueError, PySparkException) as error:
        return str(error)
    lines = [str(row.asDict()) for row in rows[:shown]] + [f"(more than {shown} rows; the rest is not shown)"] * (len(rows) > shown)
    return "\n".join(lines) or empty

"""Tables of the session catalog, and frames that must not be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.identifiers import RESCUED_COLUMN

# Fixed value: the table that holds profiles is not itself profiled.
PROFILE_TABLE = "profiles"


def managed_tables(spark: SparkSession, database: str) -> list[str]:
    """The managed tables of a database by name, without the profile table."""
    found = spark.catalog.listTables(database)
    return sorted(t.name for t in found if t.tableType == "MANAGED" and t.name != PROFILE_TABLE)


def read_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {t: spark.table(f"{database}.{t}").drop(RESCUED_COLUMN) for t in managed_tables(spark, database)}


def table_profile(profile: DataFrame, table: str) -> DataFrame:
    """The stored profile of one table; ``ValueError`` when there is none."""
    one = profile.where(F.col("table_name") == table)
    if one.isEmpty():
        raise ValueError(f"No stored profile for '{table}'. Profile its dataset first.")
    return one


def not_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows.")
    return df

"""Run registered queries beside their SQL and compare the results as sets of rows."""

from __future__ import annotations

import math

import duckdb


def tables_in(folder: str) -> duckdb.DuckDBPyConnection:
    from tallyloom.plans.catalogue import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(x):
    if x is None:
        return None
    if isinstance(x, float):
        return None if math.isnan(x) else x
    return x if isinstance(x, (bool, int, str)) else str(x)


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None

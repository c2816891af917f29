"""Joining a few rows with many, once the few are known to be few."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Rows, and bytes of their values, up to which a frame is sent to every task.
SENT_ROWS, SENT_BYTES = 1_000_000, 64_000_000


def sent_if_few(df: DataFrame, rows: int = SENT_ROWS, size: int = SENT_BYTES) -> DataFrame:
    """Mark a frame for broadcast when it has at most ``rows`` rows and ``size`` bytes, and leave
    the join to Spark otherwise. Counting stops one row past the bound."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    width = sum((F.lit(16) if isinstance(f.dataType, plain) else F.coalesce(F.octet_length(
        F.col(f"`{f.name}`") if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)) for f in df.schema), F.lit(0))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found.n <= rows and found.bytes <= size else df

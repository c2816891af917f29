"""Small scalar expressions shared by the analytics and report plans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONTH = "yyyy-MM"
PREVIEW_CHARS = 160
LABEL_CHARS = 28


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return quantity * unit_price


def month_of(when: Column) -> Column:
    return F.date_format(when, MONTH)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent; 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)).otherwise(0.0)


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The opening characters followed by an ellipsis, always."""
    return F.concat(F.substring(text, 1, chars), F.lit("..."))


def short_label(text: Column, chars: int = LABEL_CHARS) -> Column:
    """The text itself, or its opening characters and an ellipsis when it is longer."""
    return F.when(F.length(text) > chars, preview(text, chars)).otherwise(text)


def plain_number(x: Column) -> Column:
    """A number as text without an exponent: at least one decimal, no trailing zeros."""
    fixed = F.regexp_replace(x.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(x.isNull(), F.lit(None)).when(F.abs(x) < 1e27, fixed).otherwise(x.cast("string"))

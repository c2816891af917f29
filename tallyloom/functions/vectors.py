"""Vector arithmetic over ARRAY columns, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: added to a norm before dividing by it, so a zero vector scores 0.
NORM_GUARD = 1e-10
# Scores are compared after rounding to this many digits: the same pair of vectors must
# tie with itself whichever engine added up the products.
SCORE_DIGITS = 9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    length = norm(a) + F.lit(NORM_GUARD)
    return F.transform(a, lambda x: x.cast("double") / length)


def comparable(v: Column) -> Column:
    """Whether a vector can be scored: it is there, and so are all its numbers, and they are finite."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((norm(a) + F.lit(NORM_GUARD)) * (norm(b) + F.lit(NORM_GUARD)))

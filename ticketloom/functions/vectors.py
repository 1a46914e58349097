"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    size = norm(v)
    return F.transform(v, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0)))


def l2_from_inner(score: Column) -> Column:
    """Euclidean distance between unit vectors with the given inner product."""
    return F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * score, F.lit(0.0)))


def clamp01(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(score, F.lit(1.0)))

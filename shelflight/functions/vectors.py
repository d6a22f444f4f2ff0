"""Dense vectors held as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def ratio(top: Column, bottom: Column, empty: float = 0.0) -> Column:
    """``top / bottom``, or ``empty`` where the divisor is zero or missing."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(empty))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 when either has no length."""
    return ratio(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def squared_distance(xs: list[Column], centre: list[Column]) -> Column:
    total = F.lit(0.0)
    for x, c in zip(xs, centre, strict=True):
        total = total + (x - c) * (x - c)
    return total

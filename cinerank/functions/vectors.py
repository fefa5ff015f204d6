"""Dense-vector column expressions (array<double>), JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm2(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """VEC1: v / ||v||; a zero vector stays zero.

    The norm enters the element lambda as a second array, so it is computed
    once per row (an expression over ``v`` inside the lambda would be
    re-evaluated for every element).
    """
    n = norm2(v)
    safe = F.when(n == 0, F.lit(1.0)).otherwise(n)
    return F.zip_with(v, F.array_repeat(safe, F.size(v)), lambda x, s: x.cast("double") / s)


def one_hot(idx: Column, size: Column | int) -> Column:
    """VEC2/VEC3: length-``size`` 0/1 vector; an index outside [0, size) or null gives all zeros."""
    n = F.lit(size) if isinstance(size, int) else size
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i == idx, F.lit(1.0)).otherwise(F.lit(0.0)))).otherwise(
        F.array().cast("array<double>")
    )


def zeros(size: Column | int) -> Column:
    n = F.lit(size) if isinstance(size, int) else size
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.lit(0.0))).otherwise(F.array().cast("array<double>"))

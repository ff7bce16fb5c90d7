"""Array arithmetic for cosine similarity (F2, F10), as built-in
higher-order functions over ``array<float|double|int>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """Sum of element-wise products; arrays of unequal length are zero-padded
    by ``zip_with`` (missing elements are null and count as 0)."""
    return _sum(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"),
                                                           F.lit(0.0))))


def norm(a: Column) -> Column:
    """Euclidean length: square root of the sum of squares."""
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; null when either has zero length (the
    original yields NaN there, which has no defined rank)."""
    denom = norm(a) * norm(b)
    return F.when(denom > 0, dot(a, b) / denom)


def unit(a: Column) -> Column:
    """The array divided by its norm, as ``array<double>``; null for a zero vector."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))

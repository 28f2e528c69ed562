"""Numeric measures as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements; 1 if both are empty, 0 if one is."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def overlap(a: Column, b: Column) -> Column:
    """Shared over the smaller set's elements; 0 if either is empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 where one has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson's interval of a share ``k / n``; null for ``n`` of 0."""
    p = F.try_divide(k.cast("double"), n)
    den = 1 + F.try_divide(F.lit(z * z), n)
    mid = (p + F.try_divide(F.lit(z * z), 2 * n)) / den
    half = z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z), 4 * n * n)) / den
    return mid - half, mid + half

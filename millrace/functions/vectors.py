"""Vector columns: cosine similarity and what is derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a.cast("array<double>"), lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def cosine(a: Column, b: Column) -> Column:
    """0 if a vector is zero, null, or of another length."""
    lengths = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (lengths > 0), dot(a, b) / lengths).otherwise(0.0)


def dot_similarity(a: Column, b: Column) -> Column:
    """For vectors of length one; 0 if one is null, empty or of another length."""
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), dot(a, b)).otherwise(0.0)


def distance(a: Column, b: Column) -> Column:
    return 1 - cosine(a, b)


def similarity_of(distance_: Column) -> Column:
    """1 - d for distances up to 1, beyond it 1 / (1 + d)."""
    return F.when(distance_ <= 1, F.greatest(F.lit(0.0), 1 - distance_)).otherwise(1 / (1 + distance_))


def accuracy(distance_: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - distance_))


def literal(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])

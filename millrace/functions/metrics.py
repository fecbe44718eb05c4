"""Ratios by which corpora are compared; zero, null or invalid inputs give what each function says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DUPLICATION = 15
CHARS_PER_TOKEN = 4
DOLLARS_PER_MILLION = 0.72
RESULTS_PER_QUERY = 5


def improvement(before: Column, after: Column) -> Column:
    """before / after; 0 if either is null or not positive."""
    return F.when((before > 0) & (after > 0), F.try_divide(before.cast("double"), after.cast("double"))).otherwise(0.0)


def aggregate(vector: Column, word: Column) -> Column:
    """Product, or the vector improvement alone if either is zero."""
    return F.when((vector != 0) & (word != 0), vector * word).otherwise(vector)


def projected(vector: Column, word: Column, factor: int = DUPLICATION) -> Column:
    return vector * word * factor


def projected_words(word: Column, factor: int = DUPLICATION) -> Column:
    return word * factor


def gain(before: Column, after: Column) -> Column:
    """Percentage by which ``after`` is below ``before``; 0 if that is not positive."""
    return F.when(before > 0, (before - after) / before * 100).otherwise(0.0)


def reduction(before: Column, after: Column) -> Column:
    return F.when(before > 0, (1 - F.try_divide(after.cast("double"), before.cast("double"))) * 100).otherwise(0.0)


def valid(*distances: Column) -> Column:
    """Whether all are positive numbers."""
    out = F.lit(True)
    for d in distances:
        out = out & F.coalesce(~F.isnan(d) & (d > 0), F.lit(False))
    return out


def mean_distance(d: Column) -> Column:
    """Mean of the finite ones; null if there is none."""
    return F.avg(F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d))


def annual_tokens(per_item: Column, queries: int, results: int = RESULTS_PER_QUERY) -> Column:
    return (per_item * queries * results).cast("long")


def cost(tokens: Column, dollars_per_million: float = DOLLARS_PER_MILLION) -> Column:
    return tokens / 1_000_000 * dollars_per_million

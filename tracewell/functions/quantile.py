"""The 95th percentile rule used for latency.

rank = 0.95 * n - 1 over the ascending non-NULL values (zero-based), linear interpolation between the
neighbouring ranks, result truncated to an integer. This differs from SQL ``percentile``, whose rank is
``0.95 * (n - 1)``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

QUANTILE = 0.95


class Rank(NamedTuple):
    lower: Column
    upper: Column
    weight: Column


def rank_of(count: Column) -> Rank:
    """Zero-based neighbour ranks for ``count`` values; one value gives rank 0 on both sides."""
    rank = F.lit(QUANTILE) * count.cast("double") - F.lit(1.0)
    zero = F.lit(0).cast("bigint")
    lower = F.greatest(F.floor(rank).cast("bigint"), zero)
    upper = F.greatest(F.ceil(rank).cast("bigint"), zero)
    return Rank(lower, upper, rank - lower.cast("double"))


def between(low: Column, high: Column, rank: Rank) -> Column:
    mixed = low.cast("double") * (F.lit(1.0) - rank.weight) + high.cast("double") * rank.weight
    return F.when(rank.lower == rank.upper, low).otherwise(mixed.cast("bigint"))


def p95(values: Column) -> Column:
    """Percentile of one array column. For grouped data prefer the counting plan in
    ``operators.latency``, which never builds the array."""
    sorted_values = F.array_sort(F.filter(values, lambda v: v.isNotNull()))

    def pick(ordered: Column) -> Column:
        rank = rank_of(F.size(ordered))
        low = F.get(ordered, rank.lower.cast("int"))
        high = F.get(ordered, rank.upper.cast("int"))
        return between(low, high, rank)

    # transform over a one-element array evaluates the sort once
    return F.get(F.transform(F.array(sorted_values), pick), 0)

"""Fixed-width and explicit-boundary histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latency boundaries of the cart calls, in 100 ns ticks.
ADD_ITEM_BOUNDS = (500000, 600000, 700000, 800000, 900000, 1000000, 1100000)
GET_CART_BOUNDS = (300000, 400000, 500000, 600000, 700000, 800000, 900000)


def fixed_width(df: DataFrame, value: str, width: float = 1) -> DataFrame:
    """Rows per bucket ``[k*width, (k+1)*width)``: ``(bucket, n)``."""
    size = F.lit(width)
    bucket = (F.floor(F.col(value) / size) * size).cast("bigint" if float(width).is_integer() else "double")
    return (
        df.where(F.col(value).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    )


def bucket_index(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the bucket, upper bounds inclusive; the last index is the overflow bucket."""
    ordered = sorted(bounds)
    index = F.when(value <= F.lit(ordered[0]), F.lit(0))
    for position, bound in enumerate(ordered[1:], start=1):
        index = index.when(value <= F.lit(bound), F.lit(position))
    return index.when(value.isNotNull(), F.lit(len(ordered)))


def bucket_counts(index: Column, bounds: Sequence[float]) -> list[Column]:
    """One conditional count per bucket, so empty buckets are kept and all counts combine map-side."""
    return [F.count_if(index == F.lit(i)).alias(f"bucket_{i}") for i in range(len(bounds) + 1)]


def explicit(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Long form of an explicit-boundary histogram: ``(*by, bucket, upper_bound, n)``.

    The overflow bucket has a NULL bound.
    """
    ordered = sorted(bounds)
    index = bucket_index(F.col(value), ordered)
    wide = df.groupBy(*by).agg(*bucket_counts(index, ordered))
    entries = [
        F.struct(
            F.lit(i).alias("bucket"),
            F.lit(ordered[i] if i < len(ordered) else None).cast("double").alias("upper_bound"),
            F.col(f"bucket_{i}").alias("n"),
        )
        for i in range(len(ordered) + 1)
    ]
    return wide.select(*by, F.inline(F.array(*entries)))

"""Labelled counters and request/error/duration metrics from spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import attributes
from tracewell.operators import histogram

# Default duration boundaries of span metrics in milliseconds. They are a parameter.
DURATION_BOUNDS = (2, 4, 6, 8, 10, 50, 100, 200, 400, 800, 1000, 1400, 2000, 5000, 10000, 15000)


def counter(df: DataFrame, labels: Sequence[str], value: Column | int = 1, name: str = "value") -> DataFrame:
    """Sum of ``value`` per label set. Partial sums are built before the shuffle."""
    amount = F.lit(value).cast("bigint") if isinstance(value, int) else value
    return df.groupBy(*labels).agg(F.sum(amount).alias(name))


def span_metrics(
    spans: DataFrame,
    dimensions: Sequence[str] = (),
    bounds: Sequence[float] = DURATION_BOUNDS,
) -> DataFrame:
    """Calls and duration histogram by service, operation and kind.

    ``dimensions`` adds span attributes as further labels. Counts of all buckets come from one
    aggregation; ``bucket_counts`` has one entry per bound plus the overflow.
    """
    ordered = sorted(bounds)
    labelled = spans.select(
        attributes.attribute_text(F.col("resource.attributes"), "service.name").alias("service_name"),
        F.col("name").alias("span_name"),
        F.col("kind").alias("span_kind"),
        *(attributes.attribute_text(F.col("attributes"), d).alias(d) for d in dimensions),
        "elapsedTimeMillis",
    )
    index = histogram.bucket_index(F.col("elapsedTimeMillis"), ordered)
    # attribute names contain dots, so they are quoted as column names
    keys = ["service_name", "span_name", "span_kind", *(f"`{d}`" for d in dimensions)]
    wide = labelled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("elapsedTimeMillis").alias("duration_sum"),
        *histogram.bucket_counts(index, ordered),
    )
    buckets = F.array(*(F.col(f"bucket_{i}") for i in range(len(ordered) + 1)))
    return wide.select(*keys, "calls", "duration_sum", buckets.alias("bucket_counts"))

"""Self time per operation: a span's duration minus that of its direct children.

Rules: children are matched on trace and parent id; a parent without a duration is skipped; missing child
durations count as zero; duplicate parents each subtract the full child sum; orphans subtract nowhere;
overlapping children may make the result negative.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Span fields the plans below read; pass them to the source.
SPAN_FIELDS = ("traceId", "spanId", "parentSpanId", "name", "startTimeUnixNano", "endTimeUnixNano")


def child_sums(spans: DataFrame, *extra: Column) -> DataFrame:
    """Total child duration per parent key, one row per ``(trace, parent)``. ``extra`` aggregates are added."""
    return (
        spans.where(
            F.col("traceId").isNotNull() & F.col("parentSpanId").isNotNull() & F.col("elapsedTimeMillis").isNotNull()
        )
        .groupBy(F.col("traceId").alias("c_trace"), F.col("parentSpanId").alias("c_parent"))
        .agg(F.sum("elapsedTimeMillis").alias("child_ms"), *extra)
    )


def parent_sums(spans: DataFrame, *extra: Column) -> DataFrame:
    """Spans grouped by identity and name, with own duration and the number that have one.

    Repeated or missing span ids collapse here, before the join, so no join key is hot.
    """
    return spans.groupBy("traceId", "spanId", "name").agg(
        F.sum("elapsedTimeMillis").alias("own_ms"), F.count("elapsedTimeMillis").alias("timed"), *extra
    )


def operation_execution_time(spans: DataFrame) -> DataFrame:
    """Self time in milliseconds by operation name, as ``(name, elapsed)``."""
    slim = spans.select("traceId", "spanId", "parentSpanId", "name", "elapsedTimeMillis")
    # laid out by the join key, parents are grouped and joined without moving again
    parents, children = parent_sums(slim.repartition("traceId", "spanId")), child_sums(slim)
    joined = parents.join(
        children,
        (parents["traceId"] == children["c_trace"]) & (parents["spanId"] == children["c_parent"]),
        "left",
    )
    own = F.col("own_ms") - F.col("timed") * F.coalesce("child_ms", F.lit(0).cast("bigint"))
    return joined.groupBy("name").agg(F.sum(own).alias("elapsed"))


def signed_deltas(parents: DataFrame, children: DataFrame) -> DataFrame:
    """What parent/child pairs take away from each operation: ``(name, delta)`` with delta <= 0 for
    ordinary data. Linear in both inputs, so pairs can be added up batch by batch."""
    joined = parents.join(
        children,
        (parents["traceId"] == children["c_trace"]) & (parents["spanId"] == children["c_parent"]),
    )
    return joined.groupBy("name").agg(F.sum(-F.col("timed") * F.col("child_ms")).alias("delta"))


def merge_parents(parents: DataFrame) -> DataFrame:
    """Parent sums of several batches, again one row per identity and name."""
    return parents.groupBy("traceId", "spanId", "name").agg(F.sum("timed").alias("timed"))


def merge_children(children: DataFrame) -> DataFrame:
    """Child sums of several batches, again one row per parent key."""
    return children.groupBy("c_trace", "c_parent").agg(F.sum("child_ms").alias("child_ms"))

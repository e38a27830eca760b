"""Windowed request latency and throughput over root spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions import quantile

WINDOW_WIDTH = "10 seconds"

# Span fields the plans below read; pass them to the source.
SPAN_FIELDS = ("parentSpanId", "startTimeUnixNano", "endTimeUnixNano")


def root_spans(spans: DataFrame) -> DataFrame:
    """Top-level requests carry an empty parent id. A NULL parent id is not a root."""
    return spans.where(F.col("parentSpanId") == "")


def tumble(df: DataFrame, time_column: str = "eventTime", width: str = WINDOW_WIDTH) -> DataFrame:
    """Add the epoch-aligned tumbling window of each row; rows without a time have no window."""
    bucket = F.window(time_column, width)
    return (
        df.withColumn("window", bucket)
        .select("*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
        .drop("window")
    )


def latency_counts(spans: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Root spans counted per window and millisecond: ``(time, ms, n)``.

    Counts are mergeable, so the same table serves throughput and the exact percentile, in batch and
    as a stream. The count is combined before the shuffle, so a window holding most of the rows costs
    no more than its distinct latencies.
    """
    return (
        tumble(root_spans(spans).select("eventTime", "elapsedTimeMillis", "parentSpanId"), width=width)
        .groupBy(F.col("window_start").alias("time"), F.col("elapsedTimeMillis").alias("ms"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def p95_from_counts(counts: DataFrame) -> DataFrame:
    """Exact percentile per window from ``(time, ms, n)``.

    A running count over the distinct latencies locates the two neighbouring ranks. The window
    function sees one row per distinct millisecond, never one row per span. NULL latencies do not
    count; a window with only those yields NULL.
    """
    per_time = Window.partitionBy("time")
    upto = per_time.orderBy("ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col("ms").isNotNull(), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    ranked = counts.select(
        "time",
        "ms",
        known.alias("n"),
        F.sum(known).over(upto).alias("upto"),
        F.sum(known).over(per_time).alias("total"),
    )
    rank = quantile.rank_of(F.col("total"))

    def value_at(index):
        inside = (index < F.col("upto")) & (index >= F.col("upto") - F.col("n"))
        return F.max(F.when(inside, F.col("ms")))

    picked = ranked.groupBy("time").agg(
        F.max("total").alias("total"),
        value_at(rank.lower).alias("low"),
        value_at(rank.upper).alias("high"),
    )
    latency = quantile.between(F.col("low"), F.col("high"), quantile.rank_of(F.col("total")))
    return picked.select(latency.alias("latencyMs"), "time")


def windows_from_counts(counts: DataFrame) -> DataFrame:
    """Percentile and number of requests of every window, ``(time, latencyMs, throughput)``."""
    return p95_from_counts(counts).join(throughput_from_counts(counts), "time")


def p95_latency(spans: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    return p95_from_counts(latency_counts(spans, width))


def throughput_from_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("time").agg(F.sum("n").alias("throughput")).select("throughput", "time")


def throughput(spans: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Requests per window."""
    rooted = tumble(root_spans(spans).select("eventTime", "parentSpanId"), width=width)
    return (
        rooted.groupBy(F.col("window_start").alias("time"))
        .agg(F.count(F.lit(1)).alias("throughput"))
        .select("throughput", "time")
    )

"""Read-side queries over the maintained tables.

Each takes the table it reads and an inclusive time range, so the predicate reaches the parquet scan.
Without a range the last five minutes are read.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators import histogram, latency
from tracewell.sinks import tables

DEFAULT_RANGE = timedelta(minutes=5)
REFRESH = timedelta(seconds=10)
SLOWEST = 6

TimeLike = datetime | str | None


def default_range(now: datetime | None = None) -> tuple[datetime, datetime]:
    end = now or datetime.now(timezone.utc).replace(tzinfo=None)
    return end - DEFAULT_RANGE, end


def _bounds(time_from: TimeLike, time_to: TimeLike) -> tuple[Column, Column]:
    start, end = default_range()
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (time_from or start, time_to or end))
    return low, high


def in_range(column: str, time_from: TimeLike = None, time_to: TimeLike = None) -> Column:
    """Both ends inclusive; a missing end falls back to the default range."""
    return F.col(column).between(*_bounds(time_from, time_to))


def _roots(spans: DataFrame, time_from: TimeLike, time_to: TimeLike) -> DataFrame:
    dated = tables.in_dates(spans, *_bounds(time_from, time_to))
    return latency.root_spans(dated).where(in_range("eventTime", time_from, time_to))


def execution_time_by_operation(operation_execution_time: DataFrame) -> DataFrame:
    return operation_execution_time.groupBy("name").agg(F.sum("elapsed").alias("elapsed"))


def request_latencies(spans: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None) -> DataFrame:
    """Root latencies, newest first."""
    return _roots(spans, time_from, time_to).orderBy(F.desc("eventTime")).select("elapsedTimeMillis")


def latency_histogram(
    spans: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None, width: float = 1
) -> DataFrame:
    """Root latencies in buckets of one millisecond. Aggregates directly; the order of the rows that
    feed a histogram does not matter, so nothing is sorted."""
    return histogram.fixed_width(_roots(spans, time_from, time_to), "elapsedTimeMillis", width)


def requests_in_range(spans: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None) -> DataFrame:
    return _roots(spans, time_from, time_to).agg(F.count(F.lit(1)).alias("num_traces"))


def slowest_traces(
    spans: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None, limit: int = SLOWEST
) -> DataFrame:
    """The slowest requests. Ties are broken by ids so the result is stable."""
    return (
        _roots(spans, time_from, time_to)
        .select("traceId", "spanId", "name", "elapsedTimeMillis")
        .orderBy(F.desc_nulls_last("elapsedTimeMillis"), "traceId", "spanId")
        .limit(limit)
        .select("traceId", "name", "elapsedTimeMillis")
    )


def throughput_series(throughput: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None) -> DataFrame:
    return _series(throughput, "throughput", time_from, time_to)


def p95_series(p95_latency: DataFrame, time_from: TimeLike = None, time_to: TimeLike = None) -> DataFrame:
    return _series(p95_latency, "latencyMs", time_from, time_to)


def _series(table: DataFrame, value: str, time_from: TimeLike, time_to: TimeLike) -> DataFrame:
    """A metric over time, newest first, with the field types a chart needs: number and time."""
    return (
        table.where(in_range("time", time_from, time_to))
        .select(F.col(value).cast("bigint").alias(value), F.col("time").cast("timestamp_ntz").alias("time"))
        .orderBy(F.desc("time"))
    )

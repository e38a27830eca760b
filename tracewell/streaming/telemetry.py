"""Continuously maintained telemetry tables.

Flat tables are append streams. Aggregates are kept as levelled logs of mergeable changes: each micro-batch adds
its counts per window and latency, and its signed contributions to self time. Late rows therefore update
their window whenever they arrive, no operator state grows, and a replayed batch changes nothing. Latency and
throughput are served from a table of their own, in which a batch replaces the windows it touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, TimestampNTZType

from tracewell.functions import text
from tracewell.operators import flatten, latency, selftime
from tracewell.plans import dashboard
from tracewell.sinks import levels, tables

COUNTS = "latency_counts"
SELF_DELTAS = "self_time_deltas"
PARENTS = "self_time_parents"
CHILDREN = "self_time_children"
SERVED = "latency_served"
SEEN_DATE = "seen_date"
DATE = "date"

TIME, LONG, DAY, STRING = TimestampNTZType(), LongType(), DateType(), StringType()

COUNT_LOG = levels.Spec(
    COUNTS,
    levels.columns(("time", TIME), ("ms", LONG), ("n", LONG), (DATE, DAY)),
    keys=("time", "ms", DATE),
    route=("time",),
    sums=("n",),
    day=DATE,
)
SERVED_LOG = levels.Spec(
    SERVED,
    levels.columns(("time", TIME), ("latencyMs", LONG), ("throughput", LONG), ("version", LONG), (DATE, DAY)),
    keys=("time", DATE),
    route=("time",),
    newest=("latencyMs", "throughput"),
    version="version",
    day=DATE,
)
DELTA_LOG = levels.Spec(
    SELF_DELTAS, levels.columns(("name", STRING), ("delta", LONG)), keys=("name",), route=("name",), sums=("delta",)
)
PARENT_LOG = levels.Spec(
    PARENTS,
    levels.columns(("traceId", STRING), ("spanId", STRING), ("name", STRING), ("timed", LONG), (SEEN_DATE, DAY)),
    keys=("traceId", "spanId", "name", SEEN_DATE),
    route=("traceId", "spanId"),
    sums=("timed",),
    day=SEEN_DATE,
)
CHILD_LOG = levels.Spec(
    CHILDREN,
    levels.columns(("c_trace", STRING), ("c_parent", STRING), ("child_ms", LONG), (SEEN_DATE, DAY)),
    keys=("c_trace", "c_parent", SEEN_DATE),
    route=("c_trace", "c_parent"),
    sums=("child_ms",),
    day=SEEN_DATE,
)


def _start(writer, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_table(
    df: DataFrame,
    store: str,
    name: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
    return _start(writer.option("path", tables.path(store, name)), checkpoint, available_now, interval)


# ``root`` is the request array: a column of a file source, or ``sources.telemetry.payload`` of a message.


def append_spans(
    requests: DataFrame,
    store: str,
    checkpoint: str,
    root: Column | str = "resourceSpans",
    normalize_names: bool = False,
    **trigger,
) -> StreamingQuery:
    """The flat ``spans`` table, one folder per event date. ``normalize_names`` gives product routes one span name."""
    spans = tables.with_date(flatten.spans(requests, on_bad_record="null", root=root))
    if normalize_names:
        spans = spans.withColumn("name", text.normalize_span_name(F.col("name")))
    return append_table(spans, store, "spans", checkpoint, partition_by=(tables.EVENT_DATE,), **trigger)


def append_logs(
    requests: DataFrame, store: str, checkpoint: str, root: Column | str = "resourceLogs", **trigger
) -> StreamingQuery:
    """The flat ``logs`` table, one folder per date."""
    logs = tables.with_log_date(flatten.logs(requests, root))
    return append_table(logs, store, "logs", checkpoint, partition_by=(tables.EVENT_DATE,), **trigger)


def append_metrics(
    requests: DataFrame, store: str, checkpoint: str, root: Column | str = "resourceMetrics", **trigger
) -> StreamingQuery:
    return append_table(flatten.metrics(requests, root), store, "metrics", checkpoint, **trigger)


def windowed_throughput(
    spans: DataFrame, width: str = latency.WINDOW_WIDTH, lateness: str | None = None
) -> DataFrame:
    """Throughput as a streaming frame with operator state.

    Without ``lateness`` any late row still updates its window and the state keeps every window; with
    it, a watermark drops later rows and closes windows.
    """
    # a watermark needs a zoned time; the session zone is UTC
    timed = spans.withColumn("eventTime", F.col("eventTime").cast("timestamp"))
    if lateness is not None:
        timed = timed.withWatermark("eventTime", lateness)
    bucket = F.window("eventTime", width)
    return (
        latency.root_spans(timed)
        .groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("throughput"))
        .select("throughput", F.col("window.start").cast("timestamp_ntz").alias("time"))
    )


# Changes of one batch -------------------------------------------------------------------------------


def _add_self_time(
    spans: DataFrame, store: str, batch_id: int, lateness: timedelta | None = None, **layout: int
) -> None:
    """Contributions of one batch: own durations, minus those of children for every parent/child pair in which at least
    one side is new. Earlier sides are read from earlier batches only, so a replay sees what the first attempt saw,
    and only from the buckets that hold keys of this batch, whatever the length of the log.

    A pair may be split over batches by any distance. With ``lateness`` the days that lie further behind the latest
    day seen are left out and deleted.
    """
    spark = spans.sparkSession
    day = F.max("eventTime").cast("date").alias(SEEN_DATE)
    parent_log = levels.Log(spark, store, PARENT_LOG, lateness, **layout)
    child_log = levels.Log(spark, store, CHILD_LOG, lateness, **layout)
    sums = selftime.parent_sums(spans, day).persist()
    try:
        paired = sums.where("traceId IS NOT NULL AND spanId IS NOT NULL AND timed > 0")
        parents = parent_log.added(paired, batch_id)
        children = child_log.added(selftime.child_sums(spans, day), batch_id)
        parent_keys = parents.select(F.col("traceId").alias("c_trace"), F.col("spanId").alias("c_parent"))
        child_keys = children.select(F.col("c_trace").alias("traceId"), F.col("c_parent").alias("spanId"))
        old_children = child_log.read(upto=batch_id - 1, touching=parent_keys)
        old_children = old_children.join(parent_keys.distinct(), ["c_trace", "c_parent"], "left_semi")
        old_parents = parent_log.read(upto=batch_id - 1, touching=child_keys)
        old_parents = old_parents.join(child_keys.distinct(), ["traceId", "spanId"], "left_semi")
        changes = [
            sums.groupBy("name").agg(F.sum("own_ms").alias("delta")),
            selftime.signed_deltas(parents, selftime.merge_children(old_children.unionByName(children))),
            selftime.signed_deltas(selftime.merge_parents(old_parents), children),
        ]
        combined = DELTA_LOG.folded(changes[0].unionByName(changes[1]).unionByName(changes[2]))
        levels.Log(spark, store, DELTA_LOG, **layout).add(combined, batch_id)
    finally:
        sums.unpersist()


def _add_latency(
    spans: DataFrame, store: str, batch_id: int, width: str, retention: timedelta | None = None, **layout: int
) -> None:
    """Counts of one batch, and the windows it touched, computed anew and served under the batch as their version.

    Only the days and buckets of touched windows are read.
    """
    spark = spans.sparkSession
    log = levels.Log(spark, store, COUNT_LOG, retention, **layout)
    new = log.added(latency.latency_counts(spans, width).withColumn(DATE, F.col("time").cast("date")), batch_id)
    touched = new.select("time").distinct()
    days = new.agg(F.min(DATE), F.max(DATE)).first()
    counted = log.read(upto=batch_id, touching=touched, days=tuple(days) if days[0] else None)
    counted = COUNT_LOG.folded(counted.join(touched, "time", "left_semi"))
    windows = latency.windows_from_counts(counted).withColumns(
        {"version": F.lit(batch_id).cast("bigint"), DATE: F.col("time").cast("date")}
    )
    levels.Log(spark, store, SERVED_LOG, retention, **layout).add(windows, batch_id)


def maintain(
    requests: DataFrame,
    store: str,
    checkpoint: str,
    width: str = latency.WINDOW_WIDTH,
    lateness: timedelta | None = None,
    root: Column | str = "resourceSpans",
    available_now: bool = False,
    interval: str = "10 seconds",
    tables_kept: Sequence[str] = (COUNTS, SELF_DELTAS),
    retention: timedelta | None = None,
    **layout: int,
) -> StreamingQuery:
    """Keep latency, throughput and self time up to date from a stream of trace requests.

    ``tables_kept`` names what is wanted: counts per window and latency with the served windows, self time, or both.
    ``lateness`` bounds how far apart the days of a parent and its child may be, ``retention`` how long windows stay.
    ``layout`` (``fanout``, ``bucket_bytes``, ``grace``) is that of :class:`tracewell.sinks.levels.Log`. Narrow the source
    to :data:`tracewell.operators.selftime.SPAN_FIELDS`; nothing else is read.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spans = batch.persist()
        try:
            if COUNTS in tables_kept:
                _add_latency(spans, store, batch_id, width, retention, **layout)
            if SELF_DELTAS in tables_kept:
                _add_self_time(spans, store, batch_id, lateness, **layout)
        finally:
            spans.unpersist()

    slim = flatten.spans(requests, on_bad_record="null", root=root).select(
        "traceId", "spanId", "parentSpanId", "name", "elapsedTimeMillis", "eventTime"
    )
    return _start(slim.writeStream.foreachBatch(fold), checkpoint, available_now, interval)


# Reading -----------------------------------------------------------------------------------------


def served(
    spark: SparkSession, store: str, time_from: datetime | str | None = None, time_to: datetime | str | None = None
) -> DataFrame:
    """``(time, latencyMs, throughput)`` of every window, or of those on the days of a time range."""
    days = None
    if time_from is not None and time_to is not None:
        days = tuple(datetime.fromisoformat(str(t)).date() for t in (time_from, time_to))
    return levels.Log(spark, store, SERVED_LOG).folded(days=days).select("time", "latencyMs", "throughput")


def p95_latency(spark: SparkSession, store: str) -> DataFrame:
    return served(spark, store).select("latencyMs", "time")


def throughput(spark: SparkSession, store: str) -> DataFrame:
    return served(spark, store).select("throughput", "time")


def p95_series(spark: SparkSession, store: str, time_from: datetime | str, time_to: datetime | str) -> DataFrame:
    """The latency panel over a range, newest first; no other day's folders are opened."""
    return dashboard.p95_series(served(spark, store, time_from, time_to), time_from, time_to)


def throughput_series(spark: SparkSession, store: str, time_from: datetime | str, time_to: datetime | str) -> DataFrame:
    return dashboard.throughput_series(served(spark, store, time_from, time_to), time_from, time_to)


def operation_execution_time(spark: SparkSession, store: str) -> DataFrame:
    return levels.Log(spark, store, DELTA_LOG).folded().select("name", F.col("delta").alias("elapsed"))

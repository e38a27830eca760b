"""Labelled counters over time: increments per label set and time bucket, kept as a levelled log and read as cumulative
series without gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, TimestampNTZType

from tracewell.sinks import levels

TIME, DAY, ADDED = "time", "day", "added"


def spec(name: str, labels: Sequence[str]) -> levels.Spec:
    """The log of a counter. Label values are text."""
    columns = [*((c, StringType()) for c in labels), (TIME, TimestampNTZType()), (ADDED, LongType()), (DAY, DateType())]
    return levels.Spec(
        name, levels.columns(*columns), keys=(*labels, TIME, DAY), route=(*labels, TIME), sums=(ADDED,), day=DAY
    )


def increments(
    rows: DataFrame, labels: Sequence[str], time: str, width: str, value: Column | int = 1
) -> DataFrame:
    """What rows add per label set and bucket; rows without a time add nothing."""
    amount = F.lit(value) if isinstance(value, int) else value
    bucket = F.window(F.col(time).cast("timestamp_ntz"), width)
    grouped = rows.groupBy(*(F.col(c).cast("string").alias(c) for c in labels), bucket.alias("w"))
    found = grouped.agg(F.sum(amount.cast("bigint")).alias(ADDED))
    start = F.col("w.start").cast("timestamp_ntz")
    return found.select(*labels, start.alias(TIME), ADDED, start.cast("date").alias(DAY))


def maintain(
    rows: DataFrame,
    store: str,
    checkpoint: str,
    name: str,
    labels: Sequence[str],
    time: str,
    width: str = "1 minute",
    value: Column | int = 1,
    retention: timedelta | None = None,
    available_now: bool = False,
    interval: str = "10 seconds",
    **layout: int,
) -> StreamingQuery:
    """Count a stream. Late rows add to their bucket; a replayed batch changes nothing."""

    def add(batch: DataFrame, batch_id: int) -> None:
        log = levels.Log(batch.sparkSession, store, spec(name, labels), retention, **layout)
        log.add(increments(batch, labels, time, width, value), batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns), F.lit(True))


def cumulative(added: DataFrame, labels: Sequence[str], width: str) -> DataFrame:
    """``(*labels, time, total)`` of ``added`` (a row for each label set and bucket): a label set's total at every bucket from
    its first to the last of all.

    Totals are summed by day first. A window over days gives what came before each day, one over a day's buckets the rest,
    so no window grows with the length of the series times its resolution.
    """
    last = added.agg(F.max(TIME)).first()[0]
    if last is None:
        return added.select(*labels, TIME, F.col(ADDED).alias("total"))
    end = F.lit(str(last)).cast("timestamp_ntz")
    days = added.groupBy(*labels, DAY).agg(F.sum(ADDED).alias("in_day"), F.min(TIME).alias("first"))
    sets = days.groupBy(*labels).agg(F.min("first").alias("begin"))
    step = F.expr(f"INTERVAL {width}")
    grid = sets.select("*", F.explode(F.sequence(F.col("begin").cast("date"), end.cast("date"))).alias(DAY))
    joined = grid.alias("g").join(days.alias("d"), _same("g", "d", [*labels, DAY]), "left")
    joined = joined.select(*(f"g.{c}" for c in [*labels, DAY, "begin"]), F.coalesce("in_day", F.lit(0)).alias("in_day"))
    earlier = Window.partitionBy(*labels).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    before = joined.withColumn("before", F.coalesce(F.sum("in_day").over(earlier), F.lit(0)))

    midnight = F.col(DAY).cast("timestamp_ntz")
    first = F.when(F.col("begin") > midnight, F.col("begin")).otherwise(midnight)
    until = F.least(end, F.date_add(DAY, 1).cast("timestamp_ntz") - step)
    buckets = before.where(first <= until).select(*labels, DAY, "before", F.explode(F.sequence(first, until, step)).alias(TIME))
    filled = buckets.alias("b").join(added.alias("a"), _same("b", "a", [*labels, TIME]), "left")
    filled = filled.select(*(f"b.{c}" for c in [*labels, DAY, TIME, "before"]), F.coalesce(ADDED, F.lit(0)).alias(ADDED))
    upto = Window.partitionBy(*labels, DAY).orderBy(TIME).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.select(*labels, TIME, (F.col("before") + F.sum(ADDED).over(upto)).alias("total"))


def series(spark: SparkSession, store: str, name: str, labels: Sequence[str], width: str = "1 minute") -> DataFrame:
    """The counter as cumulative series. ``width`` is that of its buckets, and divides a day."""
    return cumulative(levels.Log(spark, store, spec(name, labels)).folded(), labels, width)

"""Data points of metrics, one row each, from the VARIANT payloads of the flat metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The payloads that hold data points.
KINDS = ("sum", "gauge", "histogram", "exponentialHistogram", "summary")


def _get(path: str, kind: str, source: str = "point") -> Column:
    return F.try_variant_get(F.col(source), path, kind)


def _numbers(path: str, kind: str) -> Column:
    """An array whose numbers may be written as text, as 64-bit ones are."""
    return F.transform(_get(path, "array<string>"), lambda x: x.try_cast(kind))


def data_points(metrics: DataFrame, keep: Sequence[str] = ("name", "unit"), kinds: Sequence[str] = KINDS) -> DataFrame:
    """``(*keep, kind, point_no, start_nanos, time_nanos, value, count, sum, min, max, bounds, buckets, attributes)``.

    ``value`` is that of sums and gauges, whole or not; ``count`` to ``max`` those of the other kinds, ``bounds`` and
    ``buckets`` those of explicit histograms. A metric without points has no rows. Points are unnested once, and a
    payload that a metric lacks costs nothing.
    """
    present = [c for c in kinds if c in metrics.columns]
    listed = F.array(*(F.struct(F.lit(c).alias("kind"), _get("$.dataPoints", "array<variant>", c).alias("points")) for c in present))
    payloads = metrics.select(*keep, F.explode(F.filter(listed, lambda p: F.size(p["points"]) > 0)).alias("payload"))
    points = payloads.select(*keep, "payload.kind", F.posexplode("payload.points").alias("point_no", "point"))
    whole = _get("$.asInt", "string").try_cast("bigint").cast("double")
    return points.select(
        *keep,
        "kind",
        "point_no",
        _get("$.startTimeUnixNano", "string").try_cast("bigint").alias("start_nanos"),
        _get("$.timeUnixNano", "string").try_cast("bigint").alias("time_nanos"),
        F.coalesce(whole, _get("$.asDouble", "double")).alias("value"),
        _get("$.count", "string").try_cast("bigint").alias("count"),
        *(_get(f"$.{c}", "double").alias(c) for c in ("sum", "min", "max")),
        _numbers("$.explicitBounds", "double").alias("bounds"),
        _numbers("$.bucketCounts", "bigint").alias("buckets"),
        _get("$.attributes", "variant").alias("attributes"),
    )

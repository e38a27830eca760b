"""Unnesting of exporter requests into flat rows.

Each level is an inner ``inline``: parents whose array is empty or NULL give no rows. The three levels
run in one narrow stage without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import clock

LOG_COLUMNS = (
    "resource",
    "scope",
    "attributes",
    "timeUnixNano",
    "observedTimeUnixNano",
    "severityNumber",
    "severityText",
    "flags",
    "traceId",
    "spanId",
    "eventName",
    "body",
)
METRIC_COLUMNS = (
    "name",
    "description",
    "unit",
    "sum",
    "summary",
    "gauge",
    "histogram",
    "exponentialHistogram",
    "resource",
    "scope",
    "metadata",
)


def _unnest(df: DataFrame, array: Column | str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(c for c in keep if c in df.columns), F.inline(array))


def resource_spans(requests: DataFrame, root: Column | str = "resourceSpans") -> DataFrame:
    return _unnest(requests, root)


def scope_spans(requests: DataFrame, root: Column | str = "resourceSpans") -> DataFrame:
    return _unnest(resource_spans(requests, root), "scopeSpans", ("resource",))


def spans(requests: DataFrame, on_bad_record: str = "fail", root: Column | str = "resourceSpans") -> DataFrame:
    """Flat spans with their duration in milliseconds and event time in whole seconds.

    Works on any subset of span fields that keeps both times, with or without resource and scope.
    """
    flat = _unnest(scope_spans(requests, root), "spans", ("resource", "scope"))
    start = clock.text_to_bigint(F.col("startTimeUnixNano"), on_bad_record)
    end = clock.text_to_bigint(F.col("endTimeUnixNano"), on_bad_record)
    return flat.withColumns(
        {
            "elapsedTimeMillis": clock.nanos_to_millis(end - start),
            "eventTime": clock.timestamp_from_nanos(start),
        }
    )


def resource_logs(requests: DataFrame, root: Column | str = "resourceLogs") -> DataFrame:
    return _unnest(requests, root)


def scope_logs(requests: DataFrame, root: Column | str = "resourceLogs") -> DataFrame:
    return _unnest(resource_logs(requests, root), "scopeLogs", ("resource",))


def logs(requests: DataFrame, root: Column | str = "resourceLogs") -> DataFrame:
    flat = _unnest(scope_logs(requests, root), "logRecords", ("resource", "scope"))
    return flat.select(*(c for c in LOG_COLUMNS if c in flat.columns))


def resource_metrics(requests: DataFrame, root: Column | str = "resourceMetrics") -> DataFrame:
    return _unnest(requests, root)


def scope_metrics(requests: DataFrame, root: Column | str = "resourceMetrics") -> DataFrame:
    return _unnest(resource_metrics(requests, root), "scopeMetrics", ("resource",))


def metrics(requests: DataFrame, root: Column | str = "resourceMetrics") -> DataFrame:
    """Flat metrics; point payloads stay VARIANT."""
    flat = _unnest(scope_metrics(requests, root), "metrics", ("resource", "scope"))
    return flat.select(*(c for c in METRIC_COLUMNS if c in flat.columns))

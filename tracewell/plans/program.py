"""The telemetry program: input tables, flat views, functions and maintained aggregates by name.

``register`` makes them queryable from SQL; ``run_batch`` writes the maintained ones as tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import text
from tracewell.operators import flatten, latency, selftime
from tracewell.session import configure
from tracewell.sinks import tables

SQL_FUNCTIONS = (
    "CREATE OR REPLACE TEMPORARY FUNCTION nanos_to_seconds(nanos BIGINT) RETURNS BIGINT "
    "RETURN nanos DIV 1000000000",
    "CREATE OR REPLACE TEMPORARY FUNCTION nanos_to_millis(nanos BIGINT) RETURNS BIGINT "
    "RETURN nanos DIV 1000000",
    "CREATE OR REPLACE TEMPORARY FUNCTION make_timestamp_from_nanos(nanos BIGINT) RETURNS TIMESTAMP_NTZ "
    "RETURN TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, nanos_to_seconds(nanos))",
    # 0.95D * n - 1 is a zero-based rank; neighbours are interpolated and the result truncated
    "CREATE OR REPLACE TEMPORARY FUNCTION p95(x ARRAY<BIGINT>) RETURNS BIGINT RETURN "
    "get(transform(array(array_sort(filter(x, v -> v IS NOT NULL))), s -> "
    "get(transform(array(0.95D * size(s) - 1.0D), r -> "
    "IF(floor(r) = ceil(r) OR r < 0, get(s, CAST(greatest(floor(r), 0) AS INT)), "
    "CAST(get(s, CAST(floor(r) AS INT)) * (1.0D - (r - floor(r))) "
    "+ get(s, CAST(ceil(r) AS INT)) * (r - floor(r)) AS BIGINT))), 0)), 0)",
)

MAINTAINED = ("metrics", "logs", "spans", "p95_latency", "throughput", "operation_execution_time")


def views(
    traces: DataFrame | None = None,
    logs: DataFrame | None = None,
    metrics: DataFrame | None = None,
    window: str = latency.WINDOW_WIDTH,
    on_bad_record: str = "fail",
    normalize_names: bool = False,
) -> dict[str, DataFrame]:
    """All views reachable from the given inputs, by name. ``normalize_names`` gives product routes one span name."""
    found: dict[str, DataFrame] = {}
    if metrics is not None:
        found["rsMetrics"] = flatten.resource_metrics(metrics)
        found["metrics_array"] = flatten.scope_metrics(metrics)
        found["metrics"] = flatten.metrics(metrics)
    if logs is not None:
        found["rsLogs"] = flatten.resource_logs(logs)
        found["logs_array"] = flatten.scope_logs(logs)
        found["logs"] = flatten.logs(logs)
    if traces is not None:
        spans = flatten.spans(traces, on_bad_record)
        if normalize_names:
            spans = spans.withColumn("name", text.normalize_span_name(F.col("name")))
        found["rsSpans"] = flatten.resource_spans(traces)
        found["spans_array"] = flatten.scope_spans(traces)
        found["spans"] = spans
        found["spans_tumble_10s"] = latency.tumble(spans, width=window)
        found["p95_latency"] = latency.p95_latency(spans, window)
        found["throughput"] = latency.throughput(spans, window)
        found["operation_execution_time"] = selftime.operation_execution_time(spans)
    return found


def register_functions(spark: SparkSession) -> None:
    for statement in SQL_FUNCTIONS:
        spark.sql(statement)


def register(spark: SparkSession, **inputs: DataFrame) -> dict[str, DataFrame]:
    """Create the SQL functions and a temporary view for every reachable name."""
    configure(spark)
    register_functions(spark)
    found = views(**inputs)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found


def run_batch(
    store: str, only: Iterable[str] = MAINTAINED, window: str = latency.WINDOW_WIDTH, **inputs: DataFrame
) -> list[str]:
    """Write the maintained views named in ``only`` below ``store``. The aggregates read the stored ``spans``, which are
    written first if they are asked for or not there yet, so requests are parsed and flattened once. Spans and logs
    lie in folders by date."""
    wanted = set(only)
    found = views(**inputs, window=window)
    written = []
    if "metrics" in wanted and "metrics" in found:
        tables.write(found["metrics"], store, "metrics")
        written.append("metrics")
    if "logs" in wanted and "logs" in found:
        tables.write(tables.with_log_date(found["logs"]), store, "logs", partition_by=(tables.EVENT_DATE,))
        written.append("logs")
    aggregated = wanted & {"p95_latency", "throughput", "operation_execution_time"}
    if "spans" in found and (aggregated or "spans" in wanted):
        spark = found["spans"].sparkSession
        if "spans" in wanted or not tables.exists(spark, store, "spans"):
            tables.write(tables.with_date(found["spans"]), store, "spans", partition_by=(tables.EVENT_DATE,))
            written.append("spans")
        spans = tables.read(spark, store, "spans")
        aggregates = {
            "p95_latency": latency.p95_latency(spans, window),
            "throughput": latency.throughput(spans, window),
            "operation_execution_time": selftime.operation_execution_time(spans),
        }
        for name, df in aggregates.items():
            if name in wanted:
                tables.write(df, store, name)
                written.append(name)
    return written

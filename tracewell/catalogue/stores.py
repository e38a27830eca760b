"""Queries over stored tables: telemetry is written as a program run writes it, and dashboards read what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tracewell import fixtures
from tracewell.catalogue import telemetry as batch
from tracewell.operators import selftime
from tracewell.plans import dashboard, program
from tracewell.session import checkpoint_path, configure
from tracewell.sinks import tables


def _store(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A new store with the named tables, from nested requests of all three kinds."""
    store = checkpoint_path(configure(spark), f"store-{uuid.uuid4().hex}")
    inputs = {}
    if "logs" in names:
        inputs["logs"] = fixtures.events(spark, sf_dir).select(fixtures.log_root().alias("resourceLogs"))
    if "metrics" in names:
        inputs["metrics"] = fixtures.metric_requests(spark, sf_dir)
    if {"spans", "p95_latency"} & set(names):
        inputs["traces"] = fixtures.trace_requests(spark, sf_dir, fields=selftime.SPAN_FIELDS, envelope=False)
    program.run_batch(store, only=names, window=batch.DAY, **inputs)
    return store


def store_requests_in_range(spark, sf_dir) -> DataFrame:
    return dashboard.requests_in_range(tables.read(spark, _store(spark, sf_dir, "spans"), "spans"), *batch.RANGE)


def store_slowest_traces(spark, sf_dir) -> DataFrame:
    return dashboard.slowest_traces(tables.read(spark, _store(spark, sf_dir, "spans"), "spans"), *batch.RANGE)


def store_p95_series(spark, sf_dir) -> DataFrame:
    return dashboard.p95_series(tables.read(spark, _store(spark, sf_dir, "p95_latency"), "p95_latency"), *batch.RANGE)


def store_logs(spark, sf_dir) -> DataFrame:
    return batch.scalar_logs(tables.read(spark, _store(spark, sf_dir, "logs"), "logs"))


def store_metrics(spark, sf_dir) -> DataFrame:
    return batch.scalar_metrics(tables.read(spark, _store(spark, sf_dir, "metrics"), "metrics"))


QUERIES = {
    f.__name__: f
    for f in (store_requests_in_range, store_slowest_traces, store_p95_series, store_logs, store_metrics)
}

ORACLE = {
    "store_requests_in_range": batch.ORACLE["requests_in_range"],
    "store_slowest_traces": batch.ORACLE["slowest_traces"],
    "store_p95_series": batch.ORACLE["p95_series"],
    "store_logs": batch.ORACLE["logs_flatten"],
    "store_metrics": batch.ORACLE["metrics_flatten"],
}

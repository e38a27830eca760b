"""What the optimizer makes of the plans, with automatic broadcasts off as on large tables."""

import pytest
from pyspark.sql import functions as F

from tracewell.catalogue import shop, telemetry as telemetry_queries
from tracewell import fixtures
from tracewell.operators import flatten, latency, selftime
from tracewell.plans import dashboard, orders, program
from tracewell.sources import telemetry

SF = "/root/testdata/sf0.001"
QUERIES = {**telemetry_queries.QUERIES, **shop.QUERIES}
BATCH = sorted(QUERIES)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key in keys:
        spark.conf.unset(key)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_query_pairs_all_rows_or_forces_a_broadcast(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "BatchEvalPython"):
        assert operator not in text


@pytest.mark.parametrize("name", sorted(set(BATCH) - {"money_sum"}))
def test_rows_are_not_sorted_to_be_aggregated(no_broadcast, name):
    assert "SortAggregate" not in plan(QUERIES[name](no_broadcast, SF))


def test_flatten_does_not_shuffle(spark):
    assert "Exchange" not in plan(flatten.spans(fixtures.trace_requests(spark, SF)))


def test_self_time_is_one_equi_join_of_combined_sides(no_broadcast):
    text = plan(QUERIES["operation_execution_time"](no_broadcast, SF))
    assert text.count("SortMergeJoin [traceId") == 1
    assert text.count("Exchange hashpartitioning") == 3


def test_percentile_windows_see_counts(no_broadcast):
    text = plan(QUERIES["p95_latency"](no_broadcast, SF))
    assert text.index("Window [") < text.index("partial_count")
    assert text.count("Exchange") == 2
    assert "collect_list" not in text


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject(limit=6" in plan(QUERIES["slowest_traces"](spark, SF))


def test_narrow_reads_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "requests")
    fixtures.trace_requests(spark, SF).write.parquet(path)
    slim = telemetry.traces(spark, path, fields=latency.SPAN_FIELDS, envelope=False, fmt="parquet")
    text = plan(latency.throughput(flatten.spans(slim)))
    assert "attributes" not in text and "traceId" not in text
    full = flatten.spans(telemetry.traces(spark, path, fmt="parquet"))
    assert latency.throughput(flatten.spans(slim)).count() == latency.throughput(full).count()


def test_range_is_pushed_to_the_stored_table(spark, tmp_path):
    store = str(tmp_path)
    slim = fixtures.trace_requests(spark, SF, fields=selftime.SPAN_FIELDS, envelope=False)
    program.run_batch(store, traces=slim)
    spans = spark.read.parquet(f"{store}/spans")
    text = plan(dashboard.requests_in_range(spans, "2024-01-02", "2024-01-03"))
    assert "PushedFilters: [IsNotNull(parentSpanId), IsNotNull(eventTime), EqualTo(parentSpanId,)" in text
    assert "GreaterThanOrEqual(eventT" in text
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<parentSpanId:string,eventTime:timestamp_ntz>" in text


def test_hot_product_join_is_split(spark):
    """A third of the items reference one product; adaptive execution splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 500).cast("string"))
        items = spark.range(0, 60_000, 1, 16).select(
            F.col("id").cast("string").alias("order_id"), hot.alias("product_id"), F.lit(1).alias("quantity")
        )
        products = fixtures.products(spark, "/root/testdata/sf0.01")
        joined = orders.enrich(items, products)
        rows = joined.collect()
        assert len(rows) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

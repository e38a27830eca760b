"""Streaming queries: a table is replayed as a stream and the maintained result is read back.

Each call writes below a new folder of the checkpoint root and is checked by the SQL of its batch twin.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import fixtures
from tracewell.catalogue import shop
from tracewell.catalogue import telemetry as batch
from tracewell.operators import selftime
from tracewell.session import checkpoint_path, configure
from tracewell.sinks import deltas
from tracewell.sources import catalog
from tracewell.streaming import cart, counters, orders, telemetry


def _run_folder(spark: SparkSession) -> tuple[str, str]:
    folder = checkpoint_path(configure(spark), f"run-{uuid.uuid4().hex}")
    return f"{folder}/store", f"{folder}/checkpoint"


def _maintained(spark: SparkSession, sf_dir: str, width: str, kept: str) -> str:
    store, checkpoint = _run_folder(spark)
    root = fixtures.trace_root(fields=selftime.SPAN_FIELDS, envelope=False)
    events = fixtures.events(spark, sf_dir, streaming=True)
    telemetry.maintain(events, store, checkpoint, width=width, root=root, available_now=True, tables_kept=(kept,)).awaitTermination()
    return store


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.throughput(spark, _maintained(spark, sf_dir, "10 seconds", telemetry.COUNTS))


def stream_p95_latency_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.p95_latency(spark, _maintained(spark, sf_dir, batch.DAY, telemetry.COUNTS))


def stream_operation_execution_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.operation_execution_time(spark, _maintained(spark, sf_dir, batch.DAY, telemetry.SELF_DELTAS))


def served_p95_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency panel from the served table of a stream whose batches come in the wrong order."""
    return telemetry.p95_series(spark, _maintained(spark, sf_dir, batch.DAY, telemetry.COUNTS), *batch.RANGE)


def served_throughput_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.throughput_series(spark, _maintained(spark, sf_dir, "10 seconds", telemetry.COUNTS), *batch.RANGE)


def stream_counter_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type as cumulative hourly series, from batches in the wrong order."""
    store, checkpoint = _run_folder(spark)
    rows = fixtures.replay(spark, sf_dir, "events", "event_id")
    labels = ["event_type"]
    counters.maintain(rows, store, checkpoint, "events", labels, "ts", width="1 hour", available_now=True).awaitTermination()
    return counters.series(spark, store, "events", labels, width="1 hour")


def stream_cart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carts after writes that came in the wrong order."""
    store, checkpoint = _run_folder(spark)
    writes = fixtures.cart_writes(spark, sf_dir, streaming=True)
    cart.maintain(writes, store, checkpoint, ttl=shop.CART_LIFE, available_now=True).awaitTermination()
    return cart.items(spark, store, shop.CART_LIFE)


def stream_order_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items joined to a catalog that changes between batches: brands are added, and prices rise by a unit."""
    store, checkpoint = _run_folder(spark)
    loads, ticks = itertools.count(), itertools.count(0, 60)

    def load() -> DataFrame:
        step = next(loads)
        found = fixtures.products(spark, sf_dir, shop.IN_CATALOG if step == 0 else "true")
        return found.withColumn("price_usd", F.col("price_usd").withField("units", F.col("price_usd.units") + F.lit(step)))

    products = catalog.Versions(load, store, clock=lambda: next(ticks))
    items = fixtures.items(spark, sf_dir, streaming=True)
    orders.enrich(items, store, checkpoint, products, available_now=True).awaitTermination()
    found = deltas.read(spark, store, orders.ENRICHED)
    return found.select("order_id", "product_id", "quantity", "name", "price_usd.units", F.col(deltas.BATCH).cast("bigint").alias("batch"))


def stream_order_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids with the number of orders so far, the key standing in for the offset."""
    store, checkpoint = _run_folder(spark)
    messages = fixtures.replay(spark, sf_dir, "orders", "o_orderkey", descending=False).selectExpr(
        "to_json(named_struct('order_id', CAST(o_orderkey AS STRING))) AS value", "o_orderkey AS offset"
    )
    orders.number(messages, store, checkpoint, available_now=True).awaitTermination()
    return deltas.read(spark, store, orders.NUMBERED).select("order_id", "running_count")


def _order_messages(spark: SparkSession, sf_dir: str, broken: str = "o_orderkey % 9 = 0") -> DataFrame:
    """Orders as JSON payloads; some are cut short."""
    payload = """to_json(named_struct('order_id', CAST(o_orderkey AS STRING), 'shipping_tracking_id', o_orderpriority,
        'shipping_cost', named_struct('currency_code', 'USD', 'units', CAST(floor(o_totalprice) AS BIGINT), 'nanos', 0)))"""
    return fixtures.stream(spark, sf_dir, "orders").selectExpr(
        f"if({broken}, left({payload}, 25), {payload}) AS value"
    )


def _accounted(spark: SparkSession, sf_dir: str, messages=_order_messages) -> str:
    store, checkpoint = _run_folder(spark)
    orders.account(messages(spark, sf_dir), store, checkpoint, available_now=True).awaitTermination()
    return store


def stream_order_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deltas.read(spark, _accounted(spark, sf_dir), orders.ACCOUNTED)
    return found.select("order_id", "shipping_tracking_id", F.col("shipping_cost.units").alias("units"))


def stream_order_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders accounted from binary payloads, a ninth of which are cut."""
    payloads = lambda spark, sf_dir: fixtures.order_payloads(fixtures.replay(spark, sf_dir, "orders", "o_orderkey"))
    found = deltas.read(spark, _accounted(spark, sf_dir, payloads), orders.ACCOUNTED)
    item = F.col("items")[0]["item"]
    return found.select(
        "order_id", "shipping_tracking_id", "shipping_cost.*", item["product_id"].alias("product_id"), item["quantity"].alias("quantity")
    )


def stream_order_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas.read(spark, _accounted(spark, sf_dir), orders.QUARANTINE).select("value")


def stream_order_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitor's count over all orders, as well-formed payloads."""
    _, checkpoint = _run_folder(spark)
    name = f"total_{uuid.uuid4().hex}"
    messages = _order_messages(spark, sf_dir, broken="false")
    query = (
        orders.running_total(messages)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.table(name)


QUERIES = {
    f.__name__: f
    for f in (
        stream_throughput,
        stream_p95_latency_daily,
        stream_operation_execution_time,
        served_p95_series,
        served_throughput_series,
        stream_counter_series,
        stream_cart_state,
        stream_order_enrich,
        stream_order_running_count,
        stream_order_accounting,
        stream_order_wire,
        stream_order_quarantine,
        stream_order_total,
    )
}

ORACLE = {
    "stream_throughput": batch.ORACLE["throughput"],
    "stream_p95_latency_daily": batch.ORACLE["p95_latency_daily"],
    "stream_operation_execution_time": batch.ORACLE["operation_execution_time"],
    "served_p95_series": batch.ORACLE["p95_series"],
    "served_throughput_series": batch.ORACLE["throughput_series"],
    "stream_counter_series": """WITH d AS (SELECT event_type, date_trunc('hour', ts) AS b, count(*) AS n FROM events GROUP BY ALL),
ends AS (SELECT event_type, min(b) AS low, (SELECT max(b) FROM d) AS high FROM d GROUP BY event_type),
grid AS (SELECT event_type, unnest(generate_series(low, high, INTERVAL 1 HOUR)) AS time FROM ends)
SELECT grid.event_type, grid.time, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY grid.event_type ORDER BY grid.time) AS BIGINT) AS total
FROM grid LEFT JOIN d ON d.event_type = grid.event_type AND d.b = grid.time""",
    "stream_cart_state": shop.ORACLE["cart_state"],
    "stream_order_enrich": f"""WITH {shop._ITEMS}, {shop._PRODUCTS}, ends AS (
  SELECT min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem),
dealt AS (SELECT items.*, (CAST(order_id AS BIGINT) - low) * 3 // (high - low + 1) AS batch FROM items, ends),
failed AS (SELECT DISTINCT order_id FROM dealt LEFT JOIN products ON id = product_id
           WHERE id IS NULL OR (batch = 0 AND NOT ({shop.IN_CATALOG})))
SELECT order_id, product_id, CAST(quantity AS INTEGER) AS quantity, name, units + batch AS units, batch
FROM dealt JOIN products ON id = product_id WHERE order_id NOT IN (SELECT order_id FROM failed)""",
    "stream_order_running_count": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       count(*) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS running_count FROM orders""",
    "stream_order_accounting": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS shipping_tracking_id,
       CAST(floor(o_totalprice) AS BIGINT) AS units FROM orders WHERE o_orderkey % 9 <> 0""",
    "stream_order_wire": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS shipping_tracking_id,
       'USD' AS currency_code, CAST(floor(o_totalprice) AS BIGINT) AS units,
       CAST(o_orderkey % 1000 * 1000000 AS INTEGER) AS nanos, CAST(o_custkey AS VARCHAR) AS product_id,
       CAST(1 + o_orderkey % 300 AS INTEGER) AS quantity FROM orders WHERE o_orderkey % 9 <> 0""",
    "stream_order_quarantine": """SELECT left('{"order_id":"' || o_orderkey || '","shipping_tracking_id":"', 25) AS value
FROM orders WHERE o_orderkey % 9 = 0""",
    "stream_order_total": "SELECT count(*) AS total FROM orders",
}

"""Consumers of the order stream, each with its own progress in a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewell.operators import numbering
from tracewell.plans import orders as order_plans
from tracewell.sinks import deltas
from tracewell.sources import catalog, orders

ACCOUNTED = "orders"
QUARANTINE = "orders_unparsable"
NUMBERED, LEDGER = "orders_numbered", "orders_ledger"
ENRICHED, FAILED = "items_enriched", "orders_failed"


def _trigger(available_now: bool, interval: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def account(
    messages: DataFrame, store: str, checkpoint: str, available_now: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Write every valid order; set unparsable payloads aside and go on."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = orders.parse(batch).persist()
        try:
            deltas.write(orders.valid(parsed), store, ACCOUNTED, batch_id)
            deltas.write(orders.unparsable(parsed), store, QUARANTINE, batch_id)
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, interval)).start()


def number(
    messages: DataFrame,
    store: str,
    checkpoint: str,
    position: str = "offset",
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Write every order id with the number of orders up to it, as the monitor counts them.

    A ledger holds the total after each micro-batch, so a batch needs the total before it and no state of the orders.
    Inside a batch orders are numbered by ``position``, a whole number such as the offset of a message. A replayed batch
    finds the same total and gives the same numbers. A bad payload fails the query.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = deltas.batch(spark, store, LEDGER, batch_id - 1)
        before = last.first().total if last is not None else 0
        read = orders.parse(batch).select(_parsed_id().alias("order_id"), F.col(position).cast("bigint").alias("position"))
        counted = numbering.running_count(read, "position")
        rows = counted.select("order_id", (F.col("running_count") + F.lit(before)).alias("running_count"))
        deltas.write(rows, store, NUMBERED, batch_id)
        added = deltas.batch(spark, store, NUMBERED, batch_id).count()
        deltas.write(spark.createDataFrame([(before + added,)], "total long"), store, LEDGER, batch_id)
        deltas.forget(spark, store, LEDGER, batch_id - 2)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, interval)).start()


def _parsed_id():
    failed = F.raise_error(F.lit("order parsing failed")).cast("string")
    return F.when(F.col("order").isNotNull(), F.col("order.order_id")).otherwise(failed)


def enrich(
    items: DataFrame,
    store: str,
    checkpoint: str,
    products: catalog.Versions,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Write the items of complete orders with their product, as the catalog is when their batch is first tried, and apart
    from them the orders that ask for a product it lacks. An order's items come in one batch, as its message does."""

    def write(batch: DataFrame, batch_id: int) -> None:
        known = products.at(batch.sparkSession, batch_id)
        held = batch.persist()
        try:
            deltas.write(order_plans.complete_orders(held, known), store, ENRICHED, batch_id)
            deltas.write(order_plans.failed_orders(held, known), store, FAILED, batch_id)
        finally:
            held.unpersist()

    writer = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, interval)).start()


def running_total(messages: DataFrame) -> DataFrame:
    """Number of orders so far, as a streaming frame for complete or update mode.

    Unlike accounting the monitor does not tolerate a bad payload: the query fails.
    """
    one = F.when(F.col("order").isNotNull(), F.lit(1)).otherwise(
        F.raise_error(F.lit("order parsing failed")).cast("int")
    )
    return orders.parse(messages).agg(F.coalesce(F.sum(one), F.lit(0)).alias("total"))

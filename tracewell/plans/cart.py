"""Cart state from a log of writes.

A write is ``(user_id, product_id, quantity, kind, event_time, seq)`` with kind ``add`` or ``empty``;
``seq`` orders writes of the same instant. Adding a product that is in the cart raises its quantity,
emptying removes all items, and a cart that is not written for the time to live is gone. Reads do not
renew it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators import skew
from tracewell.plans import currency, orders

TIME_TO_LIVE = timedelta(minutes=60)
ADD, EMPTY = "add", "empty"


def _moment(t: Column, seq: Column) -> Column:
    """Time and sequence number as one comparable number; unlike a struct its maximum is hash-aggregated."""
    return t.cast("decimal(19,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + seq.cast("decimal(19,0)")


def timed(writes: DataFrame) -> DataFrame:
    """The writes with their time in microseconds, ``t``."""
    return writes.withColumn("t", F.unix_micros(F.col("event_time").cast("timestamp")))


def bins(writes: DataFrame, ttl_us: int) -> DataFrame:
    """``(user_id, bin, first, last, emptied)``: first and last write of a user in a time-to-live bin, and the last time the
    cart was emptied in it. Bins of several sets of writes can be merged."""
    emptied = F.when(F.col("kind") == EMPTY, _moment(F.col("t"), F.col("seq")))
    return writes.groupBy("user_id", F.floor(F.col("t") / F.lit(ttl_us)).alias("bin")).agg(
        F.min("t").alias("first"), F.max("t").alias("last"), F.max(emptied).alias("emptied")
    )


def cutoffs(bins: DataFrame, ttl_us: int) -> DataFrame:
    """Per user: when the current cart began, the last time it was emptied, and the last write.

    Two writes in one time-to-live bin are never further apart than the time to live, so gaps show
    between the first and last write of neighbouring bins. The window therefore sees one row per user
    and bin, whatever the number of writes.
    """
    previous = F.lag("last").over(Window.partitionBy("user_id").orderBy("bin"))
    begun = F.when(previous.isNull() | (F.col("first") - previous > F.lit(ttl_us)), F.col("first"))
    return (
        bins.withColumn("begun", begun)
        .groupBy("user_id")
        .agg(F.max("begun").alias("begun"), F.max("emptied").alias("emptied"), F.max("last").alias("last_write"))
    )


def current(adds: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """What was added to the current carts: ``(user_id, product_id, quantity)``."""
    inside = skew.salted_join(adds, cutoffs, "user_id", spread="seq").where(
        (F.col("t") >= F.col("begun"))
        & (F.col("emptied").isNull() | (_moment(F.col("t"), F.col("seq")) > F.col("emptied")))
    )
    return inside.groupBy("user_id", "product_id").agg(F.sum(F.col("quantity").cast("bigint")).alias("quantity"))


def state(writes: DataFrame, ttl: timedelta = TIME_TO_LIVE, as_of: datetime | None = None) -> DataFrame:
    """Items of each cart after its user's last write: ``(user_id, product_id, quantity)``.

    With ``as_of`` later writes are ignored and carts that have expired by then are left out.
    """
    ttl_us = int(ttl.total_seconds() * 1_000_000)
    known = timed(writes)
    if as_of is not None:
        now = F.unix_micros(F.lit(str(as_of)).cast("timestamp"))
        known = known.where(F.col("t") <= now)
    ends = cutoffs(bins(known, ttl_us), ttl_us)
    if as_of is not None:
        ends = ends.where(now - F.col("last_write") <= F.lit(ttl_us))
    return current(known.where(F.col("kind") == ADD), ends)


def item_count(items: DataFrame, key: str = "user_id") -> DataFrame:
    """Pieces in each cart."""
    return items.groupBy(key).agg(F.sum(F.col("quantity").cast("bigint")).alias("item_count"))


def view(items: DataFrame, products: DataFrame, rates: DataFrame, currency_code: str = "currency_code") -> DataFrame:
    """Cart items with their product and its ``price`` in the page currency."""
    enriched = orders.enrich(items, products)
    return currency.localized(enriched, rates, "price_usd", F.col(currency_code), "price")

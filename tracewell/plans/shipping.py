"""Shipping quotes from item counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import money, text


def drawn_cost(*keys: Column, seed: str = "") -> Column:
    """Per-item cost between 40.0 and 100.0 in tenths, drawn by hash of the keys."""
    return (F.lit(400) + text.unit_hash(*keys, seed=seed) % F.lit(601)).cast("double") / F.lit(10.0)


def quote_total(item_count: Column, cost_per_item: Column | float) -> Column:
    cost = F.lit(float(cost_per_item)) if isinstance(cost_per_item, (int, float)) else cost_per_item
    return F.round(cost * item_count.cast("double"), 2)


def to_money(total: Column) -> Column:
    """Dollars are the floor; cents are the truncated hundredths modulo 100."""
    cents = (total * F.lit(100.0)).cast("bigint") % F.lit(100)
    return money.money("USD", F.floor(total), cents * F.lit(10_000_000))


def item_counts(items: DataFrame, key: str = "order_id") -> DataFrame:
    """Pieces per order or cart."""
    return items.groupBy(key).agg(F.sum(F.col("quantity").cast("bigint")).alias("item_count"))


def quotes(counts: DataFrame, cost_per_item: Column | float) -> DataFrame:
    """Add ``cost_usd`` to rows with an ``item_count``."""
    return counts.withColumn("cost_usd", to_money(quote_total(F.col("item_count"), cost_per_item)))

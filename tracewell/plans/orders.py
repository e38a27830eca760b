"""Order enrichment, totals and assembly.

Item tables are ``(order_id, product_id, quantity, ...)``; product tables have ``id`` and ``price_usd``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import money
from tracewell.plans import currency, shipping


def enrich(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items whose product is in the catalog, with the product's columns.

    A plain equi-join: Spark broadcasts a catalog below its size limit and otherwise shuffles, where
    adaptive execution splits the partitions of a best-selling product.
    """
    return items.join(products.withColumnRenamed("id", "product_id"), "product_id")


def missing_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items that reference no product."""
    return items.join(products.select(F.col("id").alias("product_id")), "product_id", "left_anti")


def failed_orders(items: DataFrame, products: DataFrame) -> DataFrame:
    """One missing product fails the whole order: ``(order_id, missing)``."""
    return missing_products(items, products).groupBy("order_id").agg(F.count(F.lit(1)).alias("missing"))


def complete_orders(items: DataFrame, products: DataFrame) -> DataFrame:
    """Enriched items of the orders without a missing product."""
    failed = failed_orders(items, products).select("order_id")
    return enrich(items, products).join(failed, "order_id", "left_anti")


def sum_money(df: DataFrame, by: str, amount: str = "amount") -> DataFrame:
    """Sum per group with the errors of pairwise addition: ``(by, currency_code, units, nanos, error)``.

    An invalid amount or a second currency spoils the group, which then has empty money and an error.
    Rows are first combined per group and currency: text as a key keeps that a hash aggregation, while
    text as an aggregate would make Spark sort all rows.
    """
    m = F.col(amount)
    units, nanos = money.sums(m)
    per_currency = df.groupBy(by, m["currency_code"].alias("code")).agg(
        units.alias("units"), nanos.alias("nanos"), F.count_if(~money.is_valid(m)).alias("invalid")
    )
    sums = per_currency.groupBy(by).agg(
        F.sum("units").alias("units"),
        F.sum("nanos").alias("nanos"),
        F.sum("invalid").alias("invalid"),
        F.count(F.lit(1)).alias("codes"),
        F.max("code").alias("code"),
    )
    error = F.when(F.col("invalid") > 0, F.lit(money.INVALID)).when(F.col("codes") > 1, F.lit(money.MISMATCH))
    empty = money.money("", F.lit(0), F.lit(0))
    value = F.when(error.isNull(), money.from_nanos(F.col("code"), money.total(F.col("units"), F.col("nanos")))).otherwise(empty)
    return sums.select(by, value.alias("value"), error.alias("error")).select(by, "value.*", "error")


def localize_items(items: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """Enriched items of complete orders with ``cost``, the unit price in the order's ``user_currency``.

    Checkout always converts, also from dollars to dollars.
    """
    return currency.with_converted(complete_orders(items, products), rates, F.col("price_usd"), F.col("user_currency"), "cost")


def totals(items: DataFrame, products: DataFrame, rates: DataFrame, cost_per_item: Column | float) -> DataFrame:
    """Localized shipping plus the sum of price times quantity, per order.

    All items of an order carry its currency. Item totals and item counts come from one aggregation.
    Orders with a missing product or an unknown currency are not totalled.
    """
    known = items.join(
        products.select(F.col("id").alias("product_id"), "price_usd"), "product_id", "left"
    )
    priced = currency.with_converted(known, rates, F.col("price_usd"), F.col("user_currency"), "cost")
    units, nanos = money.sums(F.col("cost"), F.col("quantity"))
    per_order = priced.groupBy("order_id", "user_currency").agg(
        F.count_if(F.col("cost").isNull()).alias("unpriced"),
        F.sum(F.col("quantity").cast("bigint")).alias("item_count"),
        units.alias("units"),
        nanos.alias("nanos"),
    )
    quoted = shipping.quotes(per_order.where(F.col("unpriced") == 0), cost_per_item)
    shipped = currency.with_converted(quoted, rates, F.col("cost_usd"), F.col("user_currency"), "shipping_cost")
    total = money.total(F.col("units"), F.col("nanos")) + money.to_nanos(F.col("shipping_cost"))
    return shipped.select(
        "order_id",
        "item_count",
        "shipping_cost",
        money.from_nanos(F.col("user_currency"), total).alias("total"),
    )


def merge_items(items: DataFrame) -> DataFrame:
    """One row per order, its currency and product; quantities of repeated products add up."""
    by = [c for c in ("order_id", "user_currency", "product_id") if c in items.columns]
    return items.groupBy(*by).agg(F.sum(F.col("quantity").cast("bigint")).alias("quantity"))


def lines(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Orders as flat rows: every costed item with its order's header, however many items an order has."""
    return items.select("order_id", "product_id", "quantity", "cost").join(headers, "order_id")


def assemble(items: DataFrame, headers: DataFrame, parts: int = 1) -> DataFrame:
    """Nested order records from costed items ``(order_id, product_id, quantity, cost)`` and headers
    ``(order_id, shipping_tracking_id, shipping_cost, shipping_address)``.

    Every order is ``parts`` records or fewer, its items dealt by product, whatever its size; the record holds
    its items in memory. Where orders have no bound, :func:`lines` gives the same as flat rows.
    """
    part = F.pmod(F.xxhash64("product_id"), F.lit(parts)).cast("int")
    entry = F.struct(
        F.struct("product_id", F.col("quantity").cast("int").alias("quantity")).alias("item"), "cost"
    )
    grouped = items.groupBy("order_id", part.alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("items"))
    return headers.join(grouped, "order_id")

"""Catalog search and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tracewell.functions import text
from tracewell.operators import numbering

RECOMMENDED = 5
SHOWN = 4
STRETCH = 256
COPIES = 16


def search(products: DataFrame, queries: Sequence[str]) -> DataFrame:
    """Products whose name or description contains a query, ignoring case: ``(query, *products)``.

    All queries are tested in one scan of the catalog; a product appears once per query it matches.
    """
    hits = [
        F.when(
            text.contains_ignoring_case(F.col("name"), q) | text.contains_ignoring_case(F.col("description"), q),
            F.lit(q),
        )
        for q in queries
    ]
    return products.select(F.explode(F.array_compact(F.array(*hits))).alias("query"), "*")


def search_counts(products: DataFrame, queries: Sequence[str]) -> DataFrame:
    return search(products, queries).groupBy("query").agg(F.count(F.lit(1)).alias("results"))


def split_ids(product_ids: Column) -> Column:
    """Requested ids; an entry may itself be a comma-separated list. A null list is empty, null entries don't count."""
    given = F.array_compact(F.coalesce(product_ids, F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(F.transform(given, lambda i: F.split(i, ","))))


def unviewed(products: DataFrame, viewed: DataFrame) -> DataFrame:
    """The catalog without the products of one view list."""
    seen = viewed.select(F.col("product_id").alias("id")).distinct()
    return products.join(seen, "id", "left_anti")


def candidate_counts(requests: DataFrame, products: DataFrame) -> DataFrame:
    """How many products each request may be recommended: ``(request_id, candidates)``.

    The candidates are the whole catalog but a few, so they are counted, never listed: catalog size
    minus the requested products that exist.
    """
    catalog = products.select(F.col("id").alias("product_id"))
    asked = requests.select("request_id", F.explode(split_ids(F.col("product_ids"))).alias("product_id"))
    # a semi-join on the bare catalog leaves both shuffles splittable when one product is asked for a lot
    existing = asked.join(catalog, "product_id", "left_semi")
    known = existing.groupBy("request_id").agg(F.count(F.lit(1)).alias("known"))
    size = catalog.distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        requests.select("request_id")
        .join(known, "request_id", "left")
        .select("request_id", (size - F.coalesce("known", F.lit(0).cast("bigint"))).alias("candidates"))
    )


def _stretches(catalog: DataFrame) -> DataFrame:
    """The laid-out catalog cut into stretches of ids, each repeated ``COPIES`` times: ``(stretch, copy, ids)``.

    The copies spread the requests of a stretch over tasks, also when the catalog is one stretch only.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "product_id")))
    own = F.call_function("div", F.col("position"), F.lit(STRETCH).cast("bigint"))
    cut = catalog.groupBy(own.alias("stretch")).agg(F.transform(ordered, lambda e: e["product_id"]).alias("ids"))
    return cut.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))


def recommend(requests: DataFrame, products: DataFrame, k: int = RECOMMENDED, seed: str = "") -> DataFrame:
    """Up to ``k`` products per request that were not asked for: ``(request_id, rank, product_id)``.

    The catalog is laid out in a fixed random order. A request starts at a hashed place and takes the
    next products, around the end and on from the start, skipping its own; ``k`` plus its own number of places
    always suffices. Its walk is cut at the borders of stretches, joined to each stretch it touches (one or
    two, unless it asks for hundreds of products), and put together again in order.
    """
    ids = products.select(F.col("id").alias("product_id")).distinct()
    catalog = numbering.shuffled_positions(ids, "product_id")
    size = ids.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = requests.select(
        "request_id",
        split_ids(F.col("product_ids")).alias("asked"),
        F.try_mod(text.unit_hash(F.col("request_id"), seed=seed), size).alias("start"),
        size.alias("size"),
    ).where(F.col("start").isNotNull())
    zero, width = F.lit(0).cast("bigint"), F.lit(STRETCH).cast("bigint")
    end = F.col("start") + F.least(F.col("size"), (F.size("asked") + F.lit(k)).cast("bigint"))
    leg = lambda a, b, step: F.struct(a.alias("from"), b.alias("to"), step.alias("step"))
    ahead = leg(F.col("start"), F.least(end, F.col("size")), zero)
    around = leg(zero, end - F.col("size"), F.col("size") - F.col("start"))
    legs = placed.select("request_id", "asked", F.inline(F.array(ahead, around))).where("from < to")
    first, last = (F.call_function("div", p, width) for p in (F.col("from"), F.col("to") - F.lit(1).cast("bigint")))
    parts = legs.withColumn("stretch", F.explode(F.sequence(first, last))).withColumn(
        "copy", F.pmod(F.xxhash64("request_id"), F.lit(COPIES)).cast("int")
    )
    begin = F.greatest(F.col("from"), F.col("stretch") * width)
    stop = F.least(F.col("to"), (F.col("stretch") + 1) * width)
    passed = F.slice("ids", (begin - F.col("stretch") * width + 1).cast("int"), (stop - begin).cast("int"))
    free = F.slice(F.filter(passed, lambda p: ~F.array_contains("asked", p)), 1, k)
    met = parts.join(_stretches(catalog), ["stretch", "copy"]).select(
        "request_id", (F.col("step") + begin - F.col("from")).alias("step"), F.posexplode(free).alias("place", "product_id")
    )
    rank = F.row_number().over(Window.partitionBy("request_id").orderBy("step", "place"))
    return met.select("request_id", rank.alias("rank"), "product_id").where(F.col("rank") <= k)


def shown(recommended: DataFrame, products: DataFrame, limit: int = SHOWN) -> DataFrame:
    """The recommendations a page shows, the first ones, with their product."""
    first = recommended.where(F.col("rank") <= limit)
    return first.join(products.withColumnRenamed("id", "product_id"), "product_id")

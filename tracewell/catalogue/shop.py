"""Order, cart, catalog and payment queries over the test tables, with their SQL."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tracewell import fixtures
from tracewell.functions import money
from tracewell.operators import counters, numbering
from tracewell.plans import ads, cart, catalog, currency, orders, payment, shipping
from tracewell.sources import ads as ad_source
from tracewell.sources import catalog as catalog_source
from tracewell.sources import rates as rate_source

CART_LIFE = timedelta(days=2)
CHARGE_DATE = date(2024, 1, 15)
SEARCHES = ("ring", "BOLT", "Brand#1", "large", "100%", "_")
IN_CATALOG = "p_brand <> 'Brand#7'"


def catalog_flatten(spark, sf_dir):
    return catalog_source.parse(fixtures.product_documents(spark, sf_dir)).select(
        "id",
        "name",
        "description",
        "picture",
        "price_usd.*",
        F.array_join("categories", ",").alias("categories"),
    )


def money_classify(spark, sf_dir):
    amounts = fixtures.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        money.money(
            "USD",
            F.expr("l_suppkey % 7 - 3"),
            F.expr("CAST((l_partkey % 5 - 2) * 500000000 AS INT)"),
        ).alias("m"),
    )
    m = F.col("m")
    return amounts.select(
        "l_orderkey",
        "m.units",
        "m.nanos",
        money.is_valid(m).alias("valid"),
        money.is_zero(m).alias("zero"),
        money.is_positive(m).alias("positive"),
        money.is_negative(m).alias("negative"),
        money.negate(m)["units"].alias("negated_units"),
        money.display(m).alias("shown"),
    )


def money_sum(spark, sf_dir):
    cents = F.expr("CAST(round(l_extendedprice * 100) AS BIGINT)")
    code = F.expr("if(l_orderkey % 11 = 0 AND l_linenumber = 7, 'EUR', 'USD')")
    plain = money.from_cents(code, cents)
    broken = F.expr("l_orderkey % 13 = 0 AND l_linenumber = 1")
    amounts = fixtures.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(broken, money.money(code, F.lit(1), F.lit(-1))).otherwise(plain).alias("amount"),
    )
    return orders.sum_money(amounts, "order_id")


def _conversions(spark, sf_dir):
    codes = ", ".join(f"'{c}'" for c in [*rate_source.RATES, "XXX"])
    return fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        money.from_cents(
            F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'JPY' ELSE 'USD' END"),
            F.expr("CAST(round(o_totalprice * 100) AS BIGINT)"),
        ).alias("amount"),
        F.expr(f"element_at(array({codes}), CAST(1 + o_orderkey % 34 AS INT))").alias("to_code"),
    )


def currency_convert(spark, sf_dir):
    done = currency.convert(_conversions(spark, sf_dir), rate_source.rates(spark))
    return done.select("order_id", F.col("amount.currency_code").alias("from_code"), "converted.*")


def currency_rejects(spark, sf_dir):
    return currency.rejects(_conversions(spark, sf_dir), rate_source.rates(spark)).select("order_id", "to_code")


def conversion_counter(spark, sf_dir):
    done = currency.convert(_conversions(spark, sf_dir), rate_source.rates(spark))
    labelled = done.select(F.col("to_code").alias("currency_code"))
    return counters.counter(labelled, ["currency_code"], name="conversions")


def order_enrich(spark, sf_dir):
    found = orders.enrich(fixtures.items(spark, sf_dir), fixtures.products(spark, sf_dir))
    return found.select("order_id", "product_id", "quantity", "name", "price_usd.*")


def order_rejects(spark, sf_dir):
    return orders.failed_orders(fixtures.items(spark, sf_dir), fixtures.products(spark, sf_dir, IN_CATALOG))


def order_complete(spark, sf_dir):
    done = orders.complete_orders(fixtures.items(spark, sf_dir), fixtures.products(spark, sf_dir, IN_CATALOG))
    return done.select("order_id", "product_id", "quantity")


def order_total(spark, sf_dir):
    return orders.totals(
        fixtures.items(spark, sf_dir),
        fixtures.products(spark, sf_dir),
        rate_source.rates(spark),
        shipping.drawn_cost(F.col("order_id")),
    ).select("order_id", "item_count", F.col("shipping_cost.units").alias("shipping_units"), "total.*")


def _costed(spark, sf_dir):
    merged = orders.merge_items(fixtures.items(spark, sf_dir))
    return orders.localize_items(merged, fixtures.products(spark, sf_dir, IN_CATALOG), rate_source.rates(spark))


def _headers(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "md5(CAST(o_orderkey AS STRING)) AS shipping_tracking_id",
        "named_struct('currency_code', 'USD', 'units', o_orderkey % 90, 'nanos', 0) AS shipping_cost",
        """named_struct('street_address', o_orderpriority, 'city', 'c', 'state', 's', 'country', 'x',
                        'zip_code', CAST(o_custkey AS STRING)) AS shipping_address""",
    )


def order_assemble(spark, sf_dir):
    entry = lambda i: F.concat_ws(
        ":", i["item"]["product_id"], i["item"]["quantity"].cast("string"), i["cost"]["units"].cast("string")
    )
    return orders.assemble(_costed(spark, sf_dir), _headers(spark, sf_dir)).select(
        "order_id",
        "part",
        "shipping_tracking_id",
        F.col("shipping_cost.units").alias("shipping_units"),
        F.col("shipping_address.zip_code").alias("zip_code"),
        F.size("items").alias("n_items"),
        F.array_join(F.transform("items", entry), ";").alias("items"),
    )


def order_lines(spark, sf_dir):
    return orders.lines(_costed(spark, sf_dir), _headers(spark, sf_dir)).select(
        "order_id",
        "product_id",
        "quantity",
        F.col("cost.currency_code").alias("currency_code"),
        F.col("cost.units").alias("units"),
        F.col("cost.nanos").alias("nanos"),
        "shipping_tracking_id",
        F.col("shipping_address.zip_code").alias("zip_code"),
    )


def order_running_count(spark, sf_dir):
    placed = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return numbering.running_count(placed, "o_orderkey")


def cart_item_count(spark, sf_dir):
    return shipping.item_counts(fixtures.items(spark, sf_dir))


def shipping_quote(spark, sf_dir):
    counts = shipping.item_counts(fixtures.items(spark, sf_dir))
    quoted = shipping.quotes(counts, shipping.drawn_cost(F.col("order_id")))
    return quoted.select("order_id", "item_count", "cost_usd.*")


def quote_counter(spark, sf_dir):
    counts = shipping.item_counts(fixtures.items(spark, sf_dir))
    return counters.counter(counts.withColumnRenamed("item_count", "number_of_items"), ["number_of_items"], name="quotes")


def _cart(spark, sf_dir):
    return cart.state(fixtures.cart_writes(spark, sf_dir), CART_LIFE)


def cart_state(spark, sf_dir):
    return _cart(spark, sf_dir)


def cart_view(spark, sf_dir):
    page = _cart(spark, sf_dir).withColumn(
        "currency_code",
        F.expr("CASE CAST(user_id AS BIGINT) % 4 WHEN 0 THEN '' WHEN 1 THEN 'USD' WHEN 2 THEN 'CAD' ELSE 'GBP' END"),
    )
    shown = cart.view(page, fixtures.products(spark, sf_dir), rate_source.rates(spark))
    return shown.select(
        "user_id",
        "product_id",
        "quantity",
        "name",
        F.col("price.currency_code").alias("currency"),
        "price.units",
        "price.nanos",
        money.display(F.col("price")).alias("shown"),
    )


def catalog_search(spark, sf_dir):
    return catalog.search(fixtures.products(spark, sf_dir), SEARCHES).select("query", "id", "name")


def catalog_unviewed(spark, sf_dir):
    viewed = fixtures.table(spark, sf_dir, "events").selectExpr("CAST(event_id % 150 AS STRING) AS product_id")
    return catalog.unviewed(fixtures.products(spark, sf_dir), viewed).select("id", "name")


def recommend_candidates(spark, sf_dir):
    return catalog.candidate_counts(
        fixtures.recommendation_requests(spark, sf_dir), fixtures.products(spark, sf_dir)
    )


def recommend_topk(spark, sf_dir):
    return catalog.recommend(fixtures.recommendation_requests(spark, sf_dir), fixtures.products(spark, sf_dir))


def recommend_shown(spark, sf_dir):
    shown = catalog.shown(recommend_topk(spark, sf_dir), fixtures.products(spark, sf_dir))
    return shown.select("request_id", "rank", "product_id", "name", "price_usd.units")


def recommendation_counter(spark, sf_dir):
    """Recommended products summed by type; a request gets what there is, up to the limit."""
    given = recommend_candidates(spark, sf_dir).select(
        F.lit("catalog").alias("recommendation_type"),
        F.least("candidates", F.lit(catalog.RECOMMENDED).cast("bigint")).alias("n"),
    )
    return counters.counter(given, ["recommendation_type"], F.col("n"), name="recommendations")


def ads_targeted(spark, sf_dir):
    return ads.select(fixtures.ad_requests(spark, sf_dir), ad_source.ads(spark))


def ad_counter(spark, sf_dir):
    return ads.requests_by_type(fixtures.ad_requests(spark, sf_dir), ad_source.ads(spark))


def payment_decision(spark, sf_dir):
    decided = payment.decide(fixtures.charge_requests(spark, sf_dir), CHARGE_DATE)
    return decided.select("order_id", "card_type", "decision", "message", "charged")


def payment_counter(spark, sf_dir):
    return payment.transactions_by_currency(payment.decide(fixtures.charge_requests(spark, sf_dir), CHARGE_DATE))


QUERIES = {
    f.__name__: f
    for f in (
        catalog_flatten,
        money_classify,
        money_sum,
        currency_convert,
        currency_rejects,
        conversion_counter,
        order_enrich,
        order_rejects,
        order_complete,
        order_total,
        order_assemble,
        order_lines,
        order_running_count,
        cart_item_count,
        shipping_quote,
        quote_counter,
        cart_state,
        cart_view,
        catalog_search,
        catalog_unviewed,
        recommend_candidates,
        recommend_topk,
        recommend_shown,
        recommendation_counter,
        ads_targeted,
        ad_counter,
        payment_decision,
        payment_counter,
    )
}

# ---------------------------------------------------------------------------------------------
# SQL

_RATES = "rates(code, rate) AS (VALUES " + ", ".join(
    f"('{c}', CAST({r!r} AS DOUBLE))" for c, r in rate_source.RATES.items()
) + ")"
_CODES = "[" + ", ".join(f"'{c}'" for c in [*rate_source.RATES, "XXX"]) + "]"
_ADS = "ads(category, redirect_url, text) AS (VALUES " + ", ".join(repr(a) for a in ad_source.ADS) + ")"


def _hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _units(value: str) -> str:
    return f"CAST(trunc({value}) AS BIGINT)"


def _nanos(value: str) -> str:
    return f"CAST(trunc(({value} - trunc({value})) * CAST(1e9 AS DOUBLE)) AS INTEGER)"


_ITEMS = """items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         CASE l_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'JPY' WHEN 3 THEN 'GBP' ELSE 'EUR' END
           AS user_currency
  FROM lineitem)"""
_PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand || ' ' || p_type AS description, p_brand,
         CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS units,
         CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 * 10000000 AS INTEGER) AS nanos,
         CAST(CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS DOUBLE)
           + CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 * 10000000 AS DOUBLE) / CAST(1e9 AS DOUBLE) AS price
  FROM part)"""
_COSTED = f"""failed AS (
  SELECT order_id FROM items WHERE product_id NOT IN (SELECT id FROM products WHERE {IN_CATALOG})),
merged AS (SELECT order_id, product_id, user_currency, CAST(sum(quantity) AS BIGINT) AS quantity
           FROM items WHERE order_id NOT IN (SELECT order_id FROM failed) GROUP BY 1, 2, 3),
costed AS (SELECT merged.*, price / (SELECT rate FROM rates WHERE code = 'USD') * rate AS v
           FROM merged JOIN products ON id = product_id JOIN rates ON code = user_currency)"""
_COUNTS = "counts AS (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS item_count FROM items GROUP BY order_id)"
_QUOTES = f"""quotes AS (
  SELECT order_id, item_count,
         round((400 + {_hash("order_id || '|'")} % 601) / CAST(10 AS DOUBLE) * CAST(item_count AS DOUBLE), 2) AS v
  FROM counts),
quoted AS (
  SELECT order_id, item_count, CAST(floor(v) AS BIGINT) AS units,
         CAST(CAST(trunc(v * CAST(100 AS DOUBLE)) AS BIGINT) % 100 * 10000000 AS INTEGER) AS nanos
  FROM quotes)"""
_CONVERSIONS = f"""moves AS (
  SELECT o_orderkey AS order_id, CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'JPY' ELSE 'USD' END AS from_code,
         {_CODES}[1 + o_orderkey % 34] AS to_code, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
converted AS (
  SELECT m.*, (CAST(cents // 100 AS DOUBLE) + CAST(cents % 100 * 10000000 AS DOUBLE) / CAST(1e9 AS DOUBLE))
              / f.rate * t.rate AS v
  FROM moves m LEFT JOIN rates f ON f.code = from_code LEFT JOIN rates t ON t.code = to_code)"""
_WRITES = """writes AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id % 7 AS VARCHAR) AS product_id,
         1 + event_id % 3 AS quantity, event_type = 'purchase' AS empties, epoch_us(ts) AS t, event_id AS seq
  FROM events),
marked AS (
  SELECT *, CASE WHEN empties OR t - lag(t) OVER w > 172800000000 THEN 1 ELSE 0 END AS breaks
  FROM writes WINDOW w AS (PARTITION BY user_id ORDER BY t, seq)),
runs AS (
  SELECT *, sum(breaks) OVER (PARTITION BY user_id ORDER BY t, seq) AS run,
         sum(breaks) OVER (PARTITION BY user_id) AS last_run FROM marked),
carts AS (
  SELECT user_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM runs
  WHERE run = last_run AND NOT empties GROUP BY 1, 2)"""
_RECOMMENDED = f"""cat AS (SELECT id, row_number() OVER (ORDER BY md5(id), id) - 1 AS position
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS id FROM part)),
size AS (SELECT count(*) AS n FROM cat),
req AS (SELECT event_id, {_hash("CAST(event_id AS VARCHAR) || '|'")} % n AS start, n,
               [CAST(user_id AS VARCHAR), CAST(event_id % 100 AS VARCHAR), CAST(event_id % 37 AS VARCHAR)] AS asked
        FROM events CROSS JOIN size),
walk AS (SELECT req.*, s.step, (start + s.step) % n AS position FROM req, range(0, 8) s(step)),
free AS (SELECT event_id, step, id FROM walk JOIN cat USING (position) WHERE NOT list_contains(asked, id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY step) AS rank FROM free)"""
_CHARGES = r"""charges AS (
  SELECT *, replace(replace(number, '-', ''), ' ', '') AS digits FROM (
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 4 = 0 THEN 'CAD' ELSE 'USD' END AS currency,
      CASE o_orderkey % 6 WHEN 0 THEN '4432-8015-6152-0454' WHEN 1 THEN '3714 496353 98431'
        WHEN 2 THEN '0000-0000-0000-0000' WHEN 3 THEN '4432-8015-6152-0455'
        WHEN 4 THEN '5555-5555-5555-4444' ELSE '6011-1111-1111-1117' END AS number,
      CASE WHEN (o_orderkey // 6) % 3 = 0 THEN 2021 ELSE 2039 END AS y, 1 + o_orderkey % 12 AS m,
      o_orderkey % 11 = 0 AS synthetic FROM orders)),
checked AS (
  SELECT *, CASE WHEN digits[1] = '4' AND length(digits) IN (13, 16, 19) THEN 'visa'
              WHEN substr(digits, 1, 2) BETWEEN '51' AND '55' AND length(digits) = 16 THEN 'mastercard'
              WHEN substr(digits, 1, 2) IN ('34', '37') AND length(digits) = 15 THEN 'amex'
              WHEN substr(digits, 1, 4) = '6011' AND length(digits) = 16 THEN 'discover' END AS card_type,
         list_sum(list_transform(range(1, length(digits) + 1), lambda i:
           CASE WHEN i % 2 = 1 THEN CAST(digits[length(digits) - i + 1] AS INTEGER)
                WHEN CAST(digits[length(digits) - i + 1] AS INTEGER) > 4
                  THEN 2 * CAST(digits[length(digits) - i + 1] AS INTEGER) - 9
                ELSE 2 * CAST(digits[length(digits) - i + 1] AS INTEGER) END)) % 10 = 0 AS luhn
  FROM charges),
decided AS (
  SELECT *, CASE WHEN card_type IS NULL OR NOT luhn THEN 'invalid' WHEN card_type IN ('amex', 'discover') THEN 'brand_not_accepted'
              WHEN 2024 * 12 + 1 > y * 12 + m THEN 'expired' ELSE 'accepted' END AS decision FROM checked)"""

ORACLE = {
    "catalog_flatten": f"""WITH {_PRODUCTS} SELECT id, name, description, name || '.jpg' AS picture,
       'USD' AS currency_code, units, nanos, lower(split_part(description, ' ', 2)) || ',parts' AS categories
FROM products""",
    "money_classify": """WITH m AS (SELECT l_orderkey, l_suppkey % 7 - 3 AS units,
       CAST((l_partkey % 5 - 2) * 500000000 AS INTEGER) AS nanos FROM lineitem),
c AS (SELECT *, (nanos = 0 OR units = 0 OR (nanos < 0) = (units < 0)) AND nanos BETWEEN -999999999 AND 999999999
              AS valid FROM m)
SELECT l_orderkey, units, nanos, valid, units = 0 AND nanos = 0 AS zero,
       (valid AND units > 0) OR (units = 0 AND nanos > 0) AS positive,
       (valid AND units < 0) OR (units = 0 AND nanos < 0) AS negative, -units AS negated_units,
       round(CAST(units AS DOUBLE) + CAST(nanos AS DOUBLE) / CAST(1e9 AS DOUBLE), 2) AS shown FROM c""",
    "money_sum": """WITH a AS (SELECT l_orderkey AS order_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
       CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 7 THEN 'EUR' ELSE 'USD' END AS code,
       l_orderkey % 13 = 0 AND l_linenumber = 1 AS broken FROM lineitem),
g AS (SELECT order_id, CAST(sum(cents) AS BIGINT) AS cents, min(code) AS code,
             CASE WHEN bool_or(broken) THEN 'invalid_value'
                  WHEN min(code) <> max(code) THEN 'mismatching_currency' END AS error
      FROM a GROUP BY order_id)
SELECT order_id, CASE WHEN error IS NULL THEN code ELSE '' END AS currency_code,
       CASE WHEN error IS NULL THEN cents // 100 ELSE 0 END AS units,
       CAST(CASE WHEN error IS NULL THEN cents % 100 * 10000000 ELSE 0 END AS INTEGER) AS nanos, error FROM g""",
    "currency_convert": f"""WITH {_RATES}, {_CONVERSIONS}
SELECT order_id, from_code, to_code AS currency_code, {_units('v')} AS units, {_nanos('v')} AS nanos
FROM converted WHERE v IS NOT NULL""",
    "currency_rejects": f"""WITH {_RATES}, {_CONVERSIONS} SELECT order_id, to_code FROM converted WHERE v IS NULL""",
    "conversion_counter": f"""WITH {_RATES}, {_CONVERSIONS}
SELECT to_code AS currency_code, count(*) AS conversions FROM converted WHERE v IS NOT NULL GROUP BY 1""",
    "order_enrich": f"""WITH {_ITEMS}, {_PRODUCTS}
SELECT order_id, product_id, CAST(quantity AS INTEGER) AS quantity, name, 'USD' AS currency_code, units, nanos
FROM items JOIN products ON id = product_id""",
    "order_rejects": f"""WITH {_ITEMS}, {_PRODUCTS}
SELECT order_id, count(*) AS missing FROM items
WHERE product_id NOT IN (SELECT id FROM products WHERE {IN_CATALOG}) GROUP BY order_id""",
    "order_complete": f"""WITH {_ITEMS}, {_PRODUCTS}, failed AS (
  SELECT order_id FROM items WHERE product_id NOT IN (SELECT id FROM products WHERE {IN_CATALOG}))
SELECT order_id, product_id, CAST(quantity AS INTEGER) AS quantity FROM items
WHERE order_id NOT IN (SELECT order_id FROM failed)""",
    "order_total": f"""WITH {_RATES}, {_ITEMS}, {_PRODUCTS}, {_COUNTS}, {_QUOTES},
usd AS (SELECT rate AS usd FROM rates WHERE code = 'USD'),
costs AS (SELECT order_id, quantity, user_currency, price / usd * rate AS v
          FROM items JOIN products ON id = product_id JOIN rates ON code = user_currency CROSS JOIN usd),
sums AS (SELECT order_id, any_value(user_currency) AS user_currency,
                sum((CAST({_units('v')} AS HUGEINT) * 1000000000 + {_nanos('v')}) * greatest(quantity, 1)) AS total
         FROM costs GROUP BY order_id),
shipped AS (SELECT order_id, item_count, user_currency, total,
                   (CAST(units AS DOUBLE) + CAST(nanos AS DOUBLE) / CAST(1e9 AS DOUBLE)) / usd * rate AS v
            FROM quoted JOIN sums USING (order_id) JOIN rates ON code = user_currency CROSS JOIN usd),
added AS (SELECT *, total + CAST({_units('v')} AS HUGEINT) * 1000000000 + {_nanos('v')} AS grand FROM shipped)
SELECT order_id, item_count, {_units('v')} AS shipping_units, user_currency AS currency_code,
       CAST(grand // 1000000000 AS BIGINT) AS units, CAST(grand % 1000000000 AS INTEGER) AS nanos FROM added""",
    "order_assemble": f"""WITH {_RATES}, {_ITEMS}, {_PRODUCTS}, {_COSTED},
packed AS (SELECT order_id, CAST(count(*) AS INTEGER) AS n_items,
                  string_agg(product_id || ':' || quantity || ':' || {_units('v')}, ';' ORDER BY product_id) AS items
           FROM costed GROUP BY order_id)
SELECT order_id, CAST(0 AS INTEGER) AS part, md5(order_id) AS shipping_tracking_id, o_orderkey % 90 AS shipping_units,
       CAST(o_custkey AS VARCHAR) AS zip_code, n_items, items
FROM orders JOIN packed ON order_id = CAST(o_orderkey AS VARCHAR)""",
    "order_lines": f"""WITH {_RATES}, {_ITEMS}, {_PRODUCTS}, {_COSTED}
SELECT order_id, product_id, quantity, user_currency AS currency_code, {_units('v')} AS units, {_nanos('v')} AS nanos,
       md5(order_id) AS shipping_tracking_id, CAST(o_custkey AS VARCHAR) AS zip_code
FROM orders JOIN costed ON order_id = CAST(o_orderkey AS VARCHAR)""",
    "order_running_count": """SELECT o_orderkey, o_custkey, count(*) OVER (ORDER BY o_orderkey
       ROWS UNBOUNDED PRECEDING) AS running_count FROM orders""",
    "cart_item_count": f"WITH {_ITEMS}, {_COUNTS} SELECT order_id, item_count FROM counts",
    "shipping_quote": f"""WITH {_ITEMS}, {_COUNTS}, {_QUOTES}
SELECT order_id, item_count, 'USD' AS currency_code, units, nanos FROM quoted""",
    "quote_counter": f"""WITH {_ITEMS}, {_COUNTS}
SELECT item_count AS number_of_items, count(*) AS quotes FROM counts GROUP BY 1""",
    "cart_state": f"WITH {_WRITES} SELECT user_id, product_id, quantity FROM carts",
    "cart_view": f"""WITH {_RATES}, {_PRODUCTS}, {_WRITES},
usd AS (SELECT rate AS usd FROM rates WHERE code = 'USD'),
page AS (SELECT *, CASE CAST(user_id AS BIGINT) % 4 WHEN 0 THEN '' WHEN 1 THEN 'USD' WHEN 2 THEN 'CAD' ELSE 'GBP' END
              AS code FROM carts),
priced AS (SELECT user_id, product_id, quantity, name, page.code, units, nanos, price / usd * rate AS v
           FROM page JOIN products ON id = product_id LEFT JOIN rates ON rates.code = page.code CROSS JOIN usd),
shown AS (SELECT user_id, product_id, quantity, name,
       CASE WHEN code IN ('', 'USD') THEN 'USD' ELSE code END AS currency,
       CASE WHEN code IN ('', 'USD') THEN units ELSE {_units('v')} END AS units,
       CASE WHEN code IN ('', 'USD') THEN nanos ELSE {_nanos('v')} END AS nanos FROM priced)
SELECT *, round(CAST(units AS DOUBLE) + CAST(nanos AS DOUBLE) / CAST(1e9 AS DOUBLE), 2) AS shown FROM shown""",
    "catalog_search": f"""WITH {_PRODUCTS}, q(query) AS (VALUES {', '.join(f"('{s}')" for s in SEARCHES)})
SELECT query, id, name FROM products JOIN q ON contains(lower(name), lower(query))
                                          OR contains(lower(description), lower(query))""",
    "catalog_unviewed": f"""WITH {_PRODUCTS} SELECT id, name FROM products WHERE id NOT IN (
  SELECT CAST(event_id % 150 AS VARCHAR) FROM events)""",
    "recommend_candidates": """WITH size AS (SELECT count(*) AS n FROM part),
asked AS (SELECT DISTINCT event_id, unnest([user_id, event_id % 100, event_id % 37]) AS id FROM events),
known AS (SELECT event_id, count(*) AS k FROM asked JOIN part ON p_partkey = id GROUP BY event_id)
SELECT e.event_id AS request_id, n - coalesce(k, 0) AS candidates
FROM events e CROSS JOIN size LEFT JOIN known k ON k.event_id = e.event_id""",
    "recommend_topk": f"""WITH {_RECOMMENDED}
SELECT event_id AS request_id, CAST(rank AS INTEGER) AS rank, id AS product_id FROM ranked WHERE rank <= 5""",
    "recommend_shown": f"""WITH {_PRODUCTS}, {_RECOMMENDED}
SELECT event_id AS request_id, CAST(rank AS INTEGER) AS rank, ranked.id AS product_id, name, units
FROM ranked JOIN products ON products.id = ranked.id WHERE rank <= 4""",
    "recommendation_counter": """WITH size AS (SELECT count(*) AS n FROM part),
asked AS (SELECT DISTINCT event_id, unnest([user_id, event_id % 100, event_id % 37]) AS id FROM events),
known AS (SELECT event_id, count(*) AS k FROM asked JOIN part ON p_partkey = id GROUP BY event_id)
SELECT 'catalog' AS recommendation_type, CAST(sum(least(n - coalesce(k, 0), 5)) AS BIGINT) AS recommendations
FROM events e CROSS JOIN size LEFT JOIN known k ON k.event_id = e.event_id""",
    "ads_targeted": f"""WITH {_ADS},
numbered AS (SELECT *, row_number() OVER (ORDER BY md5(redirect_url)) - 1 AS position FROM ads),
req AS (SELECT event_id AS request_id, CASE event_id % 5 WHEN 0 THEN ['binoculars'] WHEN 1 THEN ['accessories', 'travel']
          WHEN 2 THEN ['books'] WHEN 3 THEN [] ELSE ['telescopes', 'telescopes'] END AS keys FROM events),
hit AS (SELECT request_id, unnest(keys) AS category FROM req),
targeted AS (SELECT request_id, 'TARGETED' AS request_type, 'TARGETED' AS response_type, redirect_url, text
             FROM hit JOIN ads USING (category)),
drawn AS (SELECT request_id, CASE WHEN len(keys) > 0 THEN 'TARGETED' ELSE 'NOT_TARGETED' END AS request_type,
                 'RANDOM' AS response_type, redirect_url, text
          FROM req CROSS JOIN (VALUES (1), (2)) d(draw) JOIN numbered
            ON position = {_hash("CAST(request_id AS VARCHAR) || '|' || CAST(draw AS VARCHAR) || '|'")} % 7
          WHERE request_id NOT IN (SELECT request_id FROM targeted))
SELECT * FROM targeted UNION ALL SELECT * FROM drawn""",
    "ad_counter": """SELECT CASE WHEN event_id % 5 = 3 THEN 'NOT_TARGETED' ELSE 'TARGETED' END AS request_type,
       CASE WHEN event_id % 5 IN (2, 3) THEN 'RANDOM' ELSE 'TARGETED' END AS response_type, count(*) AS requests
FROM events GROUP BY 1, 2""",
    "payment_decision": f"""WITH {_CHARGES} SELECT order_id, card_type, decision, CASE decision
    WHEN 'invalid' THEN 'Credit card info is invalid.'
    WHEN 'brand_not_accepted' THEN 'Sorry, we cannot process ' || card_type
      || ' credit cards. Only VISA or MasterCard is accepted.'
    WHEN 'expired' THEN 'The credit card (ending ' || right(number, 4) || ') expired on ' || m || '/' || y || '.' END
  AS message, decision = 'accepted' AND NOT synthetic AS charged FROM decided""",
    "payment_counter": f"""WITH {_CHARGES} SELECT currency, count(*) AS payments FROM decided
WHERE decision = 'accepted' GROUP BY 1""",
}

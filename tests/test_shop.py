"""Money, currency, orders, cart, catalog, ads, payment and shipping rules on small inputs."""

import hashlib
import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewell.functions import money, text
from tracewell.plans import ads, cart, catalog, currency, orders, payment, shipping
from tracewell.sources import ads as ad_source
from tracewell.sources import catalog as catalog_source
from tracewell.sources import rates as rate_source

MONEY = "struct<currency_code: string, units: bigint, nanos: int>"


def amounts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, m {MONEY}")


def evaluate(spark, predicate, *values):
    df = amounts(spark, *(("", u, n) for u, n in values))
    return [r[0] for r in df.orderBy("i").select(predicate(F.col("m"))).collect()]


BIG = 981273891273
SIGNS = [(0, 0), (1, 1), (-1, 1), (-1, -1), (1, -1)]


def test_money_validity(spark):
    values = [(-BIG, -999999999), (-BIG, 999999999), (BIG, 999999999), (BIG, -999999999)]
    values += [(3, 10**9), (3, -(10**9)), (-3, 10**9), (-3, -(10**9))]
    assert evaluate(spark, money.is_valid, *values) == [True, False, True, False, False, False, False, False]


def test_money_sign_classes(spark):
    assert evaluate(spark, money.is_zero, *SIGNS) == [True, False, False, False, False]
    assert evaluate(spark, money.is_positive, *SIGNS) == [False, True, False, False, False]
    assert evaluate(spark, money.is_negative, *SIGNS) == [False, False, False, True, False]
    assert evaluate(spark, money.is_positive, (0, 10**9)) == [True]  # range is not checked without units


def test_money_pairs(spark):
    def pair(function, left, right):
        df = spark.createDataFrame([(left, right)], f"l {MONEY}, r {MONEY}")
        return df.select(function(F.col("l"), F.col("r"))).first()[0]

    same = [
        (("", 1, 0), ("", 2, 0), False),
        (("", 1, 0), ("USD", 2, 0), False),
        (("USD", 1, 0), ("", 2, 0), False),
        (("USD", 1, 0), ("CAD", 2, 0), False),
        (("USD", 1, 0), ("USD", 2, 0), True),
    ]
    assert [pair(money.same_currency, a, b) for a, b, _ in same] == [w for *_, w in same]
    equal = [
        (("USD", 1, 2), ("USD", 1, 2), True),
        (("USD", 1, 2), ("CAD", 1, 2), False),
        (("USD", 10, 20), ("USD", 1, 20), False),
        (("USD", 1, 2), ("USD", 1, 20), False),
        (("USD", 1, 2), ("USD", -1, -2), False),
    ]
    assert [pair(money.equal, a, b) for a, b, _ in equal] == [w for *_, w in equal]
    df = amounts(spark, ("", 0, 0), ("", -1, -200), ("", 1, 200), ("XXX", 0, 0))
    assert [tuple(r[0]) for r in df.orderBy("i").select(money.negate(F.col("m"))).collect()] == [
        ("", 0, 0),
        ("", 1, 200),
        ("", -1, -200),
        ("XXX", 0, 0),
    ]


INVALID, MISMATCH = money.INVALID, money.MISMATCH
SUMS = [
    (("", 0, 0), ("", 0, 0), (0, 0), None),
    (("XXX", 0, 0), ("", 0, 0), (0, 0), MISMATCH),
    (("", 0, 0), ("YYY", 0, 0), (0, 0), MISMATCH),
    (("AAA", 0, 0), ("BBB", 0, 0), (0, 0), MISMATCH),
    (("", 1, -1), ("", 0, 0), (0, 0), INVALID),
    (("", 0, 0), ("", -1, 2), (0, 0), INVALID),
    (("", 0, 10**9), ("", 1, 0), (0, 0), INVALID),
    (("", 2, 200000000), ("", 2, 200000000), (4, 400000000), None),
    (("", 2, 111111111), ("", 2, 888888888), (4, 999999999), None),
    (("", 2, 200000000), ("", 2, 900000000), (5, 100000000), None),
    (("", -2, -200000000), ("", -2, -200000000), (-4, -400000000), None),
    (("", -2, -200000000), ("", -2, -900000000), (-5, -100000000), None),
    (("", 11, 0), ("", -2, 0), (9, 0), None),
    (("", -11, 0), ("", 2, 0), (-9, 0), None),
    (("", 11, 100000000), ("", -2, -100000000), (9, 0), None),
    (("", 11, 100000000), ("", -2, -9000000), (9, 91000000), None),
    (("", -11, -100000000), ("", 2, 100000000), (-9, 0), None),
    (("", -11, -100000000), ("", 2, 9000000), (-9, -91000000), None),
    (("", 0, 0), ("", -2, -100000000), (-2, -100000000), None),
    (("", -2, -100000000), ("", 0, 0), (-2, -100000000), None),
    (("", 0, 500000000), ("", 0, 200000000), (0, 700000000), None),  # stays normalized
]


def test_money_sums(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(SUMS)], f"i int, l {MONEY}, r {MONEY}")
    got = df.orderBy("i").select(money.add(F.col("l"), F.col("r")).alias("s")).select("s.*").collect()
    assert [((r.value.units, r.value.nanos), r.error) for r in got] == [(w, e) for *_, w, e in SUMS]
    long = df.select("i", F.explode(F.array("l", "r")).alias("amount"))
    grouped = orders.sum_money(long, "i").orderBy("i").collect()
    assert [((r.units, r.nanos), r.error) for r in grouped] == [(w, e) for *_, w, e in SUMS]


def test_large_sums_are_exact(spark):
    df = spark.range(1000).select(F.lit(0).alias("g"), money.money("USD", F.lit(9 * 10**15), F.lit(999999999)).alias("amount"))
    row = orders.sum_money(df, "g").first()
    assert (row.units, row.nanos) == (9 * 10**18 + 999, 999999000)


def test_quantity_below_one_counts_as_one(spark):
    df = amounts(spark, ("USD", 3, 500000000)).crossJoin(spark.createDataFrame([(0,), (1,), (4,)], "q int"))
    got = {r.q: int(r.t) for r in df.select("q", money.times(F.col("m"), F.col("q")).alias("t")).collect()}
    assert got == {0: 3500000000, 1: 3500000000, 4: 14000000000}


def test_conversion(spark):
    rates = rate_source.rates(spark)
    assert rates.count() == 33 and rate_source.supported_currencies(rates).columns == ["currency_code"]
    df = spark.createDataFrame(
        [(("USD", 330, 750000000), "CAD"), (("EUR", 0, 50000000), "EUR"), (("USD", 1, 0), "???"), (("", 1, 0), "USD")],
        f"amount {MONEY}, to_code string",
    )
    got = {r.to_code: r.converted for r in currency.convert(df, rates).collect()}
    assert set(got) == {"CAD", "EUR"}
    assert got["CAD"].units == 442 and got["CAD"].nanos >= 599380800
    assert (got["EUR"].units, got["EUR"].nanos) == (0, 50000000)  # leading zeros of nanos are kept
    assert sorted(r.to_code for r in currency.rejects(df, rates).collect()) == ["???", "USD"]


def test_page_price_is_unchanged_for_dollars_or_no_currency(spark):
    df = spark.createDataFrame([(("USD", 10, 5), c) for c in ("", "USD", None, "EUR")], f"p {MONEY}, c string")
    got = {r.c: tuple(r.out) for r in currency.localized(df, rate_source.rates(spark), "p", F.col("c"), "out").collect()}
    assert got[""] == got["USD"] == got[None] == ("USD", 10, 5)
    assert got["EUR"][0] == "EUR" and got["EUR"][1] == 8


@pytest.fixture
def folder(tmp_path):
    def product(pid, name, units, nanos=0, about=""):
        price = {"currencyCode": "USD", "units": units, "nanos": nanos}
        return {"id": pid, "name": name, "description": about, "priceUsd": price, "categories": ["c"]}

    first = {"products": [product("1", "Roof Binoculars", 209, 950000000), product("2", "Lens Kit", 21, about="50% Off_")]}
    second = {"products": [product("3", "Comet Book", 0, 990000000)]}
    (tmp_path / "a.json").write_text(json.dumps(first, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(second))
    (tmp_path / "notes.txt").write_text("{}")
    return str(tmp_path)


def test_catalog_files_and_search(spark, folder):
    products = catalog_source.read(spark, folder)
    assert {r.id: (r.price_usd.units, r.price_usd.nanos) for r in products.collect()} == {
        "1": (209, 950000000),
        "2": (21, 0),
        "3": (0, 990000000),
    }
    found = catalog.search(products, ["Roof Binoculars", "%", "_", "LENS", "zzz"]).select("query", "id").collect()
    assert sorted(map(tuple, found)) == [("%", "2"), ("LENS", "2"), ("Roof Binoculars", "1"), ("_", "2")]
    assert {r.query: r.results for r in catalog.search_counts(products, ["o", "zzz"]).collect()} == {"o": 3}


def test_catalog_refresh():
    now, loads = [0.0], []

    def load():
        if len(loads) == 2:
            loads.append("failed")
            raise OSError("gone")
        loads.append("ok")
        return len(loads)

    fresh = catalog_source.Refreshing(load, seconds=-1, clock=lambda: now[0])
    assert fresh.get() == 1
    now[0] = 9.9
    assert fresh.get() == 1
    now[0] = 10.0
    assert fresh.get() == 2
    now[0] = 20.0
    assert fresh.get() == 2  # a failed refresh keeps the last catalog
    now[0] = 30.0
    assert fresh.get() == 4


def test_orders_with_missing_products(spark, folder):
    products = catalog_source.read(spark, folder)
    items = spark.createDataFrame(
        [("o1", "1", 2), ("o1", "9", 1), ("o2", "3", 5), ("o3", "8", 1)], "order_id string, product_id string, quantity int"
    )
    assert {(r.order_id, r.product_id) for r in orders.enrich(items, products).collect()} == {("o1", "1"), ("o2", "3")}
    assert {r.order_id: r.missing for r in orders.failed_orders(items, products).collect()} == {"o1": 1, "o3": 1}
    assert [r.order_id for r in orders.complete_orders(items, products).collect()] == ["o2"]
    totals = orders.totals(items.withColumn("user_currency", F.lit("EUR")), products, rate_source.rates(spark), 50.0)
    (row,) = totals.collect()
    # five books at 0.99 USD and a 250.00 USD quote, each truncated in euros
    book = int(0.99 / 1.1305 * 1e9)
    ship = 250.0 / 1.1305
    want = 5 * book + int(ship) * 10**9 + int((ship - int(ship)) * 1e9)
    assert (row.order_id, row.item_count) == ("o2", 5)
    assert row.total.units * 10**9 + row.total.nanos == want


def test_order_records_have_one_shape_whatever_their_size(spark):
    rows = [("big", f"p{i}", 1) for i in range(12_000)] + [("small", "p1", 2), ("small", "p2", 3)]
    items = spark.createDataFrame(rows, "order_id string, product_id string, quantity int").withColumn(
        "cost", money.money("USD", F.lit(1), F.lit(0))
    )
    headers = spark.createDataFrame([("big", "t1"), ("small", "t2"), ("none", "t3")], "order_id string, shipping_tracking_id string")
    got = {r.order_id: r for r in orders.assemble(items, headers).collect()}
    assert {k: (r.part, len(r["items"])) for k, r in got.items()} == {"big": (0, 12_000), "small": (0, 2)}
    assert [i["item"]["quantity"] for i in got["small"]["items"]] == [2, 3]
    parted = [r for r in orders.assemble(items, headers, parts=5).collect() if r.order_id == "big"]
    assert {r.part for r in parted} == set(range(5)) and sum(len(r["items"]) for r in parted) == 12_000
    assert {r.order_id: r["count"] for r in orders.lines(items, headers).groupBy("order_id").count().collect()} == {
        "big": 12_000,
        "small": 2,
    }


START = datetime(2024, 1, 1)


def writes(spark, rows):
    return spark.createDataFrame(
        [(u, p, q, k, START + timedelta(minutes=m), i) for i, (u, p, q, k, m) in enumerate(rows)],
        "user_id string, product_id string, quantity bigint, kind string, event_time timestamp, seq bigint",
    )


def cart_model(rows, ttl=60, as_of=None):
    state, last = {}, {}
    for user, product, quantity, kind, minute in rows:
        items = state.setdefault(user, {})
        if user in last and minute - last[user] > ttl:
            items.clear()
        last[user] = minute
        if kind == "empty":
            items.clear()
        else:
            items[product] = items.get(product, 0) + quantity
    return {
        (u, p): q for u, items in state.items() if as_of is None or as_of - last[u] <= ttl for p, q in items.items()
    }


def test_cart_cases(spark):
    rows = [
        ("a", "x", 1, "add", 0),
        ("a", "x", 1, "add", 1),
        ("b", "x", 1, "add", 0),
        ("b", None, 0, "empty", 0),
        ("c", "x", 1, "add", 0),
        ("c", "y", 1, "add", 60),
        ("c", "y", 1, "add", 120),
        ("d", "x", 1, "add", 0),
        ("d", "y", 1, "add", 61),
    ]
    got = {(r.user_id, r.product_id): r.quantity for r in cart.state(writes(spark, rows)).collect()}
    assert got == {("a", "x"): 2, ("c", "x"): 1, ("c", "y"): 2, ("d", "y"): 1} == cart_model(rows)
    later = cart.state(writes(spark, rows), as_of=START + timedelta(minutes=121)).collect()
    assert {(r.user_id, r.product_id): r.quantity for r in later} == cart_model(rows, as_of=121)
    assert {r.user_id: r.item_count for r in cart.item_count(cart.state(writes(spark, rows))).collect()} == {
        "a": 2,
        "c": 3,
        "d": 1,
    }


def test_cart_random(spark):
    rnd = random.Random(5)
    minute, rows = 0, []
    for _ in range(600):
        minute += rnd.choice((0, 0, 1, 10, 30, 59, 61, 90))
        kind = "empty" if rnd.random() < 0.08 else "add"
        rows.append((f"u{int(rnd.random() ** 3 * 6)}", f"p{rnd.randrange(5)}", rnd.randrange(1, 4), kind, minute))
    got = {(r.user_id, r.product_id): r.quantity for r in cart.state(writes(spark, rows)).collect()}
    assert got == cart_model(rows)


def test_recommendations_skip_requested_products(spark):
    products = spark.range(30).select(F.col("id").cast("string").alias("id"))
    products = products.union(products.limit(3))  # a catalog may list a product twice
    requests = spark.createDataFrame(
        [(1, ["0", "1,2"]), (2, []), (3, [str(i) for i in range(27)]), (4, [",".join(map(str, range(30)))]), (5, ["zz"]), (6, None), (7, [None, "1"])],
        "request_id int, product_ids array<string>",
    )
    got = {}
    for r in catalog.recommend(requests, products).collect():
        got.setdefault(r.request_id, {})[r["rank"]] = r.product_id
    assert {k: sorted(v) for k, v in got.items()} == {k: [1, 2, 3, 4, 5][: (3 if k == 3 else 5)] for k in (1, 2, 3, 5, 6, 7)}
    assert all(len(set(v.values())) == len(v) for v in got.values())
    assert not {"0", "1", "2"} & set(got[1].values())
    assert set(got[3].values()) == {"27", "28", "29"}
    counts = {r.request_id: r.candidates for r in catalog.candidate_counts(requests, products).collect()}
    assert counts == {1: 27, 2: 30, 3: 3, 4: 0, 5: 30, 6: 30, 7: 29}
    assert {k: min(5, n) for k, n in counts.items() if n} == {k: len(v) for k, v in got.items()}
    none = catalog.recommend(requests, products.where("false"))
    assert none.count() == 0


@pytest.mark.parametrize("n_products", [1, 3, 200, 255, 256, 257, 511, 512, 700, 1300])
def test_recommendations_follow_the_laid_out_catalog(spark, n_products):
    """Against a plain walk, for catalogs around the stretch sizes and requests longer than a stretch."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    order = sorted(map(str, range(n_products)), key=lambda i: (md5(i), i))
    rnd = random.Random(n_products)
    asked = {r: [str(i) for i in rnd.sample(range(1400), rnd.choice((0, 2, 9, 251, 252, 600)))] for r in range(120)}
    want = set()
    for request, skip in asked.items():
        start = int(md5(f"{request}|")[:8], 16) % n_products
        free = [p for p in order[start:] + order[:start] if p not in set(skip)]
        want |= {(request, rank + 1, p) for rank, p in enumerate(free[:5])}
    requests = spark.createDataFrame(list(asked.items()), "request_id int, product_ids array<string>")
    products = spark.range(n_products).select(F.col("id").cast("string").alias("id"))
    got = catalog.recommend(requests, products).collect()
    assert len(got) == len(want)
    assert {(r.request_id, r["rank"], r.product_id) for r in got} == want


def test_ads(spark):
    requests = spark.createDataFrame(
        [(1, ["accessories", "travel"]), (2, ["books"]), (3, []), (4, None), (5, ["travel", "travel", "books"])],
        "request_id int, context_keys array<string>",
    )
    got = {}
    for r in ads.select(requests, ad_source.ads(spark)).collect():
        got.setdefault((r.request_id, r.request_type, r.response_type), []).append(r.redirect_url)
    assert {k: len(v) for k, v in got.items()} == {
        (1, "TARGETED", "TARGETED"): 4,
        (2, "TARGETED", "RANDOM"): 2,
        (3, "NOT_TARGETED", "RANDOM"): 2,
        (4, "NOT_TARGETED", "RANDOM"): 2,
        (5, "TARGETED", "TARGETED"): 2,
    }
    counted = {(r.request_type, r.response_type): r.requests for r in ads.requests_by_type(requests, ad_source.ads(spark)).collect()}
    assert counted == {("TARGETED", "TARGETED"): 2, ("TARGETED", "RANDOM"): 1, ("NOT_TARGETED", "RANDOM"): 2}


def test_payments(spark):
    cards = [
        ("4432-8015-6152-0454", 2030, 1, False, "accepted", True),
        ("4432-8015-6152-0454", 2030, 1, True, "accepted", False),
        ("4432-8015-6152-0454", 2021, 1, False, "expired", False),
        ("4432-8015-6152-0454", 2024, 1, False, "accepted", True),  # good until the month is over
        ("3714 496353 98431", 2021, 1, False, "brand_not_accepted", False),
        ("0000-0000-0000-0000", 2021, 1, False, "invalid", False),
        ("4432-8015-6152-0455", 2030, 1, False, "invalid", False),
        ("5555-5555-5555-4444", 2030, 1, False, "accepted", True),
        ("2223003122003222", 2030, 1, False, "accepted", True),
        ("abc", 2030, 1, False, "invalid", False),
        ("6011-1111-1111-1117", 2030, 1, False, "brand_not_accepted", False),
    ]
    df = spark.createDataFrame(
        [(i, ("USD", 1, 0), n, y, m, s) for i, (n, y, m, s, *_) in enumerate(cards)],
        f"i int, amount {MONEY}, credit_card_number string, expiration_year int, expiration_month int, synthetic boolean",
    )
    decided = payment.decide(df, date(2024, 1, 31))
    rows = decided.orderBy("i").collect()
    assert [(r.decision, r.charged) for r in rows] == [(d, c) for *_, d, c in cards]
    assert rows[2].message == "The credit card (ending 0454) expired on 1/2021."
    assert rows[4].message == "Sorry, we cannot process amex credit cards. Only VISA or MasterCard is accepted."
    assert rows[5].message == "Credit card info is invalid." and rows[0].message is None
    assert payment.transactions_by_currency(decided).first().payments == 5
    assert payment.decide(df.drop("synthetic")).where("charged").count() >= 1
    taken = payment.decide(df, date(2024, 1, 31), brands={"house": r"^6011\d{12}$"}, accepted=["house"])
    assert [r.i for r in taken.where("charged").collect()] == [10]


def test_shipping_quotes(spark):
    counts = spark.createDataFrame([(0, 50.0), (3, 40.1), (7, 99.9), (1, 44.05)], "item_count bigint, cost double")
    got = {r.item_count: tuple(r.cost_usd)[1:] for r in shipping.quotes(counts, F.col("cost")).collect()}
    assert got == {0: (0, 0), 3: (120, 300000000), 7: (699, 300000000), 1: (44, 50000000)}
    drawn = spark.range(2000).select(shipping.drawn_cost(F.col("id")).alias("c")).agg(F.min("c"), F.max("c")).first()
    assert 40.0 <= drawn[0] < 41 and 99 < drawn[1] <= 100.0


def test_hash_is_stable(spark):
    assert spark.range(1).select(text.unit_hash(F.lit("a"), seed="s")).first()[0] == int(
        __import__("hashlib").md5(b"a|s").hexdigest()[:8], 16
    )

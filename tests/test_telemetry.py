"""Edge rules of flattening, windows, percentile, self time, histograms and conformance."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewell.functions import attributes, clock, quantile, text
from tracewell.operators import conformance, counters, flatten, histogram, latency, numbering, selftime, skew
from tracewell.plans import dashboard, program
from tracewell.sources import telemetry

NS = 10**9


def span(span_id="s", parent="", name="op", start=0, end=0, trace="t", **more):
    return {
        "traceId": trace,
        "spanId": span_id,
        "parentSpanId": parent,
        "name": name,
        "startTimeUnixNano": str(start),
        "endTimeUnixNano": str(end),
        **more,
    }


def request(*spans, attrs=()):
    return {
        "resourceSpans": [
            {"resource": {"attributes": list(attrs)}, "scopeSpans": [{"scope": {"name": "lib"}, "spans": list(spans)}]}
        ]
    }


@pytest.fixture
def load(spark, tmp_path):
    def _load(*documents, **kw):
        (tmp_path / "in.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
        return telemetry.traces(spark, str(tmp_path / "in.json"), **kw)

    return _load


def test_empty_and_null_arrays_give_no_rows(load):
    requests = load(
        {},
        {"resourceSpans": []},
        {"resourceSpans": [{"resource": {}, "scopeSpans": None}, {"resource": {}, "scopeSpans": []}]},
        {"resourceSpans": [{"scopeSpans": [{"scope": {}, "spans": []}, {"scope": {}, "spans": None}]}]},
        "{broken",
        request(span("a"), span("b")),
        {"resourceSpans": request(span("c"))["resourceSpans"] + request(span("d"))["resourceSpans"]},
    )
    assert sorted(r.spanId for r in flatten.spans(requests).collect()) == ["a", "b", "c", "d"]


def test_unknown_fields_are_ignored_and_variants_survive(load):
    attr = {"key": "k", "value": {"kvlistValue": {"values": [{"key": "x", "value": {"intValue": "1"}}]}}}
    requests = load(request(span("a", status={"code": 2}, attributes=[attr])))
    row = flatten.spans(requests).select(F.to_json(F.col("attributes")[0]["value"]).alias("v")).first()
    assert json.loads(row.v) == attr["value"]


def test_times_are_whole_seconds_and_subtract_before_truncating(load):
    row = flatten.spans(load(request(span(start=9 * NS + 999_999_999, end=12 * NS + 499_999)))).first()
    assert row.eventTime == datetime(1970, 1, 1, 0, 0, 9)
    assert row.elapsedTimeMillis == 2000
    row = flatten.spans(load(request(span(start=5_999_999, end=4_000_000)))).first()
    assert row.elapsedTimeMillis == -1


def test_event_time_ignores_the_session_zone(spark, load):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert flatten.spans(load(request(span(start=NS, end=NS)))).first().eventTime == datetime(1970, 1, 1, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_nanos_fail_or_become_null(load):
    requests = load(request(span(startTimeUnixNano="x1"), span("b", startTimeUnixNano=" 7 ", endTimeUnixNano="9")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flatten.spans(requests).collect()
    rows = {r.spanId: r for r in flatten.spans(requests, on_bad_record="null").collect()}
    assert rows["s"].eventTime is None and rows["s"].elapsedTimeMillis is None
    assert rows["b"].elapsedTimeMillis == 0
    with pytest.raises(ValueError):
        clock.text_to_bigint(F.lit("1"), "skip")


def test_null_parent_is_no_root_and_null_time_has_no_window(spark):
    spans = spark.createDataFrame(
        [("", 5, datetime(2024, 1, 1)), (None, 6, datetime(2024, 1, 1)), ("", 7, None), ("p", 8, datetime(2024, 1, 1))],
        "parentSpanId string, elapsedTimeMillis bigint, eventTime timestamp_ntz",
    )
    assert latency.root_spans(spans).count() == 2
    assert [r.throughput for r in latency.throughput(spans).collect()] == [1]
    assert latency.tumble(spans).count() == 3


P95 = [
    ([], None),
    ([5], 5),
    ([1, 2], 1),
    ([10, 20, 30], 28),
    (list(range(1, 21)), 19),
    (list(range(1, 101)), 95),
    ([None, None], None),
    ([None, 30, 10, None, 20], 28),
]


def p95_model(values):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    rank = 0.95 * len(xs) - 1.0
    low, high = max(math.floor(rank), 0), max(math.ceil(rank), 0)
    return xs[low] if low == high else int(xs[low] * (1 - (rank - low)) + xs[high] * (rank - low))


def test_p95_of_arrays(spark):
    program.register_functions(spark)
    df = spark.createDataFrame([(a, e) for a, e in P95], "x array<bigint>, want bigint")
    rows = df.select("want", quantile.p95(F.col("x")).alias("column"), F.expr("p95(x)").alias("sql")).collect()
    assert [(r.column, r.sql) for r in rows] == [(r.want, r.want) for r in rows]


def test_p95_counting_plan_equals_sorting(spark):
    rnd = random.Random(1)
    groups = {i: [rnd.choice([None, rnd.randrange(-50, 400)]) for _ in range(rnd.randrange(1, 60))] for i in range(40)}
    groups[99] = [None, None]
    rows = [("", v, datetime(2024, 1, 1) + timedelta(hours=g)) for g, vs in groups.items() for v in vs]
    spans = spark.createDataFrame(rows, "parentSpanId string, elapsedTimeMillis bigint, eventTime timestamp_ntz")
    got = {r.time: r.latencyMs for r in latency.p95_latency(spans, "1 hour").collect()}
    assert got == {datetime(2024, 1, 1) + timedelta(hours=g): p95_model(vs) for g, vs in groups.items()}


def test_self_time_rules(spark):
    rows = [
        ("t", "r", "", "root", 100),
        ("t", "a", "r", "child", 80),
        ("t", "b", "r", "child", 70),  # parallel children: root becomes negative
        ("t", "c", "a", "leaf", 30),
        ("t", "d", "a", "leaf", None),  # unknown child duration counts as zero
        ("t", "x", "gone", "orphan", 9),
        ("t", "n", "r", None, 5),  # no name is a group of its own
        ("u", "r", "", "twice", 50),
        ("u", "r", "", "twice", 60),  # duplicates each subtract the whole child sum
        ("u", "k", "r", "leaf", 10),
        ("u", "q", "", "untimed", None),
        ("u", "w", "q", "leaf", 4),
        (None, "r", None, "odd", 3),
    ]
    spans = spark.createDataFrame(
        rows, "traceId string, spanId string, parentSpanId string, name string, elapsedTimeMillis bigint"
    )
    want = {
        "root": 100 - 155,
        "child": 80 - 30 + 70,
        "leaf": 30 + 10 + 4,
        "orphan": 9,
        None: 5,
        "twice": 50 + 60 - 20,
        "untimed": None,
        "odd": 3,
    }
    result = selftime.operation_execution_time(spans)
    assert {r.name: r.elapsed for r in result.collect()} == want
    spans.createOrReplaceTempView("st")
    by_subquery = spark.sql(
        """SELECT s.name, sum(s.elapsedTimeMillis - coalesce((SELECT sum(k.elapsedTimeMillis) FROM st k
           WHERE k.traceId = s.traceId AND k.parentSpanId = s.spanId), 0)) AS elapsed FROM st s GROUP BY s.name"""
    )
    assert {r.name: r.elapsed for r in by_subquery.collect()} == want


def test_program_views_and_batch_tables(spark, load, tmp_path):
    requests = load(request(span("a", start=NS, end=3 * NS), span("b", "a", "inner", NS, 2 * NS)))
    found = program.register(spark, traces=requests)
    assert {"rsSpans", "spans_array", "spans", "spans_tumble_10s", *program.MAINTAINED[3:]} <= set(found)
    assert spark.sql("SELECT p95(array_agg(elapsedTimeMillis)) AS p FROM spans").first().p == p95_model([1000, 2000]) == 1899
    assert spark.sql("SELECT * FROM operation_execution_time WHERE name = 'op'").first().elapsed == 1000
    assert spark.sql("SELECT nanos_to_seconds(-1999999999) AS s, nanos_to_millis(-1999999) AS m").first() == (-1, -1)
    store = str(tmp_path / "store")
    assert program.run_batch(store, traces=requests) == ["spans", *program.MAINTAINED[3:]]
    assert program.run_batch(store, only=("throughput",), traces=requests.where("false")) == ["throughput"]
    assert spark.read.parquet(f"{store}/spans").count() == found["spans"].count()  # what is there and not asked for stays
    named = program.views(traces=requests, normalize_names=True)["spans"]
    names = found["spans"].select(text.normalize_span_name(F.col("name")))
    assert sorted(named.select("name").collect()) == sorted(names.collect())
    assert spark.read.parquet(f"{store}/throughput").first().throughput == 1


def test_dashboard_default_range_and_bounds(spark):
    start, end = dashboard.default_range(datetime(2024, 1, 1, 12))
    assert (end - start, end) == (timedelta(minutes=5), datetime(2024, 1, 1, 12))
    assert dashboard.REFRESH == timedelta(seconds=10)
    times = spark.createDataFrame([(1, datetime(2024, 1, 1, 0, 0, s)) for s in range(5)], "throughput bigint, time timestamp_ntz")
    got = dashboard.throughput_series(times, "2024-01-01 00:00:01", datetime(2024, 1, 1, 0, 0, 3)).collect()
    assert [r.time.second for r in got] == [3, 2, 1]
    assert dashboard.throughput_series(times).count() == 0


def test_explicit_histogram_keeps_empty_and_overflow_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (1, 10, 11, 99, None)], "v int")
    got = [(r.bucket, r.upper_bound, r.n) for r in histogram.explicit(df, "v", (10, 20, 30)).orderBy("bucket").collect()]
    assert got == [(0, 10.0, 2), (1, 20.0, 1), (2, 30.0, 0), (3, None, 1)]


def test_counter_with_values_and_null_labels(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), (None, 4)], "k string, v bigint")
    got = {r.k: r.value for r in counters.counter(df, ["k"], F.col("v")).collect()}
    assert got == {"a": 5, None: 4}


def test_span_names_and_targets(spark):
    names = ["GET /api/products/1?x=1", "GET /api/products/", "GET /api/cart?a?b", "plain", "POST /api/products/1", "?"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.normalize_span_name(F.col("n"))).collect()]
    route = "GET /api/products/{productId}"
    assert got == [route, route, "GET /api/cart", "plain", "POST /api/products/1", ""]
    assert [r[0] for r in df.select(text.request_target(F.col("n"))).collect()][2] == "GET /api/cart"


def test_attribute_lookup(load):
    attrs = [
        {"key": "a", "value": {"stringValue": "x"}},
        {"key": "a", "value": {"stringValue": "y"}},
        {"key": "i", "value": {"intValue": "7"}},
        {"key": "b", "value": {"boolValue": True}},
        {"key": "l", "value": {"arrayValue": {"values": []}}},
    ]
    spans = flatten.spans(load(request(span(attributes=attrs))))
    of = lambda k: attributes.attribute_text(F.col("attributes"), k)
    assert list(spans.select(*(of(k).alias(k) for k in ("a", "i", "b", "l", "none"))).first()) == [
        "x",
        "7",
        "true",
        None,
        None,
    ]
    assert spans.select(attributes.attribute_as(F.col("attributes"), "i", "intValue", "bigint")).first()[0] == 7


@pytest.mark.parametrize("block", [2, 7, 65536])
def test_running_count_equals_window(spark, block):
    df = spark.range(0, 500, 3).withColumnRenamed("id", "offset")
    got = sorted((r.offset, r.running_count) for r in numbering.running_count(df, "offset", block=block).collect())
    assert got == [(o, i + 1) for i, o in enumerate(range(0, 500, 3))]


def test_shuffled_positions_are_dense(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    got = numbering.shuffled_positions(df, "id").collect()
    assert sorted(r.position for r in got) == list(range(1000))


def test_salted_join_equals_join(spark):
    hot = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("k"), "id")
    side = spark.range(0, 300, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(
        spark.sql("SELECT 1L AS k, 7L AS v")
    )
    for how in ("inner", "left", "left_anti", "left_semi"):
        want = sorted(map(str, hot.join(side, "k", how).select("id").collect()))
        got = sorted(map(str, skew.salted_join(hot, side, "k", "id", how).select("id").collect()))
        assert got == want


def test_conformance_rules(load):
    def with_attrs(span_id, **attrs):
        listed = [{"key": k.replace("_", "."), "value": {"stringValue": str(v)}} for k, v in attrs.items()]
        return span(span_id, name="call", attributes=listed)

    requests = load(
        request(with_attrs("a", rpc_code=0, body='{"n": {"m": 5}}'), with_attrs("b", rpc_code=2)),
        request({**with_attrs("c", rpc_code=0), "traceId": "t2"}),
    )
    spans = flatten.spans(requests)
    rule = conformance.Rule
    rules = [
        rule("zero", "rpc.code", "=", 0, {"name": "call"}),
        rule("upto", "rpc.code", "<=", 2),
        rule("path", "body", ">", 4, {"name": "call"}, json_path="$.n.m"),
        rule("seen", conformance.MATCHED_COUNT, ">=", 3, {"name": "call"}),
        rule("none", conformance.MATCHED_COUNT, ">=", 1, {"name": "other"}),
        rule("has", "body", "contains", '"n"', {"rpc.code": "0"}),
        rule("not", "rpc.code", "!=", "1"),
    ]
    got = {r.rule_id: (r.matched, r.passed, r.ok) for r in conformance.check(spans, rules).collect()}
    assert got == {
        "zero": (3, 2, False),
        "upto": (3, 3, True),
        "path": (3, 1, False),
        "seen": (3, 3, True),
        "none": (0, 0, False),
        "has": (2, 1, False),
        "not": (3, 3, True),
    }
    by_trace = conformance.check(spans, rules[:1], by=("traceId",)).collect()
    assert {r.traceId: r.ok for r in by_trace} == {"t": False, "t2": True}
    with pytest.raises(ValueError):
        rule("bad", "x", "~", 1)

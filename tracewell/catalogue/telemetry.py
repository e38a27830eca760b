"""Telemetry queries. Spark reads nested requests derived from ``events``; the SQL works on the flat form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import fixtures, schemas
from tracewell.functions import attributes, text
from tracewell.operators import conformance, counters, flatten, histogram, latency, points, rules, selftime
from tracewell.plans import dashboard, program
from tracewell.sources import telemetry

RANGE = ("2024-01-05 00:00:00", "2024-01-20 12:00:00")
DAY = "1 day"
ROUTED_NAME = """CASE event_id % 3 WHEN 0 THEN concat('GET /api/products/', CAST(event_id AS STRING), '?c=1')
                 WHEN 1 THEN concat('/cart?x=', CAST(event_id AS STRING)) ELSE event_type END"""

RULES = (
    conformance.Rule("post-status", "http.status_code", "=", 200, {"http.method": "POST"}),
    conformance.Rule("not-error", "name", "!=", "error", {"http.method": "GET", "kind": "2"}),
    conformance.Rule("purchase-k", "response.body", ">=", 10, {"name": "purchase"}, json_path="$.k"),
    conformance.Rule("kind-low", "kind", "<=", 4, {"name": "click"}),
    conformance.Rule("body-has-k", "response.body", "contains", '"k": 7', {"name": "view"}),
    conformance.Rule("user-known", "user", ">", 0, {"name": "signup", "http.method": "GET"}),
    conformance.Rule("signups-seen", conformance.MATCHED_COUNT, ">=", 1, {"name": "signup"}),
    conformance.Rule("refunds-seen", conformance.MATCHED_COUNT, ">=", 1, {"name": "refund"}),
)


def _spans(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return flatten.spans(fixtures.events(spark, sf_dir), root=fixtures.trace_root(**kw))


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans with only what latency and throughput read."""
    return _spans(spark, sf_dir, fields=latency.SPAN_FIELDS, envelope=False)


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans with ids, names and times."""
    return _spans(spark, sf_dir, fields=selftime.SPAN_FIELDS, envelope=False)


def _scalar_spans(spans: DataFrame) -> DataFrame:
    return spans.select(
        attributes.attribute_as(F.col("resource.attributes"), "service.name", "stringValue", "string").alias("service"),
        F.col("scope.name").alias("scope_name"),
        "traceId",
        "spanId",
        "traceState",
        "parentSpanId",
        "flags",
        "name",
        "kind",
        "startTimeUnixNano",
        "endTimeUnixNano",
        attributes.attribute_as(F.col("attributes"), "user", "intValue", "bigint").alias("user"),
        F.size("events").alias("n_events"),
        "elapsedTimeMillis",
        "eventTime",
    )


def spans_flatten(spark, sf_dir):
    return _scalar_spans(_spans(spark, sf_dir))


def traces_json_ingest(spark, sf_dir):
    lines = fixtures.trace_requests(spark, sf_dir).select(F.to_json(F.struct("resourceSpans")).alias("value"))
    return _scalar_spans(flatten.spans(lines, root=telemetry.payload("value", schemas.trace_requests())))


def logs_flatten(spark, sf_dir):
    return scalar_logs(flatten.logs(fixtures.events(spark, sf_dir), root=fixtures.log_root()))


def logs_json_ingest(spark, sf_dir):
    lines = fixtures.events(spark, sf_dir).select(F.to_json(F.struct(fixtures.log_root().alias("resourceLogs"))).alias("value"))
    return scalar_logs(flatten.logs(lines, root=telemetry.payload("value", schemas.log_requests())))


def scalar_logs(logs):
    return logs.select(
        attributes.attribute_as(F.col("resource.attributes"), "service.name", "stringValue", "string").alias("service"),
        F.col("scope.name").alias("scope_name"),
        attributes.attribute_as(F.col("attributes"), "user", "intValue", "bigint").alias("user"),
        "timeUnixNano",
        "observedTimeUnixNano",
        "severityNumber",
        "severityText",
        "flags",
        "traceId",
        "spanId",
        "eventName",
        F.variant_get("body", "$.k", "bigint").alias("body_k"),
    )


def metrics_flatten(spark, sf_dir):
    return scalar_metrics(flatten.metrics(fixtures.metric_requests(spark, sf_dir)))


def metrics_json_ingest(spark, sf_dir):
    lines = fixtures.metric_requests(spark, sf_dir).select(F.to_json(F.struct("resourceMetrics")).alias("value"))
    return scalar_metrics(flatten.metrics(lines, root=telemetry.payload("value", schemas.metric_requests())))


def scalar_metrics(metrics):
    return metrics.select(
        "name",
        "description",
        "unit",
        F.variant_get("sum", "$.dataPoints[0].asInt", "bigint").alias("sum_value"),
        F.variant_get("gauge", "$.dataPoints[0].asInt", "bigint").alias("gauge_value"),
        F.col("histogram").isNull().alias("no_histogram"),
        attributes.attribute_as(F.col("resource.attributes"), "service.name", "stringValue", "string").alias("service"),
        F.col("scope.version").alias("scope_version"),
        attributes.attribute_as(F.col("metadata"), "source", "stringValue", "string").alias("source"),
    )


def metric_points(spark, sf_dir):
    """One row for each data point of metrics with several of them and payloads of several kinds."""
    found = points.data_points(flatten.metrics(fixtures.point_requests(spark, sf_dir)))
    day = F.timestamp_seconds(F.col("time_nanos") / F.lit(1_000_000_000)).cast("date")
    return found.select(
        "name", "kind", F.col("point_no").cast("bigint").alias("point_no"), day.cast("string").alias("day"), "value", "count", "sum",
        F.array_join("bounds", ",").alias("bounds"), F.array_join("buckets", ",").alias("buckets"),
    )


def span_name_normalize(spark, sf_dir):
    fields = ("spanId", "name", "startTimeUnixNano", "endTimeUnixNano")
    spans = _spans(spark, sf_dir, fields=fields, envelope=False, name=ROUTED_NAME)
    return spans.select("spanId", text.normalize_span_name(F.col("name")).alias("name"))


def span_attr(spark, sf_dir):
    user = attributes.attribute_as(F.col("attributes"), "user", "intValue", "bigint")
    spans = _spans(spark, sf_dir, fields=("attributes", "startTimeUnixNano", "endTimeUnixNano"), envelope=False)
    return spans.groupBy(user.alias("user")).agg(F.count(F.lit(1)).alias("n"))


def span_events(spark, sf_dir):
    fields = ("traceId", "spanId", "startTimeUnixNano", "endTimeUnixNano", "events")
    nested = _spans(spark, sf_dir, fields=fields, envelope=False).select("traceId", "spanId", F.inline("events"))
    return nested.select(
        "traceId",
        "spanId",
        "timeUnixNano",
        F.col("name").alias("event_name"),
        attributes.attribute_as(F.col("attributes"), "props", "stringValue", "string").alias("props"),
    )


def spans_tumble(spark, sf_dir):
    return latency.tumble(_linked(spark, sf_dir)).select("traceId", "spanId", "eventTime", "window_start", "window_end")


def throughput(spark, sf_dir):
    return latency.throughput(_timed(spark, sf_dir))


def p95_latency(spark, sf_dir):
    return latency.p95_latency(_timed(spark, sf_dir))


def p95_latency_daily(spark, sf_dir):
    return latency.p95_latency(_timed(spark, sf_dir), DAY)


def operation_execution_time(spark, sf_dir):
    return selftime.operation_execution_time(_linked(spark, sf_dir))


def execution_time_by_operation(spark, sf_dir):
    return dashboard.execution_time_by_operation(operation_execution_time(spark, sf_dir))


def latency_histogram(spark, sf_dir):
    return dashboard.latency_histogram(_timed(spark, sf_dir), *RANGE)


def request_latencies(spark, sf_dir):
    return dashboard.request_latencies(_timed(spark, sf_dir), *RANGE)


def requests_in_range(spark, sf_dir):
    return dashboard.requests_in_range(_timed(spark, sf_dir), *RANGE)


def slowest_traces(spark, sf_dir):
    return dashboard.slowest_traces(_linked(spark, sf_dir), *RANGE)


def throughput_series(spark, sf_dir):
    return dashboard.throughput_series(throughput(spark, sf_dir), *RANGE)


def p95_series(spark, sf_dir):
    return dashboard.p95_series(p95_latency_daily(spark, sf_dir), *RANGE)


def sql_program(spark, sf_dir):
    """Ad-hoc SQL over the registered views and SQL functions."""
    program.register(spark, traces=fixtures.trace_requests(spark, sf_dir, fields=selftime.SPAN_FIELDS, envelope=False))
    return spark.sql(
        """SELECT s.name, count(*) AS n, sum(nanos_to_millis(CAST(s.endTimeUnixNano AS BIGINT)
                  - CAST(s.startTimeUnixNano AS BIGINT))) AS total_ms,
                  max(make_timestamp_from_nanos(CAST(s.startTimeUnixNano AS BIGINT))) AS last_seen,
                  max(o.elapsed) AS self_ms
           FROM spans s JOIN operation_execution_time o ON s.name = o.name
           WHERE s.parentSpanId = '' GROUP BY s.name"""
    )


def span_metrics(spark, sf_dir):
    found = counters.span_metrics(_spans(spark, sf_dir), dimensions=("http.method",), bounds=(10, 50, 100, 200, 400))
    return found.select(
        "service_name",
        "span_name",
        "span_kind",
        F.col("`http.method`").alias("http_method"),
        "calls",
        "duration_sum",
        F.array_join(F.col("bucket_counts").cast("array<string>"), ",").alias("bucket_counts"),
    )


def explicit_histogram(spark, sf_dir):
    ticks = fixtures.table(spark, sf_dir, "events").selectExpr("CAST(round(value * 3000) AS BIGINT) AS ticks")
    return histogram.explicit(ticks, "ticks", histogram.ADD_ITEM_BOUNDS)


def explicit_histogram_by_type(spark, sf_dir):
    ticks = fixtures.table(spark, sf_dir, "events").selectExpr(
        "event_type", "CAST(round(value * 3000) AS BIGINT) AS ticks"
    )
    return histogram.explicit(ticks, "ticks", histogram.GET_CART_BOUNDS, by=("event_type",))


def request_counter(spark, sf_dir):
    requests = fixtures.table(spark, sf_dir, "events").selectExpr(
        "if(event_id % 3 = 0, 'POST', 'GET') AS method",
        "concat('/api/', event_type, '?id=', CAST(event_id AS STRING)) AS url",
        "if(event_type = 'error', 500, 200) AS status",
    )
    targeted = requests.withColumn("target", text.request_target(F.col("url")))
    return counters.counter(targeted, ["method", "target", "status"], name="requests")


def _ruled(spark, sf_dir):
    fields = ("traceId", "name", "kind", "startTimeUnixNano", "endTimeUnixNano", "attributes")
    return _spans(spark, sf_dir, fields=fields, envelope=False)


def trace_conformance(spark, sf_dir):
    return conformance.check(_ruled(spark, sf_dir), RULES)


def trace_conformance_by_trace(spark, sf_dir):
    return conformance.check(_ruled(spark, sf_dir), RULES, by=("traceId",))


def _rule_texts(spark, sf_dir):
    """Rules over the users, span names and kinds of the events, as text: a few hundred, most with several conditions."""
    events = fixtures.table(spark, sf_dir, "events")
    kind = f"element_at(array({', '.join(map(repr, rules.KINDS))}), CAST(1 + event_id % 5 AS INT))"
    users = events.selectExpr(
        "concat('user-', user_id) AS rule_id",
        """concat('span[tracetest.span.type="http" user="', user_id, '" http.method="POST"]') AS selector""",
        "'attr:http.status_code = 200' AS assertion",
    )
    named = events.selectExpr(
        f"concat('kind-', event_type, '-', {kind}) AS rule_id",
        f"""concat('span[tracetest.span.type="http" name="', event_type, '" kind="', {kind}, '"]') AS selector""",
        "'attr:response.body | json_path \\'$.k\\' <= 8' AS assertion",
    )
    picked = events.groupBy("event_type", (F.col("user_id") % 10).alias("lot")).agg(F.min("user_id").alias("user_id"))
    counted = picked.selectExpr(
        "concat('count-', lot, '-', event_type) AS rule_id",
        """concat('span[name="', event_type, '" user="', user_id, '"]') AS selector""",
        "'attr:tracetest.selected_spans.count >= 12' AS assertion",
    )
    whole = spark.createDataFrame(
        [
            ("all-errors", 'span[name="error"]', 'attr:http.status_code = "500"'),
            ("no-database", 'span[tracetest.span.type="database"]', "attr:tracetest.selected_spans.count >= 1"),
            ("every-span", "span[]", 'attr:response.body contains "k"'),
            ("unknown", 'span[name="click"]', "attr:nothing != 1"),
        ],
        "rule_id string, selector string, assertion string",
    )
    return users.unionByName(named).distinct().unionByName(counted).unionByName(whole)


def trace_rules(spark, sf_dir):
    return rules.check(_ruled(spark, sf_dir), rules.parse(_rule_texts(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        spans_flatten,
        traces_json_ingest,
        logs_flatten,
        logs_json_ingest,
        metrics_flatten,
        metrics_json_ingest,
        metric_points,
        span_name_normalize,
        span_attr,
        span_events,
        spans_tumble,
        throughput,
        p95_latency,
        p95_latency_daily,
        operation_execution_time,
        execution_time_by_operation,
        latency_histogram,
        request_latencies,
        requests_in_range,
        slowest_traces,
        throughput_series,
        p95_series,
        sql_program,
        span_metrics,
        explicit_histogram,
        explicit_histogram_by_type,
        request_counter,
        trace_conformance,
        trace_conformance_by_trace,
        trace_rules,
    )
}

# ---------------------------------------------------------------------------------------------
# SQL

SPANS = """spans AS (
  SELECT *, (endNs - startNs) // 1000000 AS elapsedTimeMillis,
         make_timestamp((startNs // 1000000000) * 1000000) AS eventTime
  FROM (SELECT *, CAST(event_id // 4 AS VARCHAR) AS traceId, CAST(event_id AS VARCHAR) AS spanId,
               CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 3 THEN CAST(event_id - 1 AS VARCHAR)
                    ELSE CAST(event_id - event_id % 4 AS VARCHAR) END AS parentSpanId,
               event_type AS name, CAST(1 + event_id % 5 AS INTEGER) AS kind,
               'svc' || CAST((event_id // 4) % 7 AS VARCHAR) AS service,
               epoch_us(ts) * 1000 AS startNs,
               epoch_us(ts) * 1000 + CAST(round(value * 1000000) AS BIGINT) AS endNs
        FROM events))"""

_SCALARS = f"""WITH {SPANS}
SELECT service, 'lib-' || event_type AS scope_name, traceId, spanId, '' AS traceState, parentSpanId,
       event_id % 2 AS flags, name, kind, CAST(startNs AS VARCHAR) AS startTimeUnixNano,
       CAST(endNs AS VARCHAR) AS endTimeUnixNano, user_id AS "user", CAST(1 AS INTEGER) AS n_events,
       elapsedTimeMillis, eventTime
FROM spans"""


def _p95(bucket: str) -> str:
    """The percentile by sorting, independent of the counting plan."""
    return f"""grouped AS (
  SELECT {bucket} AS "time", list_sort(list(elapsedTimeMillis)) AS xs, count(elapsedTimeMillis) AS n
  FROM spans WHERE parentSpanId = '' GROUP BY 1),
ranked AS (SELECT *, CAST(0.95 AS DOUBLE) * n - 1 AS r FROM grouped),
p95 AS (
  SELECT "time", CASE WHEN floor(r) = ceil(r) OR r < 0 THEN xs[CAST(greatest(floor(r), 0) AS BIGINT) + 1]
         ELSE CAST(trunc(CAST(xs[CAST(floor(r) AS BIGINT) + 1] AS DOUBLE) * (1 - (r - floor(r)))
                       + CAST(xs[CAST(ceil(r) AS BIGINT) + 1] AS DOUBLE) * (r - floor(r))) AS BIGINT) END AS latencyMs
  FROM ranked)"""


_TEN = "time_bucket(INTERVAL '10 seconds', eventTime)"
_DAY = "date_trunc('day', eventTime)"
_IN_RANGE = f"BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"
_SELF = """SELECT s.name, CAST(sum(s.elapsedTimeMillis - coalesce(
         (SELECT sum(k.elapsedTimeMillis) FROM spans k
          WHERE k.traceId = s.traceId AND k.parentSpanId = s.spanId), 0)) AS BIGINT) AS elapsed
FROM spans s GROUP BY s.name"""


def _bucket_case(value: str, bounds) -> str:
    arms = " ".join(f"WHEN {value} <= {b} THEN {i}" for i, b in enumerate(bounds))
    return f"CASE {arms} ELSE {len(bounds)} END"


def _explicit(bounds, by: str | None = None) -> str:
    rows = ", ".join(
        f"({i}, CAST({bounds[i] if i < len(bounds) else 'NULL'} AS DOUBLE))" for i in range(len(bounds) + 1)
    )
    group = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM events) CROSS JOIN " if by else ""
    match = f"AND x.{by} = g.{by}" if by else ""
    left = f"{groups}" if by else ""
    return f"""WITH x AS (SELECT {group}{_bucket_case('CAST(round(value * 3000) AS BIGINT)', bounds)} AS bucket FROM events),
b(bucket, upper_bound) AS (VALUES {rows}),
g AS (SELECT * FROM {left} b)
SELECT {f'g.{by}, ' if by else ''}CAST(g.bucket AS INTEGER) AS bucket, g.upper_bound, count(x.bucket) AS n
FROM g LEFT JOIN x ON x.bucket = g.bucket {match} GROUP BY ALL"""


_BOUNDS = (10, 50, 100, 200, 400)
_CHECKS = (
    # rule, selected, passes
    ("post-status", "event_id % 3 = 0", "event_type <> 'error'"),
    ("not-error", "event_id % 3 <> 0 AND kind = 2", "name <> 'error'"),
    ("purchase-k", "name = 'purchase'", "CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 10"),
    ("kind-low", "name = 'click'", "kind <= 4"),
    ("body-has-k", "name = 'view'", "contains(props, '\"k\": 7')"),
    ("user-known", "name = 'signup' AND event_id % 3 <> 0", "user_id > 0"),
)


def _conformance(by: str | None = None) -> str:
    keep, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    parts = [
        f"""SELECT {keep}'{rule}' AS rule_id, count(*) FILTER (WHERE {chosen}) AS matched,
  count(*) FILTER (WHERE {chosen} AND {passes}) AS passed,
  count(*) FILTER (WHERE {chosen}) = count(*) FILTER (WHERE {chosen} AND {passes}) AS ok FROM spans {group}"""
        for rule, chosen, passes in _CHECKS
    ] + [
        f"""SELECT {keep}'{rule}' AS rule_id, count(*) FILTER (WHERE name = '{name}') AS matched,
  count(*) FILTER (WHERE name = '{name}') AS passed, count(*) FILTER (WHERE name = '{name}') >= 1 AS ok
  FROM spans {group}"""
        for rule, name in (("signups-seen", "signup"), ("refunds-seen", "refund"))
    ]
    return f"WITH {SPANS} " + " UNION ALL ".join(parts)


ORACLE = {
    "spans_flatten": _SCALARS,
    "traces_json_ingest": _SCALARS,
    "logs_flatten": f"""WITH {SPANS}
SELECT service, 'lib-' || event_type AS scope_name, user_id AS "user", CAST(startNs AS VARCHAR) AS timeUnixNano,
       CAST(startNs + 1000 AS VARCHAR) AS observedTimeUnixNano, CAST(1 + event_id % 24 AS INTEGER) AS severityNumber,
       event_type AS severityText, CAST(event_id % 2 AS INTEGER) AS flags, traceId, spanId,
       'app.' || event_type AS eventName, CAST(json_extract_string(props, '$.k') AS BIGINT) AS body_k
FROM spans""",
    "metrics_flatten": """SELECT 'app.' || event_type AS name, CAST(CAST(ts AS DATE) AS VARCHAR) AS description, '1' AS unit,
       count(*) AS sum_value, max(CAST(round(value * 100) AS BIGINT)) AS gauge_value, true AS no_histogram,
       event_type AS service, '1' AS scope_version, 'events' AS source
FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    "metric_points": """WITH e AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       'app.' || event_type AS name FROM events),
shards AS (SELECT unnest([0, 1, 2]) AS i)
SELECT name, 'sum' AS kind, CAST(i AS BIGINT) AS point_no, day, CAST(count(*) FILTER (event_id % 3 = i) AS DOUBLE) AS value,
       NULL::BIGINT AS count, NULL::DOUBLE AS sum, NULL::VARCHAR AS bounds, NULL::VARCHAR AS buckets FROM e CROSS JOIN shards GROUP BY ALL
UNION ALL SELECT name, 'gauge', 0, day, max(cents) / 100, NULL, NULL, NULL, NULL FROM e GROUP BY ALL
UNION ALL SELECT name, 'histogram', 0, day, NULL, count(*), CAST(sum(cents) AS DOUBLE) / 100, '10.0,50.0',
       count(*) FILTER (cents <= 1000) || ',' || count(*) FILTER (cents > 1000 AND cents <= 5000) || ',' || count(*) FILTER (cents > 5000)
FROM e GROUP BY ALL""",
    "span_name_normalize": """SELECT CAST(event_id AS VARCHAR) AS spanId,
       CASE event_id % 3 WHEN 0 THEN 'GET /api/products/{productId}' WHEN 1 THEN '/cart' ELSE event_type END AS name
FROM events""",
    "span_attr": 'SELECT user_id AS "user", count(*) AS n FROM events GROUP BY user_id',
    "span_events": f"""WITH {SPANS} SELECT traceId, spanId, CAST(startNs AS VARCHAR) AS timeUnixNano,
       event_type AS event_name, props FROM spans""",
    "spans_tumble": f"""WITH {SPANS} SELECT traceId, spanId, eventTime, {_TEN} AS window_start,
       {_TEN} + INTERVAL '10 seconds' AS window_end FROM spans""",
    "throughput": f"""WITH {SPANS} SELECT count(*) AS throughput, {_TEN} AS "time" FROM spans
WHERE parentSpanId = '' GROUP BY 2""",
    "p95_latency": f'WITH {SPANS}, {_p95(_TEN)} SELECT latencyMs, "time" FROM p95',
    "p95_latency_daily": f'WITH {SPANS}, {_p95(_DAY)} SELECT latencyMs, "time" FROM p95',
    "operation_execution_time": f"WITH {SPANS} {_SELF}",
    "execution_time_by_operation": f"""WITH {SPANS}, o AS ({_SELF})
SELECT name, CAST(sum(elapsed) AS BIGINT) AS elapsed FROM o GROUP BY name""",
    "latency_histogram": f"""WITH {SPANS} SELECT elapsedTimeMillis AS bucket, count(*) AS n FROM spans
WHERE parentSpanId = '' AND eventTime {_IN_RANGE} GROUP BY 1""",
    "request_latencies": f"""WITH {SPANS} SELECT elapsedTimeMillis FROM spans
WHERE parentSpanId = '' AND eventTime {_IN_RANGE} ORDER BY eventTime DESC""",
    "requests_in_range": f"""WITH {SPANS} SELECT count(*) AS num_traces FROM spans
WHERE parentSpanId = '' AND eventTime {_IN_RANGE}""",
    "slowest_traces": f"""WITH {SPANS} SELECT traceId, name, elapsedTimeMillis FROM spans
WHERE parentSpanId = '' AND eventTime {_IN_RANGE} ORDER BY elapsedTimeMillis DESC, traceId, spanId LIMIT 6""",
    "throughput_series": f"""WITH {SPANS}, t AS (SELECT count(*) AS throughput, {_TEN} AS "time" FROM spans
WHERE parentSpanId = '' GROUP BY 2) SELECT throughput, "time" FROM t WHERE "time" {_IN_RANGE} ORDER BY "time" DESC""",
    "p95_series": f"""WITH {SPANS}, {_p95(_DAY)}
SELECT latencyMs, "time" FROM p95 WHERE "time" {_IN_RANGE} ORDER BY "time" DESC""",
    "sql_program": f"""WITH {SPANS}, o AS ({_SELF})
SELECT s.name, count(*) AS n, CAST(sum(s.elapsedTimeMillis) AS BIGINT) AS total_ms, max(s.eventTime) AS last_seen,
       max(o.elapsed) AS self_ms
FROM spans s JOIN o ON s.name = o.name WHERE s.parentSpanId = '' GROUP BY s.name""",
    "span_metrics": f"""WITH {SPANS}, b AS (SELECT *, {_bucket_case('elapsedTimeMillis', _BOUNDS)} AS bucket FROM spans)
SELECT service AS service_name, name AS span_name, kind AS span_kind,
       CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS http_method, count(*) AS calls,
       CAST(sum(elapsedTimeMillis) AS BIGINT) AS duration_sum,
       concat_ws(',', {', '.join(f'count(*) FILTER (WHERE bucket = {i})' for i in range(6))}) AS bucket_counts
FROM b GROUP BY 1, 2, 3, 4""",
    "explicit_histogram": _explicit(histogram.ADD_ITEM_BOUNDS),
    "explicit_histogram_by_type": _explicit(histogram.GET_CART_BOUNDS, "event_type"),
    "request_counter": """SELECT CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method,
       '/api/' || event_type AS target, CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS status,
       count(*) AS requests FROM events GROUP BY 1, 2, 3""",
    "trace_conformance": _conformance(),
    "trace_conformance_by_trace": _conformance("traceId"),
    "trace_rules": """WITH e AS (
  SELECT *, event_id % 3 = 0 AS posted, event_type = 'error' AS failed, CAST(props ->> '$.k' AS INTEGER) AS k,
         ['internal', 'server', 'client', 'producer', 'consumer'][1 + event_id % 5] AS kind FROM events),
picked AS (SELECT 'count-' || user_id % 10 || '-' || event_type AS rule_id, event_type, min(user_id) AS user_id FROM e GROUP BY 1, 2),
found AS (
  SELECT 'user-' || user_id AS rule_id, count(*) FILTER (posted) AS matched, count(*) FILTER (posted AND NOT failed) AS passed
  FROM e GROUP BY 1
  UNION ALL SELECT 'kind-' || event_type || '-' || kind, count(*), count(*) FILTER (k <= 8) FROM e GROUP BY 1
  UNION ALL SELECT 'all-errors', count(*), count(*) FROM e WHERE failed
  UNION ALL SELECT 'every-span', count(*), count(*) FROM e
  UNION ALL SELECT 'unknown', count(*), 0 FROM e WHERE event_type = 'click'),
counted AS (SELECT rule_id, count(*) AS matched FROM picked p JOIN e ON p.event_type = e.event_type AND p.user_id = e.user_id
            GROUP BY rule_id)
SELECT rule_id, CAST(matched AS BIGINT) AS matched, CAST(passed AS BIGINT) AS passed, matched = passed AS ok FROM found
UNION ALL SELECT rule_id, matched, CASE WHEN matched >= 12 THEN matched ELSE 0 END, matched >= 12 FROM counted
UNION ALL SELECT 'no-database', 0, 0, false""",
}

ORACLE["logs_json_ingest"] = ORACLE["logs_flatten"]
ORACLE["metrics_json_ingest"] = ORACLE["metrics_flatten"]

"""Telemetry and shop inputs derived from the test tables.

Everything is a lazy projection of a table, so inputs grow with the data. Requests carry one span, record
or metric each, which keeps the nesting a narrow step.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.schemas import SPAN, pick
from tracewell.session import checkpoint_path, configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    reader = spark.readStream.schema(schema)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(f"{sf_dir}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


#: Rows of a replayed file at most, so that many tasks write a micro-batch and read it.
FILE_ROWS = 250_000


def replay(
    spark: SparkSession, sf_dir: str, name: str, order: str, batches: int = 3, descending: bool = True, file_rows: int = FILE_ROWS
) -> DataFrame:
    """A table as a stream of several micro-batches by a whole-numbered column, the largest values first if ``descending``.

    The whole table is laid out anew, below the checkpoint root, one batch's files after the other's, so that their times
    give the order. A batch holds an equal part of the column's range. It is written by as many tasks as read the table;
    all have the same number of files, as a trigger takes a fixed number, so empty ones are added where fewer came out.
    """
    rows = table(spark, sf_dir, name)
    folder = checkpoint_path(spark, f"replay-{uuid.uuid4().hex}")
    low, high = rows.agg(F.min(order), F.max(order)).first()
    part = F.expr(f"({order} - {low}) * {batches} DIV ({high} - {low} + 1)") if low is not None else F.lit(0)
    by_task = rows.groupBy(part.alias("step"), F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    first = F.when(F.min("task") > 0, 1).otherwise(0)  # the first task leaves a file even if it has no row
    per_step = by_task.groupBy("step").agg((F.sum(F.ceil(F.col("n") / file_rows)) + first).alias("files"))
    files = max(1, per_step.agg(F.max("files")).first()[0] or 1)
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")
    there = place.getFileSystem(spark._jsc.hadoopConfiguration())
    steps = reversed(range(batches)) if descending else range(batches)
    for done, step in enumerate(steps, 1):
        rows.where(part == step).write.option("maxRecordsPerFile", file_rows).mode("append").parquet(folder)
        for _ in range(files * done - len(there.globStatus(place))):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(folder)
        if len(there.globStatus(place)) != files * done:
            raise RuntimeError(f"a step of {folder} has more than {files} files")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Events with span identity and nanosecond times; streamed in several batches, children before parents."""
    source = replay(spark, sf_dir, "events", "event_id") if streaming else table(spark, sf_dir, "events")
    return source.selectExpr(
        "*",
        "CAST(event_id DIV 4 AS STRING) AS traceId",
        "CAST(event_id AS STRING) AS spanId",
        """CASE WHEN event_id % 4 = 0 THEN ''
                WHEN event_id % 4 = 3 THEN CAST(event_id - 1 AS STRING)
                ELSE CAST(event_id - event_id % 4 AS STRING) END AS parentSpanId""",
        "unix_micros(CAST(ts AS TIMESTAMP)) * 1000 AS startNs",
        "CAST(round(value * 1000000) AS BIGINT) AS durationNs",
        "concat('svc', CAST((event_id DIV 4) % 7 AS STRING)) AS service",
    )


def _attr(key: str, field: str, value: str) -> str:
    return f"named_struct('key', '{key}', 'value', to_variant_object(named_struct('{field}', {value})))"


RESOURCE = f"named_struct('attributes', array({_attr('service.name', 'stringValue', 'service')}))"
SCOPE = (
    "named_struct('name', concat('lib-', event_type), 'version', '1', "
    f"'attributes', array({_attr('lang', 'stringValue', repr('sql'))}))"
)


def trace_root(fields: Iterable[str] | None = None, envelope: bool = True, name: str = "event_type") -> Column:
    """The request array of an event, holding the given span fields; ``name`` is the SQL of the span name.

    Queries unnest this expression directly. As a column it would be built twice, the second time by the
    emptiness filter the optimizer adds below a generator.
    """
    values = {
        "traceId": "traceId",
        "spanId": "spanId",
        "traceState": "''",
        "parentSpanId": "parentSpanId",
        "flags": "event_id % 2",
        "name": name,
        "kind": "CAST(1 + event_id % 5 AS INT)",
        "startTimeUnixNano": "CAST(startNs AS STRING)",
        "endTimeUnixNano": "CAST(startNs + durationNs AS STRING)",
        "attributes": f"""array({_attr('user', 'intValue', 'CAST(user_id AS STRING)')},
            {_attr('http.method', 'stringValue', "if(event_id % 3 = 0, 'POST', 'GET')")},
            {_attr('http.status_code', 'intValue', "if(event_type = 'error', '500', '200')")},
            {_attr('response.body', 'stringValue', 'props')})""",
        "events": f"""array(named_struct('timeUnixNano', CAST(startNs AS STRING), 'name', event_type,
            'attributes', array({_attr('props', 'stringValue', 'props')})))""",
    }
    chosen = pick(SPAN, fields).fieldNames()
    span = "named_struct(" + ", ".join(f"'{f}', {values[f]}" for f in chosen) + ")"
    scope, resource = (f"'scope', {SCOPE}, ", f"'resource', {RESOURCE}, ") if envelope else ("", "")
    return F.expr(
        f"""array(named_struct({resource}'scopeSpans', array(named_struct({scope}'spans', array({span})))))"""
    )


def trace_requests(spark: SparkSession, sf_dir: str, **shape) -> DataFrame:
    """Nested trace requests, one per event; ``shape`` as for :func:`trace_root`."""
    return events(spark, sf_dir).select(trace_root(**shape).alias("resourceSpans"))


def log_root() -> Column:
    """The request array of an event as a log record."""
    record = f"""named_struct(
        'attributes', array({_attr('user', 'intValue', 'CAST(user_id AS STRING)')}),
        'timeUnixNano', CAST(startNs AS STRING), 'observedTimeUnixNano', CAST(startNs + 1000 AS STRING),
        'severityNumber', CAST(1 + event_id % 24 AS INT), 'severityText', event_type,
        'flags', CAST(event_id % 2 AS INT), 'traceId', traceId, 'spanId', spanId,
        'eventName', concat('app.', event_type), 'body', parse_json(props))"""
    return F.expr(
        f"""array(named_struct('resource', {RESOURCE},
            'scopeLogs', array(named_struct('scope', {SCOPE}, 'logRecords', array({record})))))"""
    )


def metric_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per day and event type: a sum and a gauge with one data point each."""
    rows = (
        table(spark, sf_dir, "events")
        .selectExpr("event_type", "CAST(ts AS DATE) AS day", "CAST(round(value * 100) AS BIGINT) AS cents")
        .groupBy("event_type", "day")
        .agg(F.count(F.lit(1)).alias("n"), F.max("cents").alias("top"))
    )
    point = "to_variant_object(named_struct('dataPoints', array(named_struct('asInt', CAST({} AS STRING)))))"
    metric = f"""named_struct(
        'name', concat('app.', event_type), 'description', CAST(day AS STRING), 'unit', '1',
        'sum', {point.format('n')}, 'gauge', {point.format('top')},
        'summary', CAST(NULL AS VARIANT), 'histogram', CAST(NULL AS VARIANT),
        'exponentialHistogram', CAST(NULL AS VARIANT),
        'metadata', array({_attr('source', 'stringValue', repr('events'))}))"""
    resource = f"named_struct('attributes', array({_attr('service.name', 'stringValue', 'event_type')}))"
    return rows.selectExpr(
        f"""array(named_struct('resource', {resource},
            'scopeMetrics', array(named_struct('scope', {SCOPE}, 'metrics', array({metric}))))) AS resourceMetrics"""
    )


def point_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per day and event type: a sum of three points, a gauge of one, a histogram of one, and no summary."""
    shards, bounds = range(3), (10, 50)
    rows = (
        table(spark, sf_dir, "events")
        .selectExpr("*", "CAST(ts AS DATE) AS day", "CAST(round(value * 100) AS BIGINT) AS cents")
        .groupBy("event_type", "day")
        .agg(
            *(F.expr(f"count_if(event_id % 3 = {i})").alias(f"n_{i}") for i in shards),
            F.expr("max(cents) / 100D").alias("top"),
            F.expr("sum(cents) / 100D").alias("total"),
            F.expr(f"array(count_if(cents <= {bounds[0] * 100}), count_if(cents > {bounds[0] * 100} AND cents <= {bounds[1] * 100}), "
                   f"count_if(cents > {bounds[1] * 100}))").alias("buckets"),
        )
    )
    time = "'timeUnixNano', CAST(unix_date(day) * 86400000000000 AS STRING)"
    points = {
        "sum": ", ".join(f"named_struct({time}, 'asInt', CAST(n_{i} AS STRING))" for i in shards),
        "gauge": f"named_struct({time}, 'asDouble', top)",
        "histogram": f"""named_struct({time}, 'count', CAST(aggregate(buckets, 0L, (a, b) -> a + b) AS STRING), 'sum', total,
            'explicitBounds', array({', '.join(f'{b}D' for b in bounds)}), 'bucketCounts', transform(buckets, b -> CAST(b AS STRING)))""",
    }
    values = ", ".join(f"'{k}', to_variant_object(named_struct('dataPoints', array({v})))" for k, v in points.items())
    metric = f"named_struct('name', concat('app.', event_type), 'unit', '1', {values}, 'summary', CAST(NULL AS VARIANT))"
    return rows.selectExpr(f"array(named_struct('scopeMetrics', array(named_struct('metrics', array({metric}))))) AS resourceMetrics")


# Shop inputs -------------------------------------------------------------------------------------


def items(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Order lines with the currency of their order; streamed by order in three batches, the smallest keys first."""
    source = replay(spark, sf_dir, "lineitem", "l_orderkey", descending=False) if streaming else table(spark, sf_dir, "lineitem")
    return source.selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        """CASE l_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'JPY'
           WHEN 3 THEN 'GBP' ELSE 'EUR' END AS user_currency""",
    )


def _varint(n: str) -> str:
    """SQL of a whole number from 0 to 2^62 as wire bytes in hex, seven bits a byte, the lowest first."""
    parts = f"sequence(0, if({n} = 0, 0, CAST(floor(log2({n})) AS INT) DIV 7))"
    byte = f"(shiftright({n}, 7 * i) & 127) | if(shiftright({n}, 7 * (i + 1)) > 0, 128, 0)"
    return f"array_join(transform({parts}, i -> lpad(hex({byte}), 2, '0')), '')"


def _field(number: int, hexed: str) -> str:
    """SQL of a field of under 128 bytes, given in hex."""
    return f"concat('{8 * number + 2:02X}', lpad(hex(length({hexed}) DIV 2), 2, '0'), {hexed})"


def order_payloads(orders: DataFrame) -> DataFrame:
    """Orders as binary messages of one item, with a field that readers don't know; every ninth lacks its last byte."""
    number = lambda n, value: f"concat('{8 * n:02X}', {_varint(f'CAST({value} AS BIGINT)')})"
    cost = f"concat({_field(1, "hex('USD')")}, {number(2, 'floor(o_totalprice)')}, {number(3, 'o_orderkey % 1000 * 1000000')})"
    item = f"concat({_field(1, 'hex(CAST(o_custkey AS STRING))')}, {number(2, '1 + o_orderkey % 300')})"
    parts = [
        _field(1, "hex(CAST(o_orderkey AS STRING))"),
        _field(2, "hex(o_orderpriority)"),
        _field(3, "cost"),
        number(14, "o_orderkey"),
        _field(5, "line"),
    ]
    made = orders.selectExpr("*", f"{cost} AS cost", f"{item} AS item").selectExpr("*", f"{_field(1, 'item')} AS line")
    made = made.selectExpr("o_orderkey", f"unhex(concat({', '.join(parts)})) AS whole")
    return made.selectExpr("if(o_orderkey % 9 = 0, left(whole, length(whole) - 1), whole) AS value")


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog files as JSON text."""
    cents = "CAST(round(p_retailprice * 100) AS BIGINT)"
    return table(spark, sf_dir, "part").selectExpr(
        f"""to_json(named_struct('products', array(named_struct(
            'id', CAST(p_partkey AS STRING), 'name', p_name, 'description', concat(p_brand, ' ', p_type),
            'picture', concat(p_name, '.jpg'),
            'priceUsd', named_struct('currencyCode', 'USD', 'units', {cents} DIV 100,
                                     'nanos', CAST({cents} % 100 * 10000000 AS INT)),
            'categories', array(lower(p_type), 'parts'))))) AS value"""
    )


def products(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    cents = "CAST(round(p_retailprice * 100) AS BIGINT)"
    return (
        table(spark, sf_dir, "part")
        .where(where)
        .selectExpr(
            "CAST(p_partkey AS STRING) AS id",
            "p_name AS name",
            "concat(p_brand, ' ', p_type) AS description",
            f"""named_struct('currency_code', 'USD', 'units', {cents} DIV 100,
                             'nanos', CAST({cents} % 100 * 10000000 AS INT)) AS price_usd""",
        )
    )


def cart_writes(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Cart writes; streamed in several batches, the latest writes first."""
    source = replay(spark, sf_dir, "events", "event_id", batches=4) if streaming else table(spark, sf_dir, "events")
    return (
        source
        .selectExpr(
            "CAST(user_id AS STRING) AS user_id",
            "CAST(event_id % 7 AS STRING) AS product_id",
            "1 + event_id % 3 AS quantity",
            "if(event_type = 'purchase', 'empty', 'add') AS kind",
            "CAST(ts AS TIMESTAMP) AS event_time",
            "event_id AS seq",
        )
    )


def charge_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        """named_struct('currency_code', if(o_orderkey % 4 = 0, 'CAD', 'USD'),
                        'units', CAST(floor(o_totalprice) AS BIGINT), 'nanos', 0) AS amount""",
        """CASE o_orderkey % 6 WHEN 0 THEN '4432-8015-6152-0454' WHEN 1 THEN '3714 496353 98431'
           WHEN 2 THEN '0000-0000-0000-0000' WHEN 3 THEN '4432-8015-6152-0455'
           WHEN 4 THEN '5555-5555-5555-4444' ELSE '6011-1111-1111-1117' END AS credit_card_number""",
        "if((o_orderkey DIV 6) % 3 = 0, 2021, 2039) AS expiration_year",
        "CAST(1 + o_orderkey % 12 AS INT) AS expiration_month",
        "o_orderkey % 11 = 0 AS synthetic",
    )


def recommendation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each asks for two list entries, the second holding two ids."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS request_id",
        """array(CAST(user_id AS STRING),
                 concat(CAST(event_id % 100 AS STRING), ',', CAST(event_id % 37 AS STRING))) AS product_ids""",
    )


def ad_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS request_id",
        """CASE event_id % 5 WHEN 0 THEN array('binoculars') WHEN 1 THEN array('accessories', 'travel')
           WHEN 2 THEN array('books') WHEN 3 THEN CAST(array() AS ARRAY<STRING>)
           ELSE array('telescopes', 'telescopes') END AS context_keys""",
    )

"""Declared input types. Schemas are always passed to readers; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE, VARIANT = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.VariantType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def pick(declared: T.StructType, names: Iterable[str] | None) -> T.StructType:
    """The declared type cut down to some of its fields, in declared order."""
    if names is None:
        return declared
    wanted = set(names)
    unknown = wanted - set(declared.fieldNames())
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return T.StructType([f for f in declared.fields if f.name in wanted])


KEY_VALUE = struct(key=STRING, value=VARIANT)
ATTRIBUTES = T.ArrayType(KEY_VALUE)

# Nanosecond epochs travel as text because JSON has no unsigned 64-bit number.
EVENT = struct(timeUnixNano=STRING, name=STRING, attributes=ATTRIBUTES)

SPAN = struct(
    traceId=STRING,
    spanId=STRING,
    traceState=STRING,
    parentSpanId=STRING,
    flags=LONG,
    name=STRING,
    kind=INT,
    startTimeUnixNano=STRING,
    endTimeUnixNano=STRING,
    attributes=ATTRIBUTES,
    events=T.ArrayType(EVENT),
)

METRIC = struct(
    name=STRING,
    description=STRING,
    unit=STRING,
    sum=VARIANT,
    gauge=VARIANT,
    summary=VARIANT,
    histogram=VARIANT,
    exponentialHistogram=VARIANT,
    metadata=ATTRIBUTES,
)

LOG_RECORD = struct(
    attributes=ATTRIBUTES,
    timeUnixNano=STRING,
    observedTimeUnixNano=STRING,
    severityNumber=INT,
    severityText=STRING,
    flags=INT,
    traceId=STRING,
    spanId=STRING,
    eventName=STRING,
    body=VARIANT,
)

SCOPE = struct(name=STRING, version=STRING, attributes=ATTRIBUTES)
RESOURCE = struct(attributes=ATTRIBUTES)


def _requests(root: str, scopes: str, leaves: str, leaf: T.StructType, envelope: bool) -> T.StructType:
    in_scope, in_resource = {leaves: T.ArrayType(leaf)}, {}
    if envelope:
        in_scope, in_resource = {"scope": SCOPE, **in_scope}, {"resource": RESOURCE}
    return struct(**{root: T.ArrayType(struct(**in_resource, **{scopes: T.ArrayType(struct(**in_scope))}))})


def trace_requests(span_fields: Iterable[str] | None = None, envelope: bool = True) -> T.StructType:
    """One row per exporter request.

    Column pruning does not reach through the unnesting of arrays, so a job names what it reads:
    ``span_fields`` narrows the spans and ``envelope=False`` leaves out resource and scope.
    """
    return _requests("resourceSpans", "scopeSpans", "spans", pick(SPAN, span_fields), envelope)


def log_requests(record_fields: Iterable[str] | None = None, envelope: bool = True) -> T.StructType:
    return _requests("resourceLogs", "scopeLogs", "logRecords", pick(LOG_RECORD, record_fields), envelope)


def metric_requests(metric_fields: Iterable[str] | None = None, envelope: bool = True) -> T.StructType:
    return _requests("resourceMetrics", "scopeMetrics", "metrics", pick(METRIC, metric_fields), envelope)


MONEY = struct(currency_code=STRING, units=LONG, nanos=INT)

# Catalog files use camelCase names on disk.
CATALOG_MONEY = struct(currencyCode=STRING, units=LONG, nanos=INT)
CATALOG_PRODUCT = struct(
    id=STRING,
    name=STRING,
    description=STRING,
    picture=STRING,
    priceUsd=CATALOG_MONEY,
    categories=T.ArrayType(STRING),
)
CATALOG_FILE = struct(products=T.ArrayType(CATALOG_PRODUCT))

ADDRESS = struct(street_address=STRING, city=STRING, state=STRING, country=STRING, zip_code=STRING)
CART_ITEM = struct(product_id=STRING, quantity=INT)
ORDER_ITEM = struct(item=CART_ITEM, cost=MONEY)
ORDER = struct(
    order_id=STRING,
    shipping_tracking_id=STRING,
    shipping_cost=MONEY,
    shipping_address=ADDRESS,
    items=T.ArrayType(ORDER_ITEM),
)

CART_EVENT = struct(
    user_id=STRING,
    product_id=STRING,
    quantity=LONG,
    kind=STRING,
    event_time=T.TimestampType(),
    seq=LONG,
)

"""Exporter requests: one JSON document per line, read with a declared schema.

Unknown JSON keys are ignored and a malformed line yields an all-NULL row, which the flattening drops.
The ``fields`` arguments narrow the schema, so the parser only materializes what a job needs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewell import schemas


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str, stream: bool, options: dict) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).format(fmt).options(**options).load(path)


def traces(
    spark: SparkSession,
    path: str,
    fields: Iterable[str] | None = None,
    envelope: bool = True,
    fmt: str = "json",
    stream: bool = False,
    **options: str,
) -> DataFrame:
    return _read(spark, path, schemas.trace_requests(fields, envelope), fmt, stream, options)


def logs(
    spark: SparkSession,
    path: str,
    fields: Iterable[str] | None = None,
    envelope: bool = True,
    fmt: str = "json",
    stream: bool = False,
    **options: str,
) -> DataFrame:
    return _read(spark, path, schemas.log_requests(fields, envelope), fmt, stream, options)


def metrics(
    spark: SparkSession,
    path: str,
    fields: Iterable[str] | None = None,
    envelope: bool = True,
    fmt: str = "json",
    stream: bool = False,
    **options: str,
) -> DataFrame:
    return _read(spark, path, schemas.metric_requests(fields, envelope), fmt, stream, options)


def payload(column: str, schema: StructType) -> Column:
    """The request array of a JSON text column, e.g. message payloads.

    Hand it to the flattening as its root: parsing inside the generator happens once per row, while a
    parsed column would be evaluated again by the emptiness filter the optimizer adds.
    """
    return F.from_json(column, schema)[schema.fieldNames()[0]]

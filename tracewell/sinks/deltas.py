"""Logs of rows, one folder per micro-batch.

A batch overwrites its own folder, so a replay after a failure changes nothing. Readers see finished batches.
Logs whose rows add up are kept by :mod:`tracewell.sinks.levels`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from tracewell.sinks import tables

BATCH = "batch_id"


def write(df: DataFrame, store: str, name: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{tables.path(store, name)}/{BATCH}={batch_id}")


def read(spark: SparkSession, store: str, name: str, schema: StructType | None = None) -> DataFrame:
    """All finished batches of a log, with their ``batch_id``. ``schema`` is that of the written rows; with it a log
    none of whose batches holds a row can be read too."""
    folder = tables.path(store, name)
    return _folders(spark, folder, BATCH, _numbered(spark, folder, BATCH), schema)


def _folders(spark: SparkSession, folder: str, key: str, numbers: list[int], schema: StructType | None) -> DataFrame:
    if schema is not None:
        schema = StructType([*(f for f in schema.fields if f.name != BATCH), StructField(BATCH, IntegerType())])
        if not numbers:
            return spark.createDataFrame([], schema)
    elif not numbers:
        raise FileNotFoundError(f"{folder} has no finished batch")
    reader = spark.read.option("basePath", folder)
    return (reader if schema is None else reader.schema(schema)).parquet(*(f"{folder}/{key}={n}" for n in numbers))


def _numbered(spark: SparkSession, folder: str, key: str) -> list[int]:
    """Numbers ``n`` of the finished ``key=n`` folders, found by one listing of the store's own file system."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{key}=*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or ())


def batch(spark: SparkSession, store: str, name: str, batch_id: int) -> DataFrame | None:
    """The rows of one finished batch, found without listing the others; None if there is none."""
    folder = tables.path(store, name)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{BATCH}={batch_id}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    return spark.read.parquet(f"{folder}/{BATCH}={batch_id}")


def forget(spark: SparkSession, store: str, name: str, batch_id: int) -> None:
    """Delete one batch, which may be gone already."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.path(store, name)}/{BATCH}={batch_id}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

"""Maintained tables as parquet below one store folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_DATE = "event_date"


def path(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/{name}"


def with_date(spans: DataFrame) -> DataFrame:
    """Add the partition column that lets a time range skip files."""
    return spans.withColumn(EVENT_DATE, F.col("eventTime").cast("date"))


def with_log_date(logs: DataFrame) -> DataFrame:
    """Add the partition column of log records; records without a time lie in one folder."""
    seconds = (F.col("timeUnixNano").try_cast("bigint") / F.lit(1_000_000_000)).cast("bigint")
    return logs.withColumn(EVENT_DATE, F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int")))


def exists(spark: SparkSession, store: str, name: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path(store, name)}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write(
    df: DataFrame, store: str, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path(store, name))


def read(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.parquet(path(store, name))


def in_dates(spans: DataFrame, time_from: Column, time_to: Column) -> DataFrame:
    """Restrict a dated table to the dates of a time range, so that other folders are not read."""
    if EVENT_DATE not in spans.columns:
        return spans
    return spans.where(F.col(EVENT_DATE).between(time_from.cast("date"), time_to.cast("date")))

"""The order stream: message payloads, and their parsing.

Payloads are JSON text or binary messages. A broker is read with the ``kafka`` format where its package is installed; a
folder of files replays the same messages, JSON one per line, binary ones in a column of Parquet files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import schemas
from tracewell.sources import wire

TOPIC = "orders"
CORRUPT = "_corrupt"
PARSED = T.StructType([*schemas.ORDER.fields, T.StructField(CORRUPT, T.StringType())])


def from_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def from_broker(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "earliest", binary: bool = False, **options: str
) -> DataFrame:
    """Messages of a topic, as text unless ``binary``. ``starting`` only applies to a group without progress."""
    value = F.col("value") if binary else F.col("value").cast("string").alias("value")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select(value, "partition", "offset")
    )


def parse(messages: DataFrame) -> DataFrame:
    """Add ``order``; it is NULL where the payload is no order. Binary payloads are read as messages, others as JSON."""
    if isinstance(messages.schema["value"].dataType, T.BinaryType):
        return messages.withColumn("order", wire.decoded(F.col("value"), schemas.ORDER))
    parsed = F.from_json("value", PARSED, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.withColumn("_parsed", parsed).withColumn(
        "order", F.when(_is_valid(F.col("_parsed")), F.col("_parsed").dropFields(CORRUPT))
    ).drop("_parsed")


def _is_valid(parsed: Column) -> Column:
    return parsed.isNotNull() & parsed[CORRUPT].isNull()


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("order").isNotNull()).select("order.*")


def unparsable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("order").isNull()).select("value")

"""Global sequence numbers without a single-task sort.

Rows are grouped into blocks of the ordering key. Rows are numbered inside their block, block sizes are
turned into offsets, and blocks of blocks keep the offset computation itself spread out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def running_count(df: DataFrame, position: str, name: str = "running_count", block: int = BLOCK) -> DataFrame:
    """``count(*) over (order by position)`` for an integer position such as a log offset.

    Offsets are unique, so a block holds at most ``block`` rows. The only unpartitioned window runs
    over one row per ``block * block`` offsets. Rows without a position come first, as in SQL; rows that share
    a position get consecutive counts in any order.
    """
    size = F.lit(block).cast("bigint")
    nulls = F.lit(-(1 << 62)).cast("bigint")  # they come first
    blocked = df.withColumn("_block", F.coalesce(F.floor(F.col(position) / size).cast("bigint"), nulls))
    sizes = (
        blocked.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_super", F.floor(F.col("_block") / size).cast("bigint"))
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    in_super = before(Window.partitionBy("_super").orderBy("_block"))
    supers = sizes.groupBy("_super").agg(F.sum("_rows").alias("_super_rows"))
    super_offsets = supers.select(
        F.col("_super").alias("_super_key"),
        F.coalesce(F.sum("_super_rows").over(before(Window.orderBy("_super"))), zero).alias("_super_offset"),
    )
    block_offsets = (
        sizes.withColumn("_in_super", F.coalesce(F.sum("_rows").over(in_super), zero))
        .join(super_offsets, F.col("_super") == F.col("_super_key"))
        .select(F.col("_block").alias("_block_key"), (F.col("_in_super") + F.col("_super_offset")).alias("_offset"))
    )
    numbered = blocked.withColumn("_row", F.row_number().over(Window.partitionBy("_block").orderBy(position)))
    return (
        numbered.join(block_offsets, F.col("_block") == F.col("_block_key"))
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_block", "_row", "_block_key", "_offset")
    )


def shuffled_positions(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """A fixed pseudo-random permutation: dense zero-based positions in md5 order of a unique key.

    The first four hex digits of the hash make 65 536 even blocks, which bounds the offset table.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_block", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int")
    )
    sizes = hashed.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_block").alias("_block_key"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint")).alias("_offset"),
    )
    in_block = Window.partitionBy("_block").orderBy("_hash", key)
    return (
        hashed.withColumn("_row", F.row_number().over(in_block))
        .join(offsets, F.col("_block") == F.col("_block_key"))
        .withColumn(name, F.col("_offset") + F.col("_row") - F.lit(1))
        .drop("_hash", "_block", "_row", "_block_key", "_offset")
    )

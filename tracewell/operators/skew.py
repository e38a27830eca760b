"""Joins against one-row-per-key tables when the other side may have a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def salted_join(
    rows: DataFrame, per_key: DataFrame, key: str, spread: str, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` to ``per_key`` (unique on ``key``), spreading each key over ``salts`` partitions.

    ``per_key`` is repeated once per salt; it is an aggregate and far smaller than ``rows``. The salt
    also puts both shuffles right below the join, where adaptive execution can split what is still
    skewed. ``spread`` names a column of ``rows`` that varies within a key.
    """
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(repeated, [key, "_salt"], how).drop("_salt")

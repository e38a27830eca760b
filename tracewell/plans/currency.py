"""Currency conversion through the euro."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import money


def _attach(df: DataFrame, rates: DataFrame, code: Column, name: str) -> DataFrame:
    """Left-join one rate. No hint: Spark broadcasts the rates because their known size is small."""
    side = rates.select(F.col("currency_code").alias(f"{name}_code"), F.col("rate").alias(name))
    return df.join(side, code == F.col(f"{name}_code"), "left").drop(f"{name}_code")


def with_converted(df: DataFrame, rates: DataFrame, amount: Column, to_code: Column, name: str) -> DataFrame:
    """Add ``name``: ``amount`` in ``to_code``, truncated to nanos; NULL when a currency is unknown."""
    found = _attach(_attach(df, rates, amount["currency_code"], "_from_rate"), rates, to_code, "_to_rate")
    value = money.as_double(amount) / F.col("_from_rate") * F.col("_to_rate")
    converted = F.when(
        F.col("_from_rate").isNotNull() & F.col("_to_rate").isNotNull(), money.from_double(to_code, value)
    )
    return found.withColumn(name, converted).drop("_from_rate", "_to_rate")


def convert(df: DataFrame, rates: DataFrame, amount: str = "amount", to_code: str = "to_code") -> DataFrame:
    """Rows with both currencies known, with the ``converted`` money."""
    done = with_converted(df, rates, F.col(amount), F.col(to_code), "converted")
    return done.where(F.col("converted").isNotNull())


def rejects(df: DataFrame, rates: DataFrame, amount: str = "amount", to_code: str = "to_code") -> DataFrame:
    """Rows :func:`convert` leaves out."""
    done = with_converted(df, rates, F.col(amount), F.col(to_code), "converted")
    return done.where(F.col("converted").isNull()).drop("converted")


def localized(df: DataFrame, rates: DataFrame, price: str, to_code: Column, name: str) -> DataFrame:
    """Page price: unchanged when the target is empty or dollars, converted otherwise."""
    keep = F.coalesce(to_code, F.lit("")).isin("", "USD")
    done = with_converted(df, rates, F.col(price), to_code, "_converted")
    return done.withColumn(name, F.when(keep, F.col(price)).otherwise(F.col("_converted"))).drop("_converted")

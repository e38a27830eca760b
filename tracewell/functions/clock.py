"""Integer time arithmetic on nanosecond epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAD_RECORD_MODES = ("fail", "null")


def _int_div(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor).cast("bigint"))


def nanos_to_seconds(nanos: Column) -> Column:
    """Whole seconds, truncated toward zero."""
    return _int_div(nanos, 1_000_000_000)


def nanos_to_millis(nanos: Column) -> Column:
    return _int_div(nanos, 1_000_000)


def text_to_bigint(text: Column, on_bad_record: str = "fail") -> Column:
    """Epoch text to BIGINT; blanks around the digits are ignored.

    ``fail`` raises on malformed text, ``null`` turns it into NULL.
    """
    if on_bad_record not in BAD_RECORD_MODES:
        raise ValueError(f"on_bad_record must be one of {BAD_RECORD_MODES}")
    return text.cast("bigint") if on_bad_record == "fail" else text.try_cast("bigint")


def timestamp_from_nanos(nanos: Column) -> Column:
    """Zone-less timestamp of the whole second; the sub-second part is discarded."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.expr("INTERVAL '1' SECOND") * nanos_to_seconds(nanos)

"""Fixed-point money: ``struct<currency_code, units, nanos>`` with whole units and billionths.

Totals are exact in ``DECIMAL(38,0)`` billionths and split back, so the sign of units and nanos always
agrees in a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_UNIT = 1_000_000_000
INVALID = "invalid_value"
MISMATCH = "mismatching_currency"


def money(currency: Column | str, units: Column, nanos: Column) -> Column:
    code = F.lit(currency) if isinstance(currency, str) else currency
    return F.struct(
        code.alias("currency_code"), units.cast("bigint").alias("units"), nanos.cast("int").alias("nanos")
    )


def from_cents(currency: Column | str, cents: Column) -> Column:
    """Money from a whole number of hundredths; the sign goes to both parts."""
    hundred = F.lit(100).cast("bigint")
    return money(currency, F.call_function("div", cents, hundred), (cents % hundred) * F.lit(10_000_000))


def is_valid(m: Column) -> Column:
    units, nanos = m["units"], m["nanos"]
    signs_agree = (nanos == 0) | (units == 0) | ((nanos < 0) == (units < 0))
    return signs_agree & nanos.between(-(NANOS_PER_UNIT - 1), NANOS_PER_UNIT - 1)


def is_zero(m: Column) -> Column:
    return (m["units"] == 0) & (m["nanos"] == 0)


def is_positive(m: Column) -> Column:
    """Valid with positive units, or no units and positive nanos (whatever their range)."""
    return (is_valid(m) & (m["units"] > 0)) | ((m["units"] == 0) & (m["nanos"] > 0))


def is_negative(m: Column) -> Column:
    return (is_valid(m) & (m["units"] < 0)) | ((m["units"] == 0) & (m["nanos"] < 0))


def same_currency(left: Column, right: Column) -> Column:
    """Equal and non-empty currency codes."""
    return (left["currency_code"] == right["currency_code"]) & (left["currency_code"] != "")


def equal(left: Column, right: Column) -> Column:
    return (
        (left["currency_code"] == right["currency_code"])
        & (left["units"] == right["units"])
        & (left["nanos"] == right["nanos"])
    )


def negate(m: Column) -> Column:
    return money(m["currency_code"], -m["units"], -m["nanos"])


def to_nanos(m: Column) -> Column:
    """Total billionths. Two decimals of known width multiply and add without overflow checks on rows."""
    units = m["units"].cast("decimal(19,0)") * F.lit(NANOS_PER_UNIT).cast("decimal(10,0)")
    return units + m["nanos"].cast("decimal(10,0)")


def from_nanos(currency: Column | str, total: Column) -> Column:
    per_unit = F.lit(NANOS_PER_UNIT).cast("decimal(10,0)")
    return money(currency, F.call_function("div", total, per_unit), total % per_unit)


def add(left: Column, right: Column) -> Column:
    """``struct<value, error>`` of a pairwise sum. An invalid operand is reported before a currency
    mismatch; an error comes with empty money."""
    error = F.when(~is_valid(left) | ~is_valid(right), F.lit(INVALID)).when(
        left["currency_code"] != right["currency_code"], F.lit(MISMATCH)
    )
    empty = money("", F.lit(0), F.lit(0))
    total = from_nanos(left["currency_code"], to_nanos(left) + to_nanos(right))
    return F.struct(F.when(error.isNull(), total).otherwise(empty).alias("value"), error.alias("error"))


def pieces(quantity: Column) -> Column:
    """The factor of a price. Quantities below one count as one."""
    return F.greatest(quantity.cast("bigint"), F.lit(1).cast("bigint"))


def times(m: Column, quantity: Column) -> Column:
    """Total billionths of ``quantity`` pieces."""
    return to_nanos(m) * pieces(quantity).cast("decimal(10,0)")


def sums(m: Column, quantity: Column | None = None) -> tuple[Column, Column]:
    """Aggregates ``(units, nanos)`` of a sum, to be combined by :func:`total`.

    Units stay 64-bit, as the result must; nanos of many rows may exceed that and are summed as
    decimals. This costs one decimal addition per row instead of a chain of decimal operations.
    """
    factor = F.lit(1).cast("bigint") if quantity is None else pieces(quantity)
    return F.sum(m["units"] * factor), F.sum((m["nanos"].cast("bigint") * factor).cast("decimal(19,0)"))


def total(units: Column, nanos: Column) -> Column:
    """Total billionths of summed units and nanos."""
    return units.cast("decimal(19,0)") * F.lit(NANOS_PER_UNIT).cast("decimal(10,0)") + nanos


def as_double(m: Column) -> Column:
    return m["units"].cast("double") + m["nanos"].cast("double") / F.lit(1e9)


def display(m: Column) -> Column:
    """Two-digit number for charts and pages."""
    return F.round(as_double(m), 2)


def from_double(currency: Column | str, value: Column) -> Column:
    """Truncating split of a double into units and nanos."""
    units = value.cast("bigint")
    return money(currency, units, ((value - units.cast("double")) * F.lit(1e9)).cast("int"))

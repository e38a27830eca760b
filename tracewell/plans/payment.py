"""Card checks over a table of charge requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import text
from tracewell.operators import counters

# Digit patterns of the card brands; ``decide`` takes others.
BRANDS = {
    "visa": r"^4(\d{12}|\d{15}|\d{18})$",
    "mastercard": r"^(5[1-5]\d{14}|2(22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12})$",
    "amex": r"^3[47]\d{13}$",
    "discover": r"^6(011|4[4-9]\d|5\d\d)\d{12}$",
    "diners": r"^3(0[0-5]|[689]\d)\d{11}$",
    "jcb": r"^35(2[89]|[3-8]\d)\d{12}$",
    "unionpay": r"^62\d{14,17}$",
}
ACCEPTED_BRANDS = ("visa", "mastercard")

INVALID, BRAND, EXPIRED, ACCEPTED = "invalid", "brand_not_accepted", "expired", "accepted"


def digits(card_number: Column) -> Column:
    """The number without blanks and dashes."""
    return F.regexp_replace(card_number, r"[\s-]", "")


def card_type(number: Column, brands: dict[str, str] | None = None) -> Column:
    found = None
    for brand, pattern in (brands or BRANDS).items():
        condition = number.rlike(pattern)
        found = F.when(condition, F.lit(brand)) if found is None else found.when(condition, F.lit(brand))
    return found


def decide(
    requests: DataFrame,
    as_of: date | Column | None = None,
    brands: dict[str, str] | None = None,
    accepted: Sequence[str] = ACCEPTED_BRANDS,
) -> DataFrame:
    """Add ``card_type``, ``decision``, ``message`` and ``charged``.

    Checks run in order: the number must have a known brand and a right check digit, the brand must be
    accepted, the card must not have expired before the month of ``as_of``. Synthetic requests are
    accepted but not charged. ``brands`` maps brand names to digit patterns, ``accepted`` names those taken.
    """
    moment = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    number = digits(F.col("credit_card_number"))
    brand = card_type(number, brands)
    valid = F.coalesce(brand.isNotNull() & F.call_function("luhn_check", number), F.lit(False))
    today = F.year(moment) * F.lit(12) + F.month(moment)
    expiry = F.col("expiration_year") * F.lit(12) + F.col("expiration_month")
    decision = (
        F.when(~valid, F.lit(INVALID))
        .when(~brand.isin(*accepted), F.lit(BRAND))
        .when(today > expiry, F.lit(EXPIRED))
        .otherwise(F.lit(ACCEPTED))
    )
    # The error texts.
    message = (
        F.when(F.col("decision") == INVALID, F.lit("Credit card info is invalid."))
        .when(
            F.col("decision") == BRAND,
            F.concat(
                F.lit("Sorry, we cannot process "),
                F.col("card_type"),
                F.lit(" credit cards. Only VISA or MasterCard is accepted."),
            ),
        )
        .when(
            F.col("decision") == EXPIRED,
            F.concat(
                F.lit("The credit card (ending "),
                text.last_four(F.col("credit_card_number")),
                F.lit(") expired on "),
                F.concat_ws("/", F.col("expiration_month").cast("string"), F.col("expiration_year").cast("string")),
                F.lit("."),
            ),
        )
    )
    synthetic = F.col("synthetic") if "synthetic" in requests.columns else F.lit(False)
    decided = requests.withColumns({"card_type": brand, "decision": decision})
    return decided.withColumns(
        {
            "message": message,
            "charged": (F.col("decision") == ACCEPTED) & ~F.coalesce(synthetic, F.lit(False)),
        }
    )


def transactions_by_currency(decided: DataFrame) -> DataFrame:
    """Completed transactions per currency."""
    done = decided.where(F.col("decision") == ACCEPTED)
    return counters.counter(done.select(F.col("amount.currency_code").alias("currency")), ["currency"], name="payments")

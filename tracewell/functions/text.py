"""String rules for span names, request targets, search and card digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The route whose names are collapsed, and the collapsed name.
PRODUCT_ROUTE_PREFIX = "GET /api/products/"
PRODUCT_ROUTE_NAME = "GET /api/products/{productId}"


def normalize_span_name(name: Column) -> Column:
    """Drop the query string, then collapse product routes. ``*`` in the route glob spans any text."""
    bare = F.regexp_replace(name, r"\?.*", "")
    return F.when(bare.startswith(PRODUCT_ROUTE_PREFIX), F.lit(PRODUCT_ROUTE_NAME)).otherwise(bare)


def request_target(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def contains_ignoring_case(haystack: Column, needle: str) -> Column:
    """Literal substring test; ``%`` and ``_`` have no meaning."""
    return F.contains(F.lower(haystack), F.lower(F.lit(needle)))


def last_four(card_number: Column) -> Column:
    return F.right(card_number, F.lit(4))


def unit_hash(*parts: Column, seed: str = "") -> Column:
    """A 32-bit number from md5, equal on every engine; stands in for a random draw."""
    text = F.concat_ws("|", *(p.cast("string") for p in parts), F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

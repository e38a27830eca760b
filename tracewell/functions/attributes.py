"""Lookup in key/value attribute arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wrapper fields of an attribute value, by the scalar type they carry.
SCALAR_FIELDS = ("stringValue", "intValue", "doubleValue", "boolValue")


def attribute(attributes: Column, key: str) -> Column:
    """The VARIANT stored under ``key``, NULL when absent; the first entry wins on duplicates."""
    matches = F.filter(attributes, lambda a: a["key"] == F.lit(key))
    return F.get(matches, 0)["value"]


def attribute_as(attributes: Column, key: str, field: str, dtype: str) -> Column:
    """One wrapped scalar of an attribute, e.g. ``intValue`` as ``bigint``."""
    return F.try_variant_get(attribute(attributes, key), f"$.{field}", dtype)


def attribute_text(attributes: Column, key: str) -> Column:
    """The attribute as text whatever its scalar type. VARIANT cannot be grouped or joined on."""
    matches = F.filter(attributes, lambda a: a["key"] == F.lit(key))
    # only matching entries are unwrapped, and the array is searched once
    texts = F.transform(
        matches, lambda a: F.coalesce(*(F.try_variant_get(a["value"], f"$.{f}", "string") for f in SCALAR_FIELDS))
    )
    return F.get(texts, 0)

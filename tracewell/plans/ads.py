"""Ad selection by context keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions import text
from tracewell.operators import counters, numbering

MAX_RANDOM = 2
TARGETED, NOT_TARGETED, RANDOM = "TARGETED", "NOT_TARGETED", "RANDOM"


def select(requests: DataFrame, ads: DataFrame, seed: str = "") -> DataFrame:
    """Ads per request ``(request_id, context_keys)``:
    ``(request_id, request_type, response_type, redirect_url, text)``.

    Every key brings all ads of its category, duplicates kept. A request without keys, or whose keys
    match nothing, gets two ads drawn by hash, possibly the same one twice. Ads are a hand-kept list, so
    matching is decided against the set of their categories and the requests need no anti-join.
    """
    keyed = F.coalesce(F.size("context_keys"), F.lit(0)) > 0
    categories = ads.agg(F.collect_set("category")).scalar()
    matched = F.coalesce(F.arrays_overlap(F.col("context_keys"), categories), F.lit(False))
    typed = requests.select(
        "request_id",
        "context_keys",
        F.when(keyed, F.lit(TARGETED)).otherwise(F.lit(NOT_TARGETED)).alias("request_type"),
        F.when(matched, F.lit(TARGETED)).otherwise(F.lit(RANDOM)).alias("response_type"),
    )
    targeted = (
        typed.where(F.col("response_type") == TARGETED)
        .select("request_id", "request_type", "response_type", F.explode("context_keys").alias("category"))
        .join(ads, "category")
    )
    numbered = numbering.shuffled_positions(ads, "redirect_url")
    size = ads.agg(F.count(F.lit(1)).alias("n")).scalar()
    drawn = (
        typed.where(F.col("response_type") == RANDOM)
        .select(
            "request_id",
            "request_type",
            "response_type",
            F.explode(F.sequence(F.lit(1), F.lit(MAX_RANDOM))).alias("draw"),
        )
        .withColumn("position", text.unit_hash(F.col("request_id"), F.col("draw"), seed=seed) % size)
        .join(numbered, "position")
    )
    columns = ("request_id", "request_type", "response_type", "redirect_url", "text")
    return targeted.select(*columns).unionByName(drawn.select(*columns))


def requests_by_type(requests: DataFrame, ads: DataFrame) -> DataFrame:
    """Requests counted by request and response type."""
    categories = ads.agg(F.collect_set("category")).scalar()
    keyed = F.coalesce(F.size("context_keys"), F.lit(0)) > 0
    matched = F.coalesce(F.arrays_overlap(F.col("context_keys"), categories), F.lit(False))
    typed = requests.select(
        F.when(keyed, F.lit(TARGETED)).otherwise(F.lit(NOT_TARGETED)).alias("request_type"),
        F.when(matched, F.lit(TARGETED)).otherwise(F.lit(RANDOM)).alias("response_type"),
    )
    return counters.counter(typed, ["request_type", "response_type"], name="requests")

"""Advertisements by product category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Category, redirect url, text. There are no ads for books.
ADS = (
    ("binoculars", "/product/2ZYFJ3GM2N", "Roof Binoculars for sale. 50% off."),
    ("telescopes", "/product/66VCHSJNUP", "Starsense Explorer Refractor Telescope for sale. 20% off."),
    ("accessories", "/product/0PUK6V6EV0", "Solar System Color Imager for sale. 30% off."),
    ("accessories", "/product/6E92ZMYYFZ", "Solar Filter for sale. Buy two, get third one for free"),
    ("accessories", "/product/L9ECAV7KIM", "Lens Cleaning Kit for sale. Buy one, get second one for free"),
    ("assembly", "/product/9SIQT8TOJO", "Optical Tube Assembly for sale. 10% off."),
    ("travel", "/product/1YMWWN1N4O", "Eclipsmart Travel Refractor Telescope for sale. Buy one, get second kit for free"),
)


def ads(spark: SparkSession) -> DataFrame:
    """``(category, redirect_url, text)`` as a literal table whose size the optimizer knows."""
    rows = ", ".join(repr(ad) for ad in ADS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(category, redirect_url, text)")

"""The product catalog: every JSON file of a folder, with periodic refresh for streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import schemas
from tracewell.functions import money
from tracewell.sinks import deltas

DEFAULT_REFRESH_SECONDS = 10


def flatten(files: DataFrame) -> DataFrame:
    """Products of catalog documents, one row each, with snake-case columns."""
    price = F.col("priceUsd")
    return files.select(F.inline("products")).select(
        "id",
        "name",
        "description",
        "picture",
        money.money(
            price["currencyCode"],
            F.coalesce(price["units"], F.lit(0)),
            F.coalesce(price["nanos"], F.lit(0)),
        ).alias("price_usd"),
        "categories",
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All ``*.json`` files of the folder, concatenated."""
    files = spark.read.schema(schemas.CATALOG_FILE).json(folder, multiLine=True, pathGlobFilter="*.json")
    return flatten(files)


def parse(documents: DataFrame, column: str = "value") -> DataFrame:
    """Products from a column of catalog documents as JSON text."""
    return flatten(documents.select(F.from_json(column, schemas.CATALOG_FILE).alias("file")).select("file.*"))


class Refreshing:
    """A catalog that is listed again once its age exceeds the interval.

    For use inside ``foreachBatch``. An interval that is not positive means the default. When a refresh
    fails the last good catalog stays in use.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        seconds: float = DEFAULT_REFRESH_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._load = load
        self._seconds = seconds if seconds > 0 else DEFAULT_REFRESH_SECONDS
        self._clock = clock
        self._loaded_at: float | None = None
        self._current: DataFrame | None = None

    def get(self) -> DataFrame:
        now = self._clock()
        if self._loaded_at is None or now - self._loaded_at >= self._seconds:
            try:
                self._current = self._load()
            except Exception:
                if self._current is None:
                    raise
            self._loaded_at = now
        return self._current


class Versions:
    """Snapshots of a refreshed catalog for a stream, and a ledger of the one that each micro-batch used.

    A batch that is replayed gets the catalog of its first attempt, also after a restart. A new snapshot is written only
    if the loaded catalog differs from the last one; a refresh that fails, while it is listed or read, leaves that in use.
    What no replay can ask for any more is deleted.
    """

    SNAPSHOTS, LEDGER = "catalog_snapshots", "catalog_ledger"

    def __init__(
        self,
        load: Callable[[], DataFrame],
        store: str,
        seconds: float = DEFAULT_REFRESH_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ):
        def marked() -> tuple[DataFrame, str]:
            found = load()
            return found, self._mark(found)

        self._fresh = Refreshing(marked, seconds, clock)
        self._store = store

    @staticmethod
    def _mark(products: DataFrame) -> str:
        """The same for equal catalogs, whatever the order of their rows."""
        hashed = F.xxhash64(*products.columns).cast("decimal(38,0)")
        return ":".join(map(str, products.agg(F.count(F.lit(1)), F.sum(hashed), F.bit_xor(F.xxhash64(F.lit(1), *products.columns))).first()))

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The catalog of a batch."""
        entry = self._entry(spark, batch_id)
        if entry is None:
            last = self._entry(spark, batch_id - 1)
            products, mark = self._load(spark, last)
            version = last[0] if last and last[1] == mark else batch_id
            if version == batch_id:
                deltas.write(products, self._store, self.SNAPSHOTS, version)
            entry = (version, mark)
            deltas.write(spark.createDataFrame([entry], "version long, mark string"), self._store, self.LEDGER, batch_id)
            older = self._entry(spark, batch_id - 2)
            if older:
                deltas.forget(spark, self._store, self.LEDGER, batch_id - 2)
                if last and older[0] != last[0]:
                    deltas.forget(spark, self._store, self.SNAPSHOTS, older[0])
        return deltas.batch(spark, self._store, self.SNAPSHOTS, entry[0])

    def _load(self, spark: SparkSession, last: tuple[int, str] | None) -> tuple[DataFrame, str]:
        try:
            return self._fresh.get()
        except Exception:  # the first refresh after a restart
            if last is None:
                raise
            return deltas.batch(spark, self._store, self.SNAPSHOTS, last[0]), last[1]

    def _entry(self, spark: SparkSession, batch_id: int) -> tuple[int, str] | None:
        found = deltas.batch(spark, self._store, self.LEDGER, batch_id)
        return None if found is None else tuple(found.first())

"""Levelled logs of mergeable rows, for streams that add to a table and look keys up in it.

Each micro-batch adds a run. Once as many runs of a level as the fan-out have come together they are folded into one run of
the next level, so a row is rewritten about once per level: logarithmically often in the number of batches. A folded
run is cut into buckets by the leading bits of a hash of its route columns, as many as its rows need; whoever looks up
some keys opens the buckets of those keys only, and that number does not grow with the log. Runs may lie in folders
by day as well; days that the log need not keep are left out as folders.

What a log holds after a batch is written in the manifest of that batch, which appears last and in one step. Readers see
the newest manifest, or that of an earlier batch; what it names stays until a number of further batches are in. A
replayed batch whose manifest exists changes nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.sinks import tables

FANOUT = 8
BUCKET_BYTES = 1 << 24
#: Batches for which a manifest and what it names stay, one at least: a replay needs the state before its batch.
GRACE = 4
BUCKET, RUN = "bucket", "run"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def columns(*named: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in named])


@dataclass(frozen=True)
class Spec:
    """How rows of a log add up: rows of equal ``keys`` become one, whose ``sums``, ``maxima`` and ``minima`` are those of
    its parts, and whose ``newest`` columns come from the part with the highest ``version``. ``day`` names a key of type
    date that makes folders; ``route`` names the keys that lookups give."""

    name: str
    schema: T.StructType
    keys: Sequence[str]
    route: Sequence[str]
    sums: Sequence[str] = ()
    maxima: Sequence[str] = ()
    minima: Sequence[str] = ()
    newest: Sequence[str] = ()
    version: str | None = None
    day: str | None = None

    def folded(self, rows: DataFrame, *more: str) -> DataFrame:
        parts = [F.sum(c).alias(c) for c in self.sums]
        parts += [F.max(c).alias(c) for c in self.maxima] + [F.min(c).alias(c) for c in self.minima]
        parts += [F.max_by(c, self.version).alias(c) for c in self.newest]
        if self.version:
            parts.append(F.max(self.version).alias(self.version))
        return rows.groupBy(*self.keys, *more).agg(*parts)

    def folders(self) -> list[str]:
        return ([self.day] if self.day else []) + [BUCKET]

    def stored_schema(self) -> T.StructType:
        kept = [f for f in self.schema.fields if f.name != self.day]
        days = [f for f in self.schema.fields if f.name == self.day]
        return T.StructType([*kept, T.StructField(RUN, T.StringType()), *days, T.StructField(BUCKET, T.IntegerType())])


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    bits: int
    size: int
    folders: list[str]


@dataclass(frozen=True)
class Manifest:
    batch: int
    runs: list[Run] = field(default_factory=list)
    #: The run of the batch itself, which may be folded already.
    own: Run | None = None
    #: The latest day seen so far, and the first day that is kept.
    newest_day: str | None = None
    oldest_day: str | None = None
    #: Bytes that batches have added, and bytes that folds have written, since the log began.
    added: int = 0
    rewritten: int = 0


def bucket_of(route: Iterable[str | Column], bits: int) -> Column:
    """The leading bits of the hash of the route columns."""
    return F.shiftrightunsigned(F.xxhash64(*route), 64 - bits).cast("int") if bits else F.lit(0)


def _day(folder: str) -> str | None:
    """The day of a folder, None for rows without one."""
    value = folder.split("/")[0].split("=")[1]
    return None if value == NO_DAY else value


class Log:
    """One levelled log below a store. ``keep`` is the time before the latest day seen for which days are kept."""

    def __init__(
        self,
        spark: SparkSession,
        store: str,
        spec: Spec,
        keep: timedelta | None = None,
        fanout: int = FANOUT,
        bucket_bytes: int = BUCKET_BYTES,
        grace: int = GRACE,
    ) -> None:
        if keep is not None and spec.day is None:
            raise ValueError(f"{spec.name} has no day to keep")
        self.spark, self.spec, self.keep = spark, spec, keep
        self.fanout, self.bucket_bytes, self.grace = fanout, bucket_bytes, max(1, grace)
        self.folder = tables.path(store, spec.name)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # Manifests

    def _manifest_path(self, batch: int) -> str:
        return f"{self.folder}/manifest/{batch:012d}.json"

    def batches(self) -> list[int]:
        """Numbers of the manifests there are."""
        found = self._fs.globStatus(self._path(f"{self.folder}/manifest/*.json"))
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found or ())

    def manifest(self, upto: int | None = None) -> Manifest:
        """The newest manifest, of batch ``upto`` at most; an empty one if there is none."""
        numbers = [b for b in self.batches() if upto is None or b <= upto]
        if not numbers:
            return Manifest(-1)
        stream = self._fs.open(self._path(self._manifest_path(numbers[-1])))
        try:
            found = json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(**found | {"runs": [Run(**r) for r in found["runs"]], "own": Run(**found["own"])})

    def _publish(self, manifest: Manifest) -> None:
        final = self._path(self._manifest_path(manifest.batch))
        draft = self._path(f"{self.folder}/manifest/.{manifest.batch}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest, default=vars).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise OSError(f"{final} could not be published")

    # Reading

    def read(
        self,
        upto: int | None = None,
        touching: DataFrame | None = None,
        days: tuple[date, date] | None = None,
        manifest: Manifest | None = None,
    ) -> DataFrame:
        """Rows of the log, partly folded. ``touching`` (with the route columns) opens the buckets of those keys only
        and ``days`` the folders of those days, both ends included; other rows of the opened folders come along."""
        manifest = manifest or self.manifest(upto)
        wanted = [(run, folder) for run in manifest.runs for folder in run.folders]
        if days is not None:
            first, last = map(str, days)
            wanted = [(r, f) for r, f in wanted if (day := _day(f)) is not None and first <= day <= last]
        if touching is not None:
            wanted = self._touched(wanted, touching)
        return self._rows([f"{RUN}={run.name}/{folder}" for run, folder in wanted])

    def _touched(self, wanted: list[tuple[Run, str]], keys: DataFrame) -> list[tuple[Run, str]]:
        """Folders that can hold the keys. The collected buckets are no more than the largest run has."""
        bits = max((run.bits for run, _ in wanted), default=0)
        if not bits:
            return wanted
        rows = keys.select(bucket_of(self.spec.route, bits).alias(BUCKET)).distinct().collect()
        at = {b: {r[0] >> (bits - b) for r in rows} for b in {run.bits for run, _ in wanted}}
        return [(run, folder) for run, folder in wanted if int(folder.rsplit("=", 1)[1]) in at[run.bits]]

    def _rows(self, folders: list[str]) -> DataFrame:
        names = self.spec.schema.fieldNames()
        if not folders:
            return self.spark.createDataFrame([], self.spec.schema)
        reader = self.spark.read.schema(self.spec.stored_schema()).option("basePath", f"{self.folder}/runs")
        return reader.parquet(*(f"{self.folder}/runs/{f}" for f in folders)).select(*names)

    def folded(self, **which) -> DataFrame:
        return self.spec.folded(self.read(**which))

    # Writing

    def _write(self, rows: DataFrame, name: str, level: int, bits: int) -> Run:
        place = f"{self.folder}/runs/{RUN}={name}"
        rows.write.mode("overwrite").partitionBy(*self.spec.folders()).parquet(place)
        folders = self._folders_of(name)
        size = self._fs.getContentSummary(self._path(place)).getLength() if folders else 0
        return Run(name, level, bits, size, [f.removeprefix(f"{RUN}={name}/") for f in folders])

    def add(self, rows: DataFrame, batch: int) -> Manifest:
        """Add the rows of a batch and publish its manifest; nothing happens if that exists."""
        if batch in self.batches():
            return self.manifest(batch)
        before = self.manifest(batch - 1)
        rows = rows.select(*self.spec.schema.fieldNames())
        new = self._write(rows.withColumn(BUCKET, F.lit(0)), f"0-{batch}-{batch}", 0, 0)
        runs, rewritten = [*before.runs, new] if new.folders else list(before.runs), 0
        seen = [d for r in runs if self.spec.day for f in r.folders if (d := _day(f))]
        newest = max([*seen, *([before.newest_day] if before.newest_day else [])], default=None)
        oldest = str(date.fromisoformat(newest) - self.keep) if self.keep is not None and newest else None
        runs = [r for run in runs if (r := self._kept(run, oldest)).folders]
        group, level = [], 0
        while len(full := [r for r in runs if r.level == level]) + bool(group) >= self.fanout:
            group, level = group + full, level + 1
        if group:
            folded = self._fold(group, level, batch)
            rewritten = folded.size
            runs = [r for r in runs if r not in group] + [folded]
        manifest = Manifest(batch, runs, new, newest, oldest, before.added + new.size, before.rewritten + rewritten)
        self._publish(manifest)
        self._clean(batch)
        return manifest

    def added(self, rows: DataFrame, batch: int) -> DataFrame:
        """Add the rows of a batch, and what of it the log holds, read back."""
        own = self.add(rows, batch).own
        return self._rows([f"{RUN}={own.name}/{f}" for f in own.folders])

    def _folders_of(self, name: str) -> list[str]:
        place = f"{self.folder}/runs/{RUN}={name}"
        found = self._fs.globStatus(self._path(place + "/" + "/".join("*=*" for _ in self.spec.folders()))) or ()
        root = self._fs.makeQualified(self._path(place)).toString() + "/"
        return sorted(f"{RUN}={name}/" + f.getPath().toString().removeprefix(root) for f in found)

    def _kept(self, run: Run, oldest: str | None) -> Run:
        folders = [f for f in run.folders if oldest is None or (d := _day(f)) is None or d >= oldest]
        return Run(run.name, run.level, run.bits, run.size, folders)

    def _fold(self, group: list[Run], level: int, batch: int) -> Run:
        bits = max(0, math.ceil(math.log2(sum(r.size for r in group) / self.bucket_bytes)))
        rows = self._rows([f"{RUN}={r.name}/{f}" for r in group for f in r.folders])
        dealt = rows.withColumn(BUCKET, bucket_of(self.spec.route, bits)).repartition(BUCKET)
        folded = self.spec.folded(dealt, BUCKET)  # buckets already lie together, so nothing moves again
        return self._write(folded.sortWithinPartitions(*self.spec.folders(), *self.spec.route), f"{level}-{batch}", level, bits)

    def _clean(self, batch: int) -> None:
        """Delete manifests that are older than the grace, and the folders that only they name."""
        numbers = self.batches()
        stale = [b for b in numbers if b < batch - self.grace]
        if not stale:
            return
        named_by = {b: (m := self.manifest(b)).runs + [m.own] for b in numbers}
        live = [r for b in numbers if b not in stale for r in named_by[b]]
        named = {f"/{r.name}" for r in live}
        for r in live:
            for folder in r.folders:
                named |= {f"/{r.name}/{folder}", f"/{r.name}/{folder.split('/')[0]}"}
        for b in stale:
            for run in named_by[b]:
                for folder in run.folders:
                    levels = [f"/{run.name}", f"/{run.name}/{folder.split('/')[0]}", f"/{run.name}/{folder}"]
                    gone = next((part for part in levels if part not in named), None)  # the highest that nothing names
                    if gone:
                        self._fs.delete(self._path(f"{self.folder}/runs/{RUN}={gone[1:]}"), True)
            self._fs.delete(self._path(self._manifest_path(b)), False)

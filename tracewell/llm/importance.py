"""Importance resampling towards a target distribution, with texts cut into lines and each distinct line counted once.

Features are hashed runs of consecutive words. Line feeds are separators, so a run lies in one line or crosses from
one to the next: runs inside lines are counted once for every distinct line and multiplied by its occurrences; runs that
cross lines are added from the documents. A bucket's gain is the logarithm of its share in the target against its
share in the documents; a document's weight is the mean gain of its features, and seeded Gumbel noise on top of it
turns the highest scores into a sample drawn in proportion to the weights, without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import stored

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
#: The drawn share of the eligible documents, as a fraction of two integers.
SHARE = (10, 100)
#: Buckets of runs that a task remembers; the memory is emptied when full, which costs time only.
REMEMBERED = 200_000


def word_table() -> bytes:
    """For ``bytes.translate``: A-Z lower-cased, digits, a-z and bytes above 127 kept, all others spaces."""
    kept = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b if b in kept else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


class Features:
    """Words and the buckets of their runs."""

    def __init__(self, longest: int, buckets: int) -> None:
        self.longest, self.buckets, self.table, self.known = longest, buckets, word_table(), {}

    def words(self, text: bytes | None) -> list[bytes]:
        return text.translate(self.table).split() if text else []

    def hashed(self, runs: list[bytes]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for run in set(runs).difference(known):
            known[run] = zlib.crc32(run) % self.buckets
        return [known[run] for run in runs]

    def runs(self, words: list[bytes]) -> list[bytes]:
        """All runs of up to ``longest`` words."""
        out = list(words)
        for n in range(2, self.longest + 1):
            out.extend(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        return out

    def crossing(self, text: bytes | None) -> list[bytes]:
        """The runs that hold words of more than one line."""
        words, ends = [], []
        for line in (text or b"").split(b"\n"):
            found = self.words(line)
            words += found
            ends += [len(words)] * len(found)
        return [
            b" ".join(words[i : i + n])
            for i, end in enumerate(ends)
            for n in range(max(2, end - i + 1), min(self.longest, len(words) - i) + 1)
        ]


def _counted(rows: DataFrame, longest: int, buckets: int, crossing: bool) -> DataFrame:
    """``(bucket, n)`` of the runs in ``rows`` ``(text, times)``, a row a bucket and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, np.int64)
        find = features.crossing if crossing else lambda text: features.runs(features.words(text))
        for batch in batches:
            found = [np.array(features.hashed(find(text)), np.int32) for text in batch.column(0).to_pylist()]
            if found:
                times = np.repeat(batch.column(1).to_numpy(), [len(f) for f in found])
                total += np.bincount(np.concatenate(found), times, buckets).astype(np.int64)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return rows.select(F.col("text").cast("binary"), F.col("times").cast("long")).mapInArrow(run, "bucket int, n long")


def bucket_counts(table: DataFrame, text_col: str, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket.

    Equal lines are combined before they are shuffled, so a line that a third of all texts hold is no hot key. The
    result has one number a bucket, whatever the size of the table.
    """
    lines = table.select(F.explode(F.split(F.col(text_col), "\n", -1)).alias("text")).where("text <> ''")
    found = _counted(lines.groupBy("text").agg(F.count("*").alias("times")), longest, buckets, crossing=False)
    if longest > 1:
        whole = table.select(F.col(text_col).alias("text"), F.lit(1).alias("times"))
        found = found.unionByName(_counted(whole, longest, buckets, crossing=True))
    counts = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed shares, rounded down."""
    buckets = len(documents)
    above = (target + 1.0) * (documents.sum() + buckets)
    below = (documents + 1.0) * (target.sum() + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int) -> DataFrame:
    """``(id, n_words, n_features, weight)`` of every document, the weight being the floored mean gain."""
    kinds = [("n_words", T.LongType()), ("n_features", T.LongType()), ("weight", T.LongType())]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in kinds]])
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        for batch in batches:
            rows = np.zeros((3, len(batch)), np.int64)
            for i, text in enumerate(batch.column(1)):
                words = features.words(text.as_py())
                if words:
                    found = features.hashed(features.runs(words))
                    rows[:, i] = len(words), len(found), int(gain[found].sum()) // len(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def noise(id_: Column, seed: int) -> Column:
    """A thousand times a standard Gumbel draw that depends on the seed and the id only, rounded down."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(scored: DataFrame, eligible: Column, share: tuple[int, int] = SHARE) -> DataFrame:
    """``scored`` (with ``id`` and ``score``) and ``rank``: 1, 2, 3 ... for the drawn share of the eligible rows.

    The lowest drawn score comes from a count of rows by score, whole numbers within the range of gains and noise,
    so of bounded number. Rows from there up are sorted by range; a row's rank is its place in its partition and the
    sizes of the partitions before. Equal rows are told apart by their place in the table, so they are no hot key.
    """
    by_score = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    above = by_score.select("score", F.sum("n").over(Window.orderBy(F.desc("score"))).alias("upto"))
    total = scored.where(eligible).count()
    drawn = share[0] * total // share[1]
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    lowest = above.where(F.col("upto") >= drawn).agg(F.max("score")).first()[0]
    chosen = F.coalesce(eligible & (F.col("score") >= lowest), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("place")]
    high = scored.where(chosen).withColumn("place", F.monotonically_increasing_id())
    high = high.repartitionByRange(*order).sortWithinPartitions(*order).drop("place")
    part, mask = F.spark_partition_id(), (1 << 33) - 1
    high = stored(high.withColumns({"part": part, "at": F.monotonically_increasing_id().bitwiseAND(F.lit(mask))}), "ranked")
    sizes = high.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.col("before") + F.col("at") + 1
    numbered = high.join(sizes.select("part", before.alias("before")), "part")
    numbered = numbered.withColumn("rank", F.when(rank <= drawn, rank)).select(*scored.columns, "rank")
    return numbered.unionByName(scored.where(~chosen).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    share: tuple[int, int] = SHARE,
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every document; ``rank`` is null if it isn't drawn.

    Null and empty texts have no features, weight 0, and are never drawn if ``least_words`` is above 0. Texts of any
    length are read whole. Null ids draw their noise as an empty id and come last among ties; repeated ids and rows
    each count for themselves. Ties go to the smaller id. Extra columns, whatever their names, are ignored. An empty
    table of documents gives no rows; an empty target has no features, which the smoothing allows.
    """
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_text_col, longest, buckets))
    found = weighted(docs, gain, id_col, text_col, longest)
    scored = stored(found.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    return ranked(scored, F.col("n_words") >= least_words, share)

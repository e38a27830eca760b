"""Document quality by a linear support vector machine over naive-Bayes-scaled n-gram indicators.

n-grams are hashed to buckets. The class counts of every bucket come from a bounded sample of the labelled training
rows, aggregated by Spark; their log ratios scale the indicators. The hinge-loss model is fitted by dual coordinate
descent on a smaller sample, and the margin is turned into a score by a logistic curve fitted on the same rows. Both
samples are the rows with the smallest hashes. Labels are sampled before they meet texts, so they can be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 18
#: Labelled training rows that class counts are taken from, those with the smallest hashes. They are broadcast: at 16
#: bytes a row that is a megabyte at most.
COUNT_ROWS = 60_000
#: Rows of these that the margin model is fitted on.
FIT_ROWS = 6_000
#: Tasks that turn them into features; the features, not the texts, go to the driver, in proportion to FIT_ROWS.
FIT_TASKS = 12
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
CUTOFF = 0.3

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def text_features(data: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The distinct buckets of a text's n-grams, ascending; ``data`` are its UTF-8 bytes.

    n-grams: runs of three and five bytes, words, neighbouring words, and steps that the share of words repeating the
    last one, and that of different words, reach. A text without bytes has none.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    marks, mask = np.zeros(buckets, np.bool_), np.uint64(buckets - 1)
    with np.errstate(over="ignore"):
        for at in range(0, n, 1 << 20):
            block = data[at : at + (1 << 20) + 256].astype(np.uint64)
            key = block.copy()
            for width in range(2, 6):
                if len(block) < width:
                    break
                key = key[:-1] << np.uint64(8) | block[width - 1 :]
                if width in (3, 5):
                    marks[(_mixed(key + (np.uint64(width) << np.uint64(56))) & mask).astype(np.int64)] = True
            space = (block == 32) | (block - np.uint64(9) < 5)
            starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
            if not len(starts):
                continue
            power = np.full(len(block), 0x9E3779B97F4A7C15, np.uint64).cumprod()
            total = np.concatenate((np.zeros(1, np.uint64), ((block + np.uint64(1)) * power).cumsum()))
            stops = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
            word = _mixed((total[stops] - total[starts]) * power[len(block) - 1 - starts])
            two = word[:-1] * np.uint64(3) + word[1:]
            same = (word[1:] == word[:-1]).mean() if len(word) > 1 else 0.0
            kinds = len(np.unique(word)) / len(word)
            levels = [(7 << 40) + i for i in range(1 + int(32 * same))] + [(9 << 40) + i for i in range(1 + int(32 * kinds))]
            for part in (word, _mixed(two), _mixed(np.array(levels, np.uint64))):
                marks[(part & mask).astype(np.int64)] = True
    return np.flatnonzero(marks)


@dataclass
class Model:
    """``weights`` are the support vector machine's weights times the log-count ratios."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, features: np.ndarray) -> float:
        margin = self.weights[features].sum() / max(1.0, np.sqrt(len(features))) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def _bytes_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each value, nulls empty, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[a:b]


def held_out(id_col: str, folds: int = 5) -> F.Column:
    """Whether a row is kept from training: its id's text has a CRC-32 that ``folds`` divides; null ids are kept too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def bucket_counts(labelled: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``(2, buckets)``: how many of the rows ``(text, label)`` of each label have each bucket. Bounded by ``buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for label, data in zip(batch.column(1).to_pylist(), _bytes_of(batch.column(0)), strict=True):
                count[label, text_features(data, buckets)] += 1
        label, bucket = np.nonzero(count)
        for at in range(0, len(label), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[part]), pa.array(bucket[part]), pa.array(count[label[part], bucket[part]])],
                ["label", "bucket", "n"],
            )

    found = labelled.select("text", F.col("label").cast("int")).mapInArrow(run, "label long, bucket long, n long")
    table = found.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((2, buckets))
    total[table["label"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    return total


def descend(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Weights over buckets and the bias of the hinge-loss model, by dual coordinate descent over the rows."""
    order = np.random.default_rng(7)
    weights, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    scale = np.array([1.0 / max(1.0, np.sqrt(len(r))) for r in rows])
    norms = np.array([s * s * (ratio[r] @ ratio[r]) + 1.0 for r, s in zip(rows, scale, strict=True)])
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            y, r = sign[i], rows[i]
            v = ratio[r] * scale[i]
            slack = y * (weights[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost[i])
            if step := new - alpha[i]:
                weights[r] += step * y * v
                bias += step * y
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the margins (Newton steps with a light ridge)."""
    slope, offset = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        d, h = weight * (p - label), weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([d @ margin + 1e-2 * (slope - 1), d.sum() + 1e-2 * offset])
        hess = np.array([[h @ margin**2 + 1e-2, h @ margin], [h @ margin, h.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(slope, 1e-6), offset


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS, epochs: int = EPOCHS) -> Model:
    """A model of the rows ``(id, text, label)``; rows whose label isn't 0 or 1 are passed over.

    Counts come from all these rows, the margin from the ``fit_rows`` rows with the smallest hashes of id and text (twice as many at most where rows repeat). With no
    rows, or rows of one label only, scores are that label's share (a half if there are none).
    """
    labelled = labelled.where("label in (0, 1)")
    counts = bucket_counts(labelled, buckets) + SMOOTHING
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # only hashes are sorted; equal rows tie, so the limit holds the bound
    place = F.xxhash64("id", "text")
    last = labelled.select(place.alias("h")).orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
    picked = labelled.where(place <= F.lit(last)).limit(2 * fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(data, buckets).astype(np.int32) for data in _bytes_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["label", "found"])

    sample = picked.select("text", F.col("label").cast("int")).repartition(FIT_TASKS).mapInArrow(run, "label int, found array<int>").toArrow()
    rows = [x.values.to_numpy() for x in sample["found"].combine_chunks()] if sample.num_rows else []
    label = sample["label"].to_numpy() if sample.num_rows else np.empty(0)
    ones = label.sum()
    if not len(rows) or ones in (0, len(rows)):
        share = (ones + 0.5) / (len(rows) + 1.0)
        return Model(np.zeros(buckets), 0.0, 1.0, float(np.log(share / (1 - share))))
    sign = np.where(label > 0, 1.0, -1.0)
    weights, bias = descend(rows, sign, ratio, np.full(len(rows), COST), epochs)
    model = Model(weights * ratio, bias, 1.0, 0.0)
    margin = np.array([model.weights[r].sum() / max(1.0, np.sqrt(len(r))) + bias for r in rows])
    model.slope, model.offset = calibrate(margin, label, np.ones(len(rows)))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` in 0 to 1; null texts are empty. Other columns stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text_features(data, len(model.weights))) for data in _bytes_of(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    at, names = docs.columns.index(text_col), [*docs.columns, out]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, count_rows: int = COUNT_ROWS
) -> DataFrame:
    """``(id, text, label)`` of the ``count_rows`` labelled rows not held out that have the smallest hashes."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(~held_out("id"))
    known = known.where("label in (0, 1)").orderBy(F.xxhash64("id"), "label").limit(count_rows)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """One row per input row: ``id, held_out, score, predicted``.

    Labels of held-out rows, ids and other columns never reach a score. Repeated rows score alike; extra columns are
    ignored; an empty table gives no rows.
    """
    model = fit(training_rows(docs, labels, id_col, text_col, label_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return score(rows, model).select(
        "id", held_out("id").alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted")
    )

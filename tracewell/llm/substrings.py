"""Removal of long substrings that occur again, by a hash-compared suffix sort.

Two equal strings of ``min_len`` bytes share their anchor: the place of the least-hashed string of ``grain`` bytes in
them. Windows (starts of such strings) are therefore dealt out by anchor: a *run* is a stretch of neighbouring windows
with one anchor, and only runs with equal anchor strings can hold equal windows. Runs that are equal as a whole are
recognised by their hash; where a key has different runs, the windows' suffixes are sorted: prefix polynomial hashes
and binary search give the common extension of two suffixes, so a comparison in the mergesort takes logarithmically
many steps, and neighbours found equal are verified byte by byte. Keys with very many different runs are split by the
windows' own digests instead, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import forget, release, stored

MIN_LEN = 200
GRAIN = 80
#: Bytes looked at together; longer texts go in overlapping tiles.
TILE = 1 << 20
#: A key with more different runs than this is split by window digests.
SORTED_RUNS = 2048
#: Bytes of runs whose suffixes are sorted together.
SORT_BLOCK = 1 << 20

BASE = 0x9E3779B97F4A7C15
_SHIFT = 1 << 20  # packs a span as start * 2^20 + length


class Powers:
    """Powers of the base and of its inverse modulo 2^64, up to a length."""

    def __init__(self, n: int) -> None:
        inverse = pow(BASE, -1, 1 << 64)
        self.up = np.concatenate((np.ones(1, np.uint64), np.full(n, BASE, np.uint64).cumprod()))
        self.down = np.concatenate((np.ones(1, np.uint64), np.full(n, inverse, np.uint64).cumprod()))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Sums of byte times power before each place."""
        return np.concatenate((np.zeros(1, np.uint64), ((data + np.uint64(1)) * self.up[: len(data)]).cumsum()))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: by running minima within blocks, forward and backward."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def find_runs(data: np.ndarray, texts: list[tuple[int, int]], powers: Powers, min_len: int, grain: int) -> list[np.ndarray]:
    """Runs of windows in ``data``, where ``texts`` are the begins and ends of texts, ascending.

    Returns each run's text, first window, number of windows, distance from there to the anchor, and key.
    """
    none = [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)]
    bounds = np.array(texts, np.int64).reshape(-1, 2)
    if len(data) < min_len or not ((bounds[:, 1] - bounds[:, 0]) >= min_len).any():
        return none
    total = powers.prefix(data.astype(np.uint64))
    n = len(data) - grain + 1
    key = _mixed((total[grain:] - total[:-grain]) * powers.down[:n])
    place = np.uint64((1 << 22) - 1)
    anchor = (sliding_min(key & ~place | np.arange(n, dtype=np.uint64), min_len - grain + 1) & place).astype(np.int64)
    change = np.zeros(len(data) + 1, np.int32)
    long = bounds[bounds[:, 1] - bounds[:, 0] >= min_len]
    change[long[:, 0]] += 1
    change[long[:, 1] - min_len + 1] -= 1
    anchor[change.cumsum()[: len(anchor)] < 1] = -1
    edge = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    size = np.diff(np.concatenate((edge, [len(anchor)])))
    live = anchor[edge] >= 0
    first, size = edge[live], size[live]
    at = anchor[first]
    text = np.searchsorted(bounds[:, 0], first, side="right") - 1
    return [text, first, size, at - first, key[at]]


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; nulls are empty."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(column.buffers()[2] or b"", np.uint8)


def _tiles(offsets: np.ndarray, min_len: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Stretches ``(begin, end, [(row, begin, end)])`` of the data that are looked at together."""
    held: list[tuple[int, int, int]] = []
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a > TILE:
            for begin in range(a, b - min_len + 1, TILE):
                end = min(b, begin + TILE + min_len - 1)
                yield begin, end, [(row, begin, end)]
        elif b - a >= min_len:
            if held and b - held[0][1] > TILE:
                yield held[0][1], held[-1][2], held
                held = []
            held.append((row, a, b))
    if held:
        yield held[0][1], held[-1][2], held


RUN_FIELDS = "key long, h long, tid long, tc int, first long, n int, off int"


def text_runs(docs: DataFrame, min_len: int, grain: int) -> DataFrame:
    """The runs of ``docs(tid, tc, text)``: key, hash of the run's bytes, text, first window, windows, anchor distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(TILE + 2 * min_len)
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            offsets, data = _binary(batch.column(2))
            tid, tc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for begin, end, texts in _tiles(offsets, min_len):
                block = data[begin:end]
                rows = np.array([r for r, _, _ in texts])
                text, first, n, off, key = find_runs(
                    block, [(a - begin, b - begin) for _, a, b in texts], powers, min_len, grain
                )
                if not len(text):
                    continue
                row, view = rows[text], memoryview(block)
                stop = (first + n - 1 + min_len).tolist()
                h = np.array([digest(view[a:b]) for a, b in zip(first.tolist(), stop, strict=True)], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(h.view(np.int64)),
                        pa.array(tid[row]),
                        pa.array(tc[row]),
                        pa.array(first + begin - offsets[row]),
                        pa.array(n.astype(np.int32)),
                        pa.array(off.astype(np.int32)),
                    ],
                    [f.split()[0] for f in RUN_FIELDS.split(", ")],
                )

    return docs.select("tid", "tc", "text").mapInArrow(run, RUN_FIELDS)


class Suffixes:
    """Suffixes of one block of bytes, compared up to ``min_len`` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, min_len: int) -> None:
        self.data, self.min_len = data, min_len
        self.powers = Powers(len(data))
        self.total = self.powers.prefix(data.astype(np.uint64))

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the longest common prefix of each two suffixes, at most ``min_len``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.min_len, np.int64)
        ta, tb, da, db = self.total[a], self.total[b], self.powers.down[a], self.powers.down[b]
        for _ in range(int(self.min_len).bit_length()):
            mid = (low + high + 1) // 2
            same = (self.total[a + mid] - ta) * da == (self.total[b + mid] - tb) * db
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1."""
        common = self.extension(a, b)
        last = len(self.data) - 1
        x, y = self.data[np.minimum(a + common, last)], self.data[np.minimum(b + common, last)]
        return np.where(common >= self.min_len, 0, np.where(x < y, -1, 1))

    def sort(self, start: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``start`` with each group, from ``begin`` to ``end`` of every element, merge-sorted; groups go in parallel."""
        start = start.copy()
        here, width = np.arange(len(start)), 1
        widest = int((end - begin).max()) if len(start) else 0
        while width < widest:
            busy = np.flatnonzero(end - begin > width)
            at, lo, hi = here[busy], begin[busy], end[busy]
            turn = (at - lo) // width
            left = turn % 2 == 0
            other = np.minimum(lo + (turn ^ 1) * width, hi)
            stop = np.minimum(other + width, hi)
            own = lo + turn * width
            low, high = other.copy(), stop.copy()
            while (open_ := low < high).any():
                i = np.flatnonzero(open_)
                mid = (low[i] + high[i]) // 2
                order = self.compare(start[mid], start[at[i]])
                before = (order < 0) | ((order == 0) & ~left[i])
                low[i] = np.where(before, mid + 1, low[i])
                high[i] = np.where(before, high[i], mid)
            to = np.minimum(own, other) + (at - own) + (low - other)
            moved = start[at]
            start[to] = moved
            width *= 2
        return start

    def repeated(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each suffix equals, in ``min_len`` bytes, another one of its group."""
        out = np.zeros(len(start), np.bool_)
        order = np.argsort(group, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) != 0)))
        size = np.diff(np.concatenate((edge, [len(order)])))
        begin, end = np.repeat(edge, size), np.repeat(edge + size, size)
        many = end - begin > 1
        order = order[many]
        if not len(order):
            return out
        shift = np.cumsum(~many)[many]  # groups of one fall away before each
        begin, end = begin[many] - shift, end[many] - shift
        row_at = np.full(len(self.data), -1, np.int64)
        row_at[start[order]] = order
        done = self.sort(start[order], begin, end)
        a, b = done[:-1], done[1:]
        near = np.flatnonzero((begin[:-1] == begin[1:]) & (self.extension(a, b) >= self.min_len))
        for part in np.array_split(near, -(-len(near) // 20_000) or 1):
            step = np.arange(self.min_len)
            true = (self.data[a[part][:, None] + step] == self.data[b[part][:, None] + step]).all(axis=1)
            out[row_at[a[part][true]]] = True
            out[row_at[b[part][true]]] = True
        return out


def repeated_windows(keys: np.ndarray, n: np.ndarray, off: np.ndarray, offsets: np.ndarray, data: np.ndarray, min_len: int) -> list[np.ndarray]:
    """Stretches ``(row, first, last)`` of windows that occur in another row with the same key.

    Rows are runs, row i holding the bytes from ``offsets[i]`` to ``offsets[i + 1]``.
    """
    rows = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    _, dense = np.unique(keys, return_inverse=True)
    group = dense[rows] * np.int64(2 * min_len) + off[rows] - step + min_len
    hit = Suffixes(data, min_len).repeated(offsets[:-1][rows] + step, group)
    at = np.flatnonzero(hit)
    fresh = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(rows[at]) != 0))) if len(at) else np.empty(0, np.bool_)
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:] - 1, [len(at) - 1])) if len(first) else first
    return [rows[at[first]], step[at[first]], step[at[last]]]


def _sort_task(min_len: int):
    names = ["key", "h", "a", "b"]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solve(some: pa.Table) -> pa.RecordBatch:
            some = some.combine_chunks()
            column = some["bytes"].chunk(0)
            offsets, data = _binary(column)
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            key, h = some["key"].to_numpy(), some["h"].to_numpy()
            n, off = some["n"].to_numpy().astype(np.int64), some["off"].to_numpy().astype(np.int64)
            row, a, b = repeated_windows(key, n, off, offsets, data, min_len)
            return pa.RecordBatch.from_arrays(
                [pa.array(key[row]), pa.array(h[row]), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            key = table["key"].to_numpy()
            ends = np.concatenate((np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))  # rows come sorted by key
            size = np.cumsum(table["n"].to_numpy().astype(np.int64) + min_len)
            begin, full = 0, ends[:-1]
            while begin < (full[-1] if len(full) else 0):
                limit = (size[begin - 1] if begin else 0) + SORT_BLOCK
                fits = full[(full > begin) & (size[full - 1] <= limit)]
                stop = int(fits[-1]) if len(fits) else int(full[full > begin][0])
                yield solve(table.slice(begin, stop - begin))
                begin = stop
            rest = table.slice(begin)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return sort


def _windows_task(min_len: int):
    """Each window of each run: its digest, from two hash functions, and the run it is of."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "h", "at", "d1", "d2"]
        for batch in batches:
            for row in batch.to_pylist():
                parts = [bytes(row["bytes"][i : i + min_len]) for i in range(row["n"])]
                d = np.array([xxhash.xxh3_128_intdigest(p).to_bytes(16, "little") for p in parts], "S16")
                two = np.frombuffer(d.tobytes().ljust(16 * len(parts), b"\0"), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(row["n"], row["key"], np.int64)),
                        pa.array(np.full(row["n"], row["h"], np.int64)),
                        pa.array(np.arange(row["n"], dtype=np.int32)),
                        pa.array(two[:, 0]),
                        pa.array(two[:, 1]),
                    ],
                    names,
                )

    return windows


def _slices_task(min_len: int):
    """The bytes of the runs listed with each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = _binary(batch.column(0))
            lists = batch.column(1)
            spot = lists.offsets.to_numpy()
            flat = lists.values
            key, h, first, n, off = (flat.field(i) for i in range(5))
            for i in range(batch.num_rows):
                part = slice(spot[i], spot[i + 1])
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                begin, size = first.to_numpy()[part].tolist(), n.to_numpy()[part].tolist()
                cuts = [text[a : a + m - 1 + min_len] for a, m in zip(begin, size, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [key[part.start : part.stop], h[part.start : part.stop], n[part.start : part.stop], off[part.start : part.stop], pa.array(cuts, pa.binary())],
                    ["key", "h", "n", "off", "bytes"],
                )

    return cut


def repeated_spans(docs: DataFrame, min_len: int = MIN_LEN, grain: int = GRAIN) -> DataFrame:
    """``(tid, tc, spans)`` for the texts of ``docs(tid, tc, text)`` that hold repeats; spans are packed and may overlap."""
    spark = docs.sparkSession
    runs = text_runs(docs, min_len, grain)
    info = runs.groupBy("key").agg(F.count("*").alias("c"), F.min("h").alias("low"), F.max("h").alias("high"))
    info = stored(info.where("c > 1").select("key", (F.col("low") == F.col("high")).alias("one")), "keys")
    release(spark)
    members = stored(runs.join(info, "key"), "members")
    release(spark)

    classes = members.where("not one").groupBy("key", "h").agg(
        F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("tid", "tc", "first", "n", "off")]
    )
    classes = stored(classes, "classes")
    listed = classes.groupBy("tid", "tc").agg(F.collect_list(F.struct("key", "h", "first", "n", "off")).alias("runs"))
    texts = docs.groupBy("tid", "tc").agg(F.first(F.col("text").cast("binary")).alias("text"))
    cut = texts.join(listed, ["tid", "tc"]).select("text", "runs")
    cut = stored(cut.mapInArrow(_slices_task(min_len), "key long, h long, n int, off int, bytes binary"), "slices")
    release(spark)

    crowded = stored(cut.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > SORTED_RUNS).select("key"), "crowded")
    calm = cut.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    found = calm.mapInArrow(_sort_task(min_len), "key long, h long, a int, b int")
    each = stored(
        cut.join(crowded, "key").mapInArrow(_windows_task(min_len), "key long, h long, at int, d1 long, d2 long"), "windows"
    )
    twice = stored(each.groupBy("key", "d1", "d2").agg(F.count("*").alias("c")).where("c > 1").drop("c"), "twice")
    split = each.join(twice, ["key", "d1", "d2"]).select("key", "h", F.col("at").alias("a"), F.col("at").alias("b"))
    whole = classes.where("c > 1").select("key", "h", F.lit(0).alias("a"), (F.col("n") - 1).alias("b"))
    parts = stored(found.unionByName(split).unionByName(whole), "parts")
    release(spark)

    def span(first, windows):
        return (first * _SHIFT + windows - 1 + min_len).alias("span")

    sole = members.where("one").select("tid", "tc", span(F.col("first"), F.col("n")))
    other = members.where("not one").select("key", "h", "tid", "tc", "first").join(parts, ["key", "h"])
    other = other.select("tid", "tc", span(F.col("first") + F.col("a"), F.col("b") - F.col("a") + 1))
    spans = sole.unionByName(other).groupBy("tid", "tc").agg(F.collect_set("span").alias("spans"))
    out = stored(spans, "spans")
    for done in (members, cut, each):
        forget(done)
    release(spark)
    return out


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs that packed spans cover; touching spans join."""
    spans = np.sort(spans)
    begin, end = spans // _SHIFT, np.maximum.accumulate(spans // _SHIFT + spans % _SHIFT)
    fresh = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    return begin[fresh], end[np.concatenate((fresh[1:] - 1, [len(end) - 1]))]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN, grain: int = GRAIN
) -> DataFrame:
    """One row per input row: ``id, n_bytes, kept (binary), starts, stops`` (arrays of the removed byte ranges).

    A byte goes if a string of ``min_len`` bytes over it also starts anywhere else in the table, the same text
    included; matches don't cross texts and are judged on the input. Rows with equal texts repeat each other.
    Null texts are empty. Null ids and repeated rows are kept; extra columns are ignored; an empty table gives no
    rows. A text is known by 96 bits of hash, a window of a crowded key by 128.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    whole = whole.withColumns({"tid": F.xxhash64("text"), "tc": F.hash("text")})
    joined = whole.join(repeated_spans(whole, min_len, grain), ["tid", "tc"], "left").select("id", "text", "spans")
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("kept", T.BinaryType()),
            T.StructField("starts", T.ArrayType(T.LongType())),
            T.StructField("stops", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = _binary(batch.column(1))
            kept, starts, stops, size = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                spans = batch.column(2)[i]
                if spans.is_valid:
                    begin, end = merged(spans.values.to_numpy())
                    keep = np.concatenate(([0], end)), np.concatenate((begin, [len(text)]))
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(*keep, strict=True)))
                else:
                    begin = end = np.empty(0, np.int64)
                    kept.append(text.tobytes())
                starts.append(begin)
                stops.append(end)
                size.append(len(text))
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(kept, pa.binary()), pa.array(starts, many), pa.array(stops, many)],
                schema.names,
            )

    return joined.mapInArrow(run, schema)

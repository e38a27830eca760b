"""Fuzzy line dedup: of each group of near-equal lines one occurrence stays.

Lines are normalised. Lines that may have edit similarity 0.8 meet on keys: bands of minimal hashes of their character
n-grams, halves of their words, and for lines under ten characters all texts with one character left out. Candidates
whose character SimHashes are within ``RADIUS`` bits are verified by edit similarity and linked, and each connected
group keeps its first occurrence. Of a key shared by many lines most of which may be alike the links are a forest by edit
similarity, which connects its lines exactly as all of its pairs would.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache, reduce
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracewell.llm.common import components, forget, release, stored

SIMILARITY = 0.8
#: Bits by which SimHashes of lines of similarity 0.8 may differ; 26 was the most among 11,501 such pairs made from sf0.1 lines.
RADIUS = 26
GRAM = 3
#: Shortest line with bands, length of the n-grams and minimal hashes a band, by line length.
CLASSES = [(10, 3, 4), (32, 3, 5), (100, 4, 5), (200, 6, 6)]
BANDS = 16
#: Lines are spread over their keys in so many passes, to hold less on disk at once.
PASSES = 4
#: Keys with more candidates than as many lines have, for each of their lines, are searched by a forest.
PAIRED = 32
#: Longest line whose letters are counted beside its keys; longer ones seldom meet by chance.
LETTERED = 250
#: Buckets of letters and of pairs of letters in a line's counts.
LETTERS, COUPLES = 32, 256


_words, _digit = re.compile(r"\w+").findall, re.compile(r"\d")


def normalised(line: str) -> str:
    """Lower-cased words joined by single spaces, digits as 0."""
    plain = " ".join(_words(line.lower()))
    return _digit.sub("0", plain) if _digit.search(plain) else plain


@cache
def _plain() -> np.ndarray:
    """What becomes of each letter below 2**17: its lower case, 0 for digits, a space for what is in no word; ``_OWN`` where
    lower case depends on the word or is longer."""
    out = np.full(1 << 17, 32, np.uint32)
    for code in range(1 << 17):
        lower = chr(code).lower()
        if len(lower) > 1 or code == 0x3A3:  # a capital sigma ends words in another letter
            out[code] = _OWN
        elif lower.isalnum() or lower == "_":
            out[code] = 48 if lower.isdecimal() else ord(lower)
    out[10] = 10
    return out


_OWN = (1 << 32) - 1


def all_normalised(lines: list[str]) -> list[str]:
    """:func:`normalised` of each line, none of which holds a line feed; lines of ASCII letters are read as bytes."""
    plain = [x.isascii() for x in lines]
    if all(plain):
        return _collapsed("\n".join(lines).encode().translate(_ascii_plain()).decode()) if lines else []
    if any(plain):
        some = iter(all_normalised([x for x, p in zip(lines, plain, strict=True) if p]))
        rest = iter(all_normalised([x for x, p in zip(lines, plain, strict=True) if not p]))
        return [next(some if p else rest) for p in plain]
    raw = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    table = _plain()
    code = table[np.minimum(raw, len(table) - 1)]
    code[raw >= len(table)] = _OWN
    own = np.flatnonzero(code == _OWN)
    numbers = np.unique(np.searchsorted(np.flatnonzero(raw == 10), own)).tolist() if len(own) else []
    code[own] = 32
    out = _collapsed(code.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"))
    for k in numbers:
        out[k] = normalised(lines[k])
    return out


@cache
def _ascii_plain() -> bytes:
    """What becomes of each ASCII letter."""
    return _plain()[:256].astype(np.uint8).tobytes()


def _collapsed(text: str) -> list[str]:
    """The lines of a text, without spaces at their ends and after other spaces."""
    while "  " in text:
        text = text.replace("  ", " ")
    return text.replace(" \n", "\n").replace("\n ", "\n").strip(" ").split("\n")


#: For each byte its bits as the bytes of one number, so that eight counters add up at once.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
_ODD = np.random.default_rng(4).integers(0, 1 << 63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Letters that are worked on at once, so that they stay in the processor's cache.
ROOM = 1 << 15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _parts(size: np.ndarray, which: np.ndarray) -> Iterator[np.ndarray]:
    """``which`` in parts of about ``ROOM`` letters, one text at least."""
    ends, at = np.cumsum(size[which]), 0
    while at < len(which):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ROOM, "right")))
        yield which[at:stop]
        at = stop


def _hashes(text: str, n: int) -> np.ndarray:
    """Hashes of all n-grams of a text; n zeros hash to 0."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashes = np.zeros(max(0, len(code) - n + 1), np.uint64)
    for j in range(n):
        hashes *= np.uint64(0x100000001B3)
        hashes += code[j : j + len(hashes)]
    return _mixed(hashes)


def _grams(lines: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the padded character n-grams of all lines, and each line's first."""
    pad = "\0" * (n - 1)
    size = np.fromiter(map(len, lines), np.int64, len(lines)) + n - 1
    return _hashes(pad + pad.join(lines) + pad, n), np.cumsum(size) - size


def _added(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bit's sum over three numbers: its ones and its twos."""
    d = a ^ b
    return d ^ c, (a & b) | (d & c)


#: Grams whose bits are added up as numbers before they are spread to counters.
RUN = 15


def word_fingerprints(lines: list[str]) -> np.ndarray:
    """SimHash of each normalised line's characters by padded n-grams, as signed 64-bit numbers; empty: 0."""
    out = np.zeros(len(lines), np.int64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    pads = ["\0" * k for k in range(RUN + GRAM)]
    for part in _parts(size, np.flatnonzero(size)):
        own = size[part] + GRAM - 1
        runs = -(-own // RUN)
        # zeros fill each line's last run up; a gram of zeros has no bits
        fill = (runs * RUN - size[part]).tolist()
        text = pads[GRAM - 1] + "".join([lines[i] + pads[k] for i, k in zip(part.tolist(), fill, strict=True)])
        h = _hashes(text, GRAM).reshape(-1, RUN).T.copy()
        (a, p), (b, q), (c, r), (d, s), (e, t) = (_added(*h[k : k + 3]) for k in range(0, RUN, 3))
        a, u = _added(a, b, c)
        ones, v = _added(a, d, e)
        (p, x), (q, y) = _added(p, q, r), _added(s, t, u)
        twos, z = _added(p, q, v)
        fours, eights = _added(x, y, z)
        total = sum(_SPREAD[plane.view(np.uint8)].reshape(-1, 8) << np.uint64(k) for k, plane in enumerate((ones, twos, fours, eights)))
        # counters are bytes, so no more than 17 runs are added up before they are widened
        first, steps = np.cumsum(runs) - runs, -(-runs // 17)
        begin = np.cumsum(steps) - steps
        cuts = np.repeat(first - 17 * begin, steps) + 17 * np.arange(steps.sum())
        count = np.add.reduceat(np.add.reduceat(total, cuts, axis=0).view(np.uint8), begin, axis=0, dtype=np.int64)
        out[part] = np.packbits(2 * count > own[:, None], axis=1, bitorder="little").view("<i8")[:, 0]
    return out


def _bands(lines: list[str], n: int, rows: int, bands: range) -> np.ndarray:
    """A row of keys for each line, one for each band, a key from ``rows`` minimal hashes of n-grams."""
    hashes, starts = _grams(lines, n)
    held, least = np.empty_like(hashes), np.empty((rows, len(bands), len(lines)), np.uint64)
    for at, band in enumerate(bands):
        for i in range(rows):
            np.multiply(hashes, _ODD[band * rows + i], out=held)
            np.add(held, _ODD[-1 - band * rows - i], out=held)
            np.minimum.reduceat(held, starts, out=least[i, at])
    key = np.repeat(np.array([[100 * n + band + 1] for band in bands], np.uint64), len(lines), axis=1)
    for own in least:
        key = _mixed(key * np.uint64(31) + own)
    return np.ascontiguousarray(key.T).view(np.int64)


def _text_keys(lines: list[str]) -> tuple[list[int], np.ndarray]:
    """Line numbers and keys of short lines with a letter left out, and of halves of lines' words."""
    row: list[int] = []
    text: list[str] = []
    for i, line in enumerate(lines):
        if 3 < len(line) < 10:
            own = ["1" + line, *("1" + line[:k] + line[k + 1 :] for k in range(len(line)))]
            text += own
            row += [i] * len(own)
    code = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    gap, ends = np.flatnonzero(code == 32), np.append(np.flatnonzero(code == 10), len(code))
    start = np.append(0, ends[:-1] + 1)
    first, words = np.searchsorted(gap, start), np.searchsorted(gap, ends) - np.searchsorted(gap, start) + 1
    several = np.flatnonzero(words > 3)
    first, words, start = first[several], words[several], start[several, None]
    half = np.stack((words // 2, (words + 1) // 2), axis=1)
    stops = (gap[first[:, None] + half - 1] - start).tolist()
    begins = (gap[(first + words - 1)[:, None] - half] + 1 - start).tolist()
    for i, (a, b), (y, x) in zip(several.tolist(), stops, begins, strict=True):
        line = lines[i]
        text += ["2" + line[:a], "3" + line[y:]]
        row += [i, i]
        if a != b:
            text += ["2" + line[:b], "3" + line[x:]]
            row += [i, i]
    return row, np.fromiter(map(xxhash.xxh3_64_intdigest, text), np.uint64, len(text)).view(np.int64)


def numbered_keys(lines: list[str], turns: list[range]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``turns`` the numbers of the normalised lines, in order, and their keys; those other than bands come with
    the first band.

    A line a fifth longer may be of the next class, so a line near the end of its class has the keys of both. Halves
    are the first and last words, half of them rounded either way: a line with one word replaced, put in or left out
    has one of them in common.
    """
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    found: list[list[tuple]] = [[_text_keys(lines)] if 0 in bands else [] for bands in turns]
    every = range(BANDS) if len(turns) > 1 else turns[0]
    for c, (least, n, rows) in enumerate(CLASSES):
        top = CLASSES[c + 1][0] if c + 1 < len(CLASSES) else size.max(initial=0) + 1
        for part in _parts(size, np.flatnonzero((size < top) & ((size / SIMILARITY + 1e-9).astype(np.int64) >= least))):
            keys = _bands([lines[i] for i in part.tolist()], n, rows, every)
            for bands, own in zip(turns, found, strict=True):
                at = [every.index(band) for band in bands]
                own.append((np.repeat(part, len(at)), keys[:, at].ravel()))
    out = []
    for own in found:
        row, key = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in own)]).astype(np.int64) for k in (0, 1))
        order = np.argsort(row, kind="stable")
        out.append((row[order], key[order]))
    return out


def line_keys(lines: list[str], bands: range = range(BANDS)) -> list[list[int]]:
    """The keys of each normalised line."""
    keys: list[set[int]] = [set() for _ in lines]
    for i, key in zip(*(x.tolist() for x in numbered_keys(lines, [bands])[0]), strict=True):
        keys[i].add(key)
    return [list(k) for k in keys]


#: What a line brings to its keys.
KEYED = np.dtype([("key", "<i8"), ("lh", "<i8"), ("fp", "<i8"), ("low", "<i8"), ("high", "<i8"), ("size", "<i4")])
#: Keys that a task bundles at once.
BUNDLED = 1 << 19


def passes() -> list[range]:
    """The bands of each pass: the first has one, as the keys other than bands come with it, and the others share the rest."""
    step = -(-(BANDS - 1) // (PASSES - 1))
    return [range(1), *(range(at, min(at + step, BANDS)) for at in range(1, BANDS, step))]


def occurrences(docs: DataFrame) -> DataFrame:
    """``(id, th, line, lh, about, keys0, many0, ...)``: a row for every line with a word of ``docs(id, th, text)``; lh names
    the normalised line.

    Besides, for some hundred documents at once a row with no lh but what their lines bring to their keys, as bytes: about the
    lines, their keys in each pass, and how many keys each has. So a text is normalised and its grams are hashed once, and
    what Spark handles are few rows.
    """
    turns = passes()
    names = [f"{what}{turn}" for turn in range(PASSES) for what in ("keys", "many")]
    schema = T.StructType(
        [
            docs.schema["id"],
            T.StructField("th", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("lh", T.LongType()),
            *[T.StructField(name, T.BinaryType()) for name in ("about", *names)],
        ]
    )

    def bundle(text: list[str], lh: np.ndarray) -> list[bytes]:
        lh, own = np.unique(lh, return_index=True)
        text = [text[i] for i in own.tolist()]
        counts = packed_letters(text)
        about = np.zeros(len(text), KEYED)
        about["lh"], about["fp"], about["low"], about["high"] = lh, word_fingerprints(text), counts[:, 0], counts[:, 1]
        about["size"] = np.fromiter(map(len, text), np.int64, len(text))
        out = [about[list(KEYED.names[1:])].astype(KEYED.descr[1:]).tobytes()]
        for row, key in numbered_keys(text, turns):
            out += [key.astype("<i8").tobytes(), np.bincount(row, minlength=len(text)).astype("<u2").tobytes()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [field.type for field in to_arrow_schema(schema)]
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                raw = [(value or "").split("\n") for value in some.column(2).to_pylist()]
                text = all_normalised(list(chain.from_iterable(raw)))
                many = np.fromiter(map(len, raw), np.int64, len(raw))
                held = np.flatnonzero(np.fromiter(map(bool, text), bool, len(text)))
                if not len(held):
                    continue
                row = np.repeat(np.arange(len(raw)), many)[held]
                line = held - (np.cumsum(many) - many)[row]
                text = [plain for plain in text if plain]
                lh = np.fromiter(map(xxhash.xxh3_64_intdigest, text), np.uint64, len(text)).view(np.int64)
                own = [some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), pa.array(line, pa.int32()), pa.array(lh)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(len(row), kind) for kind in kinds[4:]]], schema.names)
                own = [pa.array([x], pa.binary()) for x in bundle(text, lh)]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(1, kind) for kind in kinds[:4]], *own], schema.names)

    return docs.select("id", "th", "text").mapInArrow(run, schema)


def keyed_lines(seen: DataFrame, turn: int) -> DataFrame:
    """``KEYED`` rows of a pass over :func:`occurrences`, in :func:`bundles`."""

    def rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for about, keys, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            about = np.frombuffer(about, KEYED.descr[1:])
            take = np.repeat(np.arange(len(about)), np.frombuffer(many, "<u2"))
            out = np.empty(len(take), KEYED)
            out["key"] = np.frombuffer(keys, "<i8")
            for name in KEYED.names[1:]:
                out[name] = about[name][take]
            yield out

    return bundles(seen.where("about is not null").select("about", f"keys{turn}", f"many{turn}"), rows)


def bundles(keyed: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> DataFrame:
    """``(bucket, rows)``: the ``KEYED`` rows that ``rows`` makes of ``keyed``, dealt by key to buckets, those of a task and
    bucket as bytes. A row for each key would cost Spark more than all work on it."""
    buckets = 4 * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for some in chain(chain.from_iterable(map(rows, batches)), [None]):
            if some is not None:
                held.append(some)
                many += len(some)
            if many >= BUNDLED or some is None and many:
                own = np.concatenate(held)
                bucket = (own["key"].view("<u8") >> np.uint64(20)) % np.uint64(buckets)
                bucket = bucket.astype(np.uint16 if buckets < 1 << 16 else np.int32)
                order = np.argsort(bucket, kind="stable")
                own, bucket = own[order], bucket[order]
                edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))).tolist()
                packed = [own[a:b].tobytes() for a, b in pairwise(edge)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "rows"])
                held, many = [], 0

    return keyed.mapInArrow(run, "bucket int, rows binary")


def _near(fp: np.ndarray, size: np.ndarray, other: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Whether fingerprints are within ``RADIUS`` bits and lengths leave room for the similarity."""
    close = np.bitwise_count((fp ^ other).view(np.uint64)) <= RADIUS
    return close & (np.minimum(size, other_size) >= SIMILARITY * np.maximum(size, other_size) - 1e-6)


def packed_letters(texts: list[str]) -> np.ndarray:
    """The lowest four bits of each text's letter counts by bucket, in two numbers; zeros for texts beyond ``LETTERED``."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), 2), np.int64)
    for part in _parts(size, np.flatnonzero((size > 0) & (size <= LETTERED))):
        code = np.frombuffer("".join([texts[i] for i in part.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.repeat(np.arange(len(part)) * LETTERS, size[part]) + code % np.uint32(LETTERS)
        counts = (np.bincount(at, minlength=len(part) * LETTERS).reshape(-1, LETTERS) & 15).astype(np.uint8)
        out[part] = (counts[:, ::2] | counts[:, 1::2] << 4).view("<i8").reshape(-1, 2)
    return out


def letters_allow(a: np.ndarray, b: np.ndarray, size: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether rows of :func:`packed_letters` allow an edit distance of ``most`` between texts of these sizes.

    Of the letters that one text has more of and the other has more of, neither kind may exceed the edits; they add up to
    the change of all counts and differ by the change of size. Four bits show a change of 8 at most, never too large a one.
    """
    x, y = (np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, LETTERS // 2) for c in (a, b))
    change = np.abs(size.astype(np.int64) - other)
    for shift in (0, 4):
        by = (x >> shift) - (y >> shift) & 15
        change += np.minimum(by, 16 - by).sum(axis=1, dtype=np.int64)
    return (change <= 2 * most) | ~a.any(axis=1) | ~b.any(axis=1)


def _shared_keys(rows: np.ndarray) -> np.ndarray:
    """Of ``KEYED`` rows the distinct ones, by key and line, whose key several rows have, by key."""
    key = np.ascontiguousarray(rows["key"])
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    rows = rows[order[np.append(same, False) | np.append(False, same)]]
    rows = rows[np.lexsort((rows["lh"], rows["key"]))]
    again = (rows["key"][1:] == rows["key"][:-1]) & (rows["lh"][1:] == rows["lh"][:-1])
    return rows[np.append(True, ~again)[: len(rows)]]


def _rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    out = np.empty(batch.num_rows, KEYED)
    for name, column in zip(KEYED.names, batch.columns, strict=True):
        out[name] = column.to_numpy()
    yield out


def line_pairs(keyed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Candidates ``(a, b, crowded)`` of ``keyed(key, lh, fp, size, low, high)`` or its bundles: pairs, or a line ``a`` and
    its ``crowded`` key, if its lines have more pairs than ``PAIRED`` lines would have for each of them.

    Lines that meet by chance grow faster than the lines, so those whose letters tell them apart are not listed.
    """

    def candidates(rows: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, _, fp, low, high, size = rows  # as in KEYED
        good = _near(fp[i], size[i], fp[j], size[j])
        i, j = i[good], j[good]
        most = ((1 - similarity) * np.maximum(size[i], size[j]) + 1e-9).astype(np.int64)
        letters = (np.stack((low[x], high[x]), axis=1) for x in (i, j))
        good = letters_allow(*letters, size[i], size[j], most)
        return i[good], j[good]

    def of_many(rows: list[np.ndarray], begin: int, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """The candidates among ``n`` rows from ``begin``; None if there are too many."""
        found, some, at = [], 0, 0
        while at < n - 1:
            block = max(1, min((1 << 18) // n, n - 1 - at))
            i = np.repeat(np.arange(at, at + block), n - 1 - np.arange(at, at + block))
            j = np.concatenate([np.arange(k + 1, n) for k in range(at, at + block)])
            found.append(candidates(rows, begin + i, begin + j))
            some, at = some + len(found[-1][0]), at + block
            if some > PAIRED // 2 * n:
                return None
        return found

    def solve(packed: list[bytes]) -> pa.RecordBatch:
        rows = _shared_keys(np.concatenate([np.frombuffer(x, KEYED) for x in packed]))
        rows = [np.ascontiguousarray(rows[name]) for name in KEYED.names]
        key, lh = rows[:2]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, np.int64)
        many = np.diff(edge)
        found, crowds = [], []
        for n in np.unique(many[many > 1]).tolist():
            begin = edge[:-1][many == n]
            if n <= PAIRED:
                i, j = np.triu_indices(n, 1)
                for at in range(0, len(begin), 1 + (1 << 18) // n**2):
                    some = begin[at : at + 1 + (1 << 18) // n**2, None]
                    found.append(candidates(rows, (some + i).ravel(), (some + j).ravel()))
            else:
                for at in begin.tolist():
                    own = of_many(rows, at, n)
                    found += own or []
                    crowds += [np.arange(at, at + n)] if own is None else []
        none = np.empty(0, np.int64)
        i, j = (np.concatenate([none, *(x[k] for x in found)]) for k in (0, 1))
        c = np.concatenate([none, *crowds])
        a, b = lh[i], lh[j]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((np.minimum(a, b), lh[c]))),
                pa.concat_arrays([pa.array(np.maximum(a, b)), pa.nulls(len(c), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(key[c])]),
            ],
            ["a", "b", "crowded"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and held:
                    yield solve(held)
                    held = []
                now = bucket
                held.append(packed)
        if held:
            yield solve(held)

    if "bucket" not in keyed.columns:
        keyed = bundles(keyed.select(*KEYED.names), _rows)
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = keyed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(run, "a long, b long, crowded long")


def letter_counts(texts: list[str]) -> np.ndarray:
    """A row of counts for each text: its letters by bucket, then its pairs of neighbouring letters."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), size)
    width = LETTERS + COUPLES
    couple = np.flatnonzero(row[1:] == row[:-1])
    at = np.concatenate((row * width + code % LETTERS, row[couple] * width + LETTERS + (code[couple] * 31 + code[couple + 1]) % COUPLES))
    return np.bincount(at, minlength=len(texts) * width).reshape(len(texts), width).astype(np.int32)


def may_be_similar(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether counts allow an edit distance of ``most``: an edit changes one letter for another, and four pairs, at most."""
    change = a - b
    letters = change[..., :LETTERS]
    apart = np.maximum(np.maximum(letters, 0).sum(axis=-1), np.maximum(-letters, 0).sum(axis=-1)) > most
    return ~apart & (np.abs(change[..., LETTERS:]).sum(axis=-1) <= 4 * most)


def forest(lh: np.ndarray, text: list[str]) -> Iterator[tuple[list[str], list[str]]]:
    """Links that connect the lines exactly as all pairs within the radius and similar in edits would.

    A generator that asks for pairs of texts, gets whether they are similar, and returns the links. Lines are compared with
    all later ones that are not yet connected to them, more lines at once as long as few are found similar.
    """
    size, fp = np.fromiter(map(len, text), np.int64, len(text)), word_fingerprints(text)
    group, found, at, block = np.arange(len(text)), [], 0, 1
    while at < len(text) - 1:
        i, j = [], []
        for k in range(at, min(at + block, len(text) - 1)):
            near = k + 1 + np.flatnonzero(_near(fp[k + 1 :], size[k + 1 :], fp[k], size[k]) & (group[k + 1 :] != group[k]))
            i += [k] * len(near)
            j += near.tolist()
        at += block
        if not i:
            continue
        good = yield [text[k] for k in i], [text[k] for k in j]
        root = np.arange(len(text))
        links = 0
        for k in np.flatnonzero(good).tolist():
            a, b = (_root(root, group[x[k]]) for x in (i, j))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((int(lh[i[k]]), int(lh[j[k]])))
                links += 1
        group = np.array([_root(root, g) for g in range(len(text))])[group]
        block = min(2 * block, 1 + (1 << 18) // len(text)) if 8 * links < len(i) else 1
    return found


def _root(of: np.ndarray, x: int) -> int:
    while of[x] != x:
        x = of[x]
    return x


def crowded_links(crowded: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` between the lines ``crowded(key, lh)`` that share a key, by their texts; a key's lines are in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, many, asked = None, [], 0, []

        def solve() -> pa.RecordBatch:
            """The links of the keys held, whose pairs are compared together."""
            links, open_ = [], [(x, next(x, None)) for x in asked]
            while open_ := [(x, pairs) for x, pairs in open_ if pairs is not None]:
                good = edit_similar_all(*([t for _, pairs in open_ for t in pairs[k]] for k in (0, 1)), similarity)
                answers = np.split(good, np.cumsum([len(pairs[0]) for _, pairs in open_])[:-1])
                rest = []
                for (x, _), answer in zip(open_, answers, strict=True):
                    try:
                        rest.append((x, x.send(answer)))
                    except StopIteration as done:
                        links += done.value
                open_ = rest
            links = np.array(links, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(links.min(axis=1)), pa.array(links.max(axis=1))], ["a", "b"])

        def close() -> None:
            lh, text = zip(*held, strict=True)
            asked.append(forest(np.array(lh), list(text)))

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now and held:
                    close()
                    many, held = many + len(held), []
                    if many >= 2000:
                        yield solve()
                        many, asked = 0, []
                now = key
                held.append(row)
        if held:
            close()
            yield solve()

    both = crowded.join(texts, "lh").select("key", "lh", "text")
    tasks = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that few bytes aren't put in few tasks
    return both.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def linked(found: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The links ``(a, b)`` among the candidates ``found`` of :func:`line_pairs`; ``texts`` finds the lines of a table of lh."""
    pairs = stored(found.where("crowded is null").select("a", "b").distinct(), "open")
    crowded = found.where("crowded is not null").select(F.col("crowded").alias("key"), F.col("a").alias("lh"))
    ends = pairs.select(F.col("a").alias("lh")).unionByName(pairs.select(F.col("b").alias("lh"))).unionByName(crowded.select("lh"))
    needed = stored(texts(ends.distinct()), "needed")
    release(found.sparkSession)
    links = stored(similar(pairs, needed, similarity).unionByName(crowded_links(crowded, needed, similarity)), "similar")
    for done in (pairs, needed):
        forget(done)
    release(found.sparkSession)
    return links


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(lh, text)``: the normalised lines at ``wanted(lh, id, th, line)``."""
    listed = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("lh", "line")).alias("lines"))
    joined = docs.alias("d").join(listed.alias("w"), (F.col("d.th") == F.col("w.th")) & F.col("d.id").eqNullSafe(F.col("w.id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                texts, lines = batch.slice(begin, 256).columns
                raw = []
                for text, wanted in zip(texts.to_pylist(), lines.to_pylist(), strict=True):
                    split = text.split("\n")
                    raw += [split[x["line"]] for x in wanted]
                lh = lines.flatten().field("lh")
                yield pa.RecordBatch.from_arrays([lh, pa.array(all_normalised(raw), pa.string())], ["lh", "text"])

    return joined.select("d.text", "w.lines").mapInArrow(run, "lh long, text string").dropDuplicates(["lh"])


def _shared(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


#: Words that a changed passage may span when two lines are laid side by side; columns between looks at a column's least.
SPAN, LOOK = 12, 48


def _side_by_side(x: list[str], y: list[str], most: int) -> bool:
    """Whether words put between equal ones, in the nearest way found from left to right, cost ``most`` edits at most."""
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for far in range(1, 2 * SPAN):
            for a in range(max(0, far - SPAN), min(far, SPAN) + 1):
                if x[i + a : i + a + 2] == y[j + far - a : j + far - a + 2] != []:
                    break
            else:
                continue
            break
        else:
            break
        cost += max(sum(map(len, x[i : i + a])) + a, sum(map(len, y[j : j + far - a])) + far - a)
        if cost > most:
            return False
        i, j = i + a, j + far - a
    return cost + max(sum(map(len, x[i:])) + len(x) - i, sum(map(len, y[j:])) + len(y) - j) <= most


def _distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance, all cells of a column at once in the bits of a number.

    The least cell of a column never falls; beyond ``most`` it is returned for the distance, which is no less.
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    masks: dict[str, int] = {}
    for i, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top, size = (1 << len(b)) - 1, 1 << len(b) - 1, (len(b) + 7) // 8
    up, down, score = full, 0, len(b)
    look = LOOK if most is not None and len(b) > 2 * LOOK else 0
    for at, c in enumerate(a, 1):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        right, left = down | (full & ~(across | up)), up & across
        score += bool(right & top) - bool(left & top)
        right, left = (right << 1 | 1) & full, left << 1 & full
        eq |= down
        up, down = left | (full & ~(eq | right)), right & eq
        if look and at % look == 0 and at > most:
            steps = (np.unpackbits(np.frombuffer(x.to_bytes(size, "little"), np.uint8), bitorder="little") for x in (up, down))
            least = at + min(0, int(np.cumsum(np.subtract(*steps, dtype=np.int32)).min()))
            if least > most:
                return least
    return score


def edit_similar(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    """Whether one less the edit distance by the longer length is at least ``similarity``.

    Bounds settle many pairs: what is left between common ends, words replaced in place, words laid side by side.
    """
    most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    start = _shared(a, b)
    a, b = a[start:], b[start:]
    stop = _shared(a[::-1], b[::-1])
    a, b = a[: len(a) - stop], b[: len(b) - stop]
    if max(len(a), len(b)) <= most:
        return True
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y, strict=True) if p != q) <= most:
        return True
    return _side_by_side(x, y, most) or _distance(a, b, most) <= most


#: Longest lines that are compared beside others at once, and shortest whose words are laid side by side first.
SHORT, LONG = 256, 400
#: Longest line compared beside others, fewest lines to do so, and the numbers that their letters may take.
BESIDE, TOGETHER, TABLE = 4000, 32, 1 << 17


def edit_similar_all(a: list[str], b: list[str], similarity: float = SIMILARITY) -> np.ndarray:
    """:func:`edit_similar` of each pair, most of which are compared side by side."""
    good, rest = np.zeros(len(a), bool), []
    for k, (s, t) in enumerate(zip(a, b, strict=True)):
        most = int((1 - similarity) * max(len(s), len(t)) + 1e-9)
        if abs(len(s) - len(t)) > most:
            continue
        if max(len(s), len(t)) <= SHORT:
            rest.append((k, *((s, t) if len(s) >= len(t) else (t, s)), most))
            continue
        s, t = _trimmed(s, t)
        if max(len(s), len(t)) <= most:
            good[k] = True
            continue
        x, y = s.split(" "), t.split(" ")
        if len(x) == len(y) and sum([max(len(p), len(q)) for p, q in zip(x, y, strict=True) if p != q]) <= most:
            good[k] = True
        elif max(len(s), len(t)) > LONG and _side_by_side(x, y, most):
            good[k] = True
        elif max(len(s), len(t)) > BESIDE:
            good[k] = _distance(s, t, most) <= most
        else:
            rest.append((k, *((s, t) if len(s) >= len(t) else (t, s)), most))
    rest.sort(key=lambda x: len(x[1]))
    at = 0
    while at < len(rest):
        stop = at
        # as many as have a table of their letters, none much longer than the first
        while stop < len(rest) and len(rest[stop][1]) <= 64 + 1.25 * len(rest[at][1]) and (stop - at) * (len(rest[stop][1]) // 64 + 1) * 48 < TABLE:
            stop += 1
        stop = max(stop, at + 1)
        k, s, t, most = zip(*rest[at:stop], strict=True)
        if len(k) >= TOGETHER:
            most, found = np.array(most), np.zeros(len(k), bool)
            if len(s[0]) > SHORT:
                found = _within(list(s), list(t), most // 4)  # most similar pairs are within a quarter of the edits
            other = np.flatnonzero(~found)
            if len(other):
                found[other] = _within([s[i] for i in other.tolist()], [t[i] for i in other.tolist()], most[other])
            good[list(k)] = found
        else:
            good[list(k)] = [_distance(x, y, m) <= m for x, y, m in zip(s, t, most, strict=True)]
        at = stop
    return good


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Two texts without the ends they share."""
    start = _shared(a, b) if a[:32] == b[:32] else _shared(a[:32], b[:32])
    a, b = a[start:], b[start:]
    x, y = a[-32:][::-1], b[-32:][::-1]
    stop = _shared(a[::-1], b[::-1]) if x == y else _shared(x, y)
    return a[: len(a) - stop], b[: len(b) - stop]


def _within(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Whether the Levenshtein distance of each pair is ``most`` at most; no ``b`` is longer than its ``a``.

    As in :func:`_distance`, for all pairs at once, each column cut into words of 64 bits. Word w is a column behind word
    w - 1, whose last step it carries on, so that all words of all pairs move together. All ``a`` are filled up to one
    length by a letter that their ``b`` get too, which changes no distance. Words further from the diagonal than ``most``
    rest, which makes no cell less and none of up to ``most`` greater, and pairs leave when the least cell of the front,
    which no path gets around, is too large.
    """
    size, other = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    length = int(size.max())
    other = other + length - size
    pairs, words = len(a), int(other.max() + 63) // 64
    raw = [np.frombuffer("".join(x).encode("utf-32-le", "surrogatepass"), "<u4") for x in (a, b)]
    used = np.zeros(int(max(x.max(initial=0) for x in raw)) + 1, bool)
    for x in raw:
        used[x] = True
    number = np.cumsum(used) + 1  # 0 is no letter, 1 fills up
    letters = int(number[-1]) + 1
    if pairs > 1 and pairs * letters * words > 4 * TABLE:
        half = pairs // 2
        return np.concatenate([_within(a[x], b[x], most[x]) for x in (slice(half), slice(half, None))])

    def laid(code: np.ndarray, many: np.ndarray, full: np.ndarray, rows: int) -> np.ndarray:
        """A column of letters for each text."""
        out = np.zeros((pairs, rows), np.int64)
        place = np.arange(rows)
        out[place < full[:, None]] = 1
        out[place < many[:, None]] = number[code]
        return np.ascontiguousarray(out.T)

    down_by = laid(raw[1], other - (length - size), other, 64 * words)
    mask = np.zeros((pairs * letters, words), np.uint64)
    base = np.arange(pairs) * letters
    for k in range(64 * words):
        mask[base + down_by[k], k >> 6] |= np.uint64(1 << (k & 63))
    mask[base] = 0
    mask = mask.ravel()
    across = np.zeros((length + 2 * words, pairs), np.int64)  # row k + words is column k
    across[words : words + length] = laid(raw[0], size, np.full(pairs, length), length)
    across = (across + base) * words
    word = np.arange(words)[:, None]
    one, top = np.uint64(1), np.uint64(63)
    up, down = np.full((words, pairs), ~np.uint64(0)), np.zeros((words, pairs), np.uint64)
    rise, fall = np.zeros((words + 1, pairs), np.int64), np.zeros((words + 1, pairs), np.int64)
    score = np.repeat(64 * (word + 1), pairs, axis=1)  # of each word's last cell
    last, ends = np.zeros((2, words, pairs), np.uint64), np.zeros((words, pairs), np.int64)
    alive, good, begun, reach = np.arange(pairs), np.zeros(pairs, bool), 0, int(most.max())
    look = max(int(1.8 * most.min()), 8)
    for k in range(length + words - 1):
        low, high = max(0, min(words - 1, (k - reach) // 65 - 1)), min(words, (k + reach + 2) // 65 + 1)
        if high > begun:
            if begun:
                score[begun] = score[begun - 1] - rise[begun] + fall[begun] + 64
            begun = high
        rise[low], fall[low] = 1, 0
        eq = mask.take(across[k + words - high + 1 : k + words - low + 1][::-1] + word[low:high])
        p, m, plus, minus = up[low:high], down[low:high], rise[low:high].view(np.uint64), fall[low:high].view(np.uint64)
        both = eq | m
        eq |= minus
        x = (((eq & p) + p) ^ p) | eq
        right = m | ~(x | p)
        left = p & x
        plus, minus = (right << one) | plus, (left << one) | minus
        up[low:high] = minus | ~(both | plus)
        down[low:high] = plus & both
        rise[low + 1 : high + 1], fall[low + 1 : high + 1] = right >> top, left >> top
        score[low:high] += rise[low + 1 : high + 1]
        score[low:high] -= fall[low + 1 : high + 1]
        if k >= length - 1:
            w = k - length + 1
            last[:, w], ends[w] = (up[w], down[w]), score[w]
        elif k >= look:
            look = k + 48
            bits = [np.unpackbits(x[low:high].view(np.uint8).reshape(high - low, -1, 8), axis=-1, bitorder="little").view(np.int8) for x in (up, down)]
            least = np.cumsum((bits[1] - bits[0])[:, :, ::-1], axis=-1, dtype=np.int8).min(axis=-1)  # from each word's end
            keep = (score[low:high] + np.minimum(least, 0)).min(axis=0) <= most + 1
            if keep.sum() < 0.75 * len(keep):
                alive, most, other, last = alive[keep], most[keep], other[keep], last.compress(keep, axis=2)
                across, up, down, rise, fall, score, ends = (x.compress(keep, axis=1) for x in (across, up, down, rise, fall, score, ends))
                if not len(alive):
                    return good
    final = np.maximum(other - 1, 0) // 64
    at, place = (other - 64 * final).astype(np.uint64), np.arange(len(alive))
    beyond = np.where(at == 64, 0, ~np.uint64(0) << (at & top))
    beyond = [np.bitwise_count(x[final, place] & beyond).astype(np.int64) for x in last]
    good[alive] = ends[final, place] - beyond[0] + beyond[1] <= most
    return good


def similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose texts are similar enough in edits."""
    both = pairs.join(texts.select(F.col("lh").alias("a"), F.col("text").alias("s")), "a")
    both = both.join(texts.select(F.col("lh").alias("b"), F.col("text").alias("t")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = edit_similar_all(batch.column(2).to_pylist(), batch.column(3).to_pylist(), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def drop_lists(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(id, th, gone)``: the numbers of the lines to remove from each text that loses any."""
    spark = docs.sparkSession
    seen = stored(occurrences(docs), "occurrences")
    each = stored(seen.where("lh is not null").select("id", "th", "line", "lh"), "each")
    lines = each.groupBy("lh").agg(F.count("*").alias("n"), F.min(F.struct("id", "line", "th")).alias("at"))
    lines = stored(lines, "lines")
    release(spark)
    found = []
    for turn in range(PASSES):
        found.append(stored(line_pairs(keyed_lines(seen, turn), similarity), "pairs"))
        release(spark)
    forget(seen)  # the keys are most of what is on disk

    def texts(wanted: DataFrame) -> DataFrame:
        return _texts(docs, lines.join(wanted, "lh", "left_semi").select("lh", "at.id", "at.th", "at.line"))

    group = components(linked(reduce(DataFrame.unionByName, found), texts, similarity)).withColumnRenamed("node", "lh")
    group = lines.join(group, "lh", "left").where("n > 1 or component is not null")  # the others are alone
    group = stored(group.select("lh", "n", "at", F.coalesce("component", "lh").alias("g")), "groups")
    keep = group.groupBy("g").agg(F.sum("n").alias("all"), F.min("at").alias("keep")).where("all > 1")
    keep = stored(group.join(keep, "g").select("lh", "keep"), "keep")
    gone = each.join(keep, "lh").where(~F.struct("id", "line", "th").eqNullSafe(F.col("keep")))
    gone = stored(gone.groupBy("id", "th").agg(F.collect_set("line").alias("gone")), "gone")
    forget(each)
    release(spark)
    return gone


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the text cut to the lines kept, and a last column ``lines_removed`` (array of line numbers).

    Lines end at line feeds. Lines without a word stay. Of a group the occurrence with the smallest id (null first) and
    line number stays. Null texts stay null; a text may lose all lines and is then empty. Rows that repeat both id and
    text count as one document and fare alike. Other columns pass unchanged, whatever their names.
    """
    keys = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text")
    )
    gone = drop_lists(keys, similarity)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    row = row.withColumns({"id": F.col(f"row.`{id_col}`"), "th": F.xxhash64(F.coalesce("text", F.lit("")))})
    on = (F.col("d.th") == F.col("g.th")) & F.col("d.id").eqNullSafe(F.col("g.id"))
    joined = row.alias("d").join(gone.alias("g"), on, "left").select("d.row", "g.gone")
    at = docs.columns.index(text_col)
    names = [*docs.columns, "lines_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(0).field(at)
            removed = [sorted(g) if g else [] for g in batch.column(1).to_pylist()]
            new = []
            for i, numbers in enumerate(removed):
                if numbers:
                    drop = set(numbers)
                    new.append("\n".join(x for k, x in enumerate(text[i].as_py().split("\n")) if k not in drop))
            changed = pa.array([bool(r) for r in removed], pa.bool_())
            columns = [batch.column(0).field(i) for i in range(len(names) - 1)]
            columns[at] = pc.replace_with_mask(text, changed, pa.array(new, text.type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.list_(pa.int32()))], names=names)

    fields = [*docs.schema.fields, T.StructField("lines_removed", T.ArrayType(T.IntegerType()))]
    return joined.mapInArrow(run, T.StructType(fields))

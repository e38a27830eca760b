"""Best-two-fit packing of tokenized documents into fixed-length sequences.

A sequence is filled greedily with the longest piece that fits. Its smallest piece is then taken out and replaced by
two unpacked pieces that fit the widened gap more tightly, as long as such a pair exists. Pieces are dealt at random
over packing tasks of a bounded number of pieces; each packs its own, so the loss against one large packer is less
than a sequence or two a task.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import stored

CAPACITY = 2048
END = 0
#: Pieces a packing task takes on average; sequence numbers leave room for 2^40 in a task.
PIECES_PER_TASK = 60_000

PIECE_FIELDS = [
    ("piece", T.IntegerType()),
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("ids_crc32", T.LongType()),
]


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a tokenizers JSON file of a byte-level BPE, as bytes with their ranks.

    The file writes each byte as a printable character: itself where it is one, else the next from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}


#: Fixed value: how the tokenizer splits a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Fixed value: white space as the word pattern sees it.
BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space from this length on are cut out before the pattern, which could not match very long ones. The
#: pattern makes all of a run but its last character one word (all of it at the end), so the ids are the same.
LONG_BLANK = 256
_blanks = re.compile(f"[{BLANK}]{{{LONG_BLANK},}}").finditer


def between_blanks(text: str) -> Iterator[tuple[str, bool]]:
    """The text in parts, with whether a part is one word of white space."""
    at = 0
    for run in _blanks(text):
        stop = run.end() - (run.end() < len(text))
        yield text[at : run.start()], False
        yield text[run.start() : stop], True
        at = stop
    yield text[at:], False


def text_encoder(path: str, added_tokens: bool = False):
    """A function from a text to its ids as native 32-bit bytes, for the byte-level BPE at ``path``.

    With ``added_tokens`` the file's added tokens, where a text spells them out, become their own ids, as tokenizers
    does by default; without, they are text like any other (its ``encode_special_tokens``). The merges are run by
    tiktoken, which is several times faster than tokenizers and gives the same ids, but for long words of white space,
    which tokenizers itself encodes.
    """
    import tiktoken
    import tokenizers

    special = {}
    if added_tokens:
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that strip spaces or want whole words are not supported")
        special = {t["content"]: t["id"] for t in added}
    tokenizer = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    marked = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    blank = cache(lambda: tokenizers.Tokenizer.from_file(path))

    def encode(text: str) -> bytes:
        ids = array("I")
        for i, plain in enumerate(marked.split(text) if marked else [text]):
            if i % 2:
                ids.append(special[plain])
                continue
            for part, is_blank in between_blanks(plain):
                if is_blank:
                    ids.extend(blank().encode(part, add_special_tokens=False).ids)
                elif part:
                    ids.extend(tokenizer.encode_ordinary(part))
        return ids.tobytes()

    return encode


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    added_tokens: bool = False,
) -> DataFrame:
    """``(id, row, piece, start, length, ids_crc32)``: every document's ids and one end id, cut if longer than a sequence.

    The first piece takes what whole sequences leave over, so all others are full. Null texts are empty.
    """
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in PIECE_FIELDS]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(tokenizer_path, added_tokens)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, text in enumerate(batch.column(1)):
                data = encode(text.as_py() or "") + end
                n = len(data) // 4
                cut = n % capacity or capacity
                for piece, stop in enumerate(range(cut, n + 1, capacity)):
                    start = max(0, stop - capacity)
                    rows.append((i, piece, start, stop - start, zlib.crc32(data[4 * start : 4 * stop])))
            at, piece, start, length, crc = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["id", *[n for n, _ in PIECE_FIELDS]],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Lengths:
    """The lengths still to be packed, with counts, and the longest at most a bound in constant time per 64 lengths."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.present = sum(1 << n for n, c in enumerate(self.count) if c)

    def longest(self, bound: int) -> int:
        """0 if there is none."""
        return (self.present & ((1 << (bound + 1)) - 1)).bit_length() - 1 if bound > 0 and self.present else 0

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.present ^= 1 << n

    def put(self, n: int) -> None:
        self.count[n] += 1
        self.present |= 1 << n

    def best_two(self, gap: int, than: int) -> tuple[int, int] | None:
        """The two lengths with the largest sum in ``(than, gap]``, the longer one first."""
        best, found = than, None
        a = self.longest(gap - 1)
        while a > 0 and 2 * a > best:
            b = self.longest(min(gap - a, a))
            if b == a and self.count[a] < 2:
                b = self.longest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            a = self.longest(a - 1)
        return found


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of lengths, each bin's sum at most the capacity."""
    left, bins = Lengths(lengths, capacity), []
    while left.present:
        room, held = capacity, []
        while (n := left.longest(room)) > 0:
            left.take(n)
            held.append(n)
            room -= n
        while room and len(held) > 1:
            small = held[-1]
            two = left.best_two(room + small, small)
            if two is None:
                break
            held.pop()
            left.put(small)
            for n in two:
                left.take(n)
                held.append(n)
            room += small - sum(two)
            held.sort(reverse=True)
        bins.append(held)
    return bins


def pack(cut: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``cut`` (any columns, with ``length`` from 1 to the capacity) with ``sequence_id`` and ``offset``."""
    names = cut.columns
    n_tasks = max(1, -(-cut.count() // pieces_per_task))
    place = F.monotonically_increasing_id()  # equal rows are dealt apart
    salt = F.pmod(F.xxhash64(*[c for c in names], place), F.lit(n_tasks)).alias("_task")
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        tasks = table["_task"].to_numpy()
        for task in np.unique(tasks):
            rows = np.flatnonzero(tasks == task)
            part = table.select(names).take(pa.array(rows))
            lengths = part["length"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            first = np.searchsorted(lengths[order], np.arange(capacity + 2)).tolist()
            sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
            for i, held_lengths in enumerate(best_two_fit(lengths, capacity)):
                at = 0
                for n in held_lengths:
                    row = order[first[n]]
                    first[n] += 1
                    sequence[row], offset[row] = (int(task) << 40) + i, at
                    at += n
            part = part.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
            yield from part.combine_chunks().to_batches(max_chunksize=20_000)

    return cut.withColumn("_task", salt).repartition(n_tasks, "_task").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is one piece of the end id. Equal rows are packed each for itself; null ids are kept; extra
    columns are ignored; an empty table gives no rows.
    """
    cut = stored(pieces(docs, tokenizer_path, id_col, text_col, capacity, added_tokens), "pieces")
    return pack(cut, capacity)

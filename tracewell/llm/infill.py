"""Fill-in-middle rearrangement of documents, a whole batch at a time with Arrow's compute functions.

Texts are split into units that become list arrays. The lists are flattened with the index of their parent, each
unit's ordinal in its text decides its role (prefix, middle or suffix), each role's units are filtered, made into lists
again and joined. Nothing runs per row in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of documents that are rearranged, and of those that put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
#: A unit is white space and the word behind it, or the white space a text ends with. White space is ASCII only, so
#: bytes can stand for code points.
UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
#: No UTF-8 text holds this byte, so it can mark the end of a unit.
CUT = b"\xff"
#: Bytes of text that are worked on at once; a longer text is a part of its own.
PART_BYTES = 1 << 23

BYTES = pa.large_binary()


def split_units(texts: pa.Array) -> pa.Array:
    """A list array of every text's units and one empty unit behind the last."""
    marked = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + CUT)
    return pc.split_pattern(marked, pattern=CUT)


def joined(units: pa.Array, parents: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """For every row the chosen ones of its units, joined."""
    starts = np.zeros(rows + 1, np.int32)
    np.cumsum(np.bincount(parents[chosen], minlength=rows), out=starts[1:])
    lists = pa.ListArray.from_arrays(pa.array(starts), pc.filter(units, pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar(b"", BYTES))


def characters(texts: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(pc.cast(texts, pa.large_string())), pa.int64())


def rearranged(texts: pa.Array, draws: list[np.ndarray], rate: int, suffix_first: int) -> dict[str, pa.Array]:
    """The new columns for texts (large binary, no nulls) and their four draws."""
    lists = split_units(texts)
    counts = pc.subtract(pc.list_value_length(lists), 1).to_numpy(zero_copy_only=False).astype(np.int64)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    firsts = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
    ordinals = np.arange(len(units)) - firsts[parents]

    cuts = [draw % (counts + 1) for draw in draws[:2]]
    low, high = np.minimum(*cuts), np.maximum(*cuts)
    is_prefix, is_suffix = ordinals < low[parents], ordinals >= high[parents]
    prefix, middle, suffix = (
        joined(units, parents, role, len(texts)) for role in (is_prefix, ~is_prefix & ~is_suffix, is_suffix)
    )
    marks = {m: pa.scalar(m.encode(), BYTES) for m in (PREFIX, SUFFIX, MIDDLE)}
    held = [pc.match_substring(texts, m) for m in (PREFIX, SUFFIX, MIDDLE)]
    marked = pc.or_(pc.or_(held[0], held[1]), held[2])
    plain = pc.or_(pc.or_(marked, pc.equal(pc.binary_length(texts), 0)), pa.array(draws[2] % 100 >= rate))
    first = pa.array(draws[3] % 100 < suffix_first)
    end = pa.scalar(b"", BYTES)
    spm = pc.binary_join_element_wise(marks[SUFFIX], suffix, marks[PREFIX], prefix, marks[MIDDLE], middle, end)
    psm = pc.binary_join_element_wise(marks[PREFIX], prefix, marks[SUFFIX], suffix, marks[MIDDLE], middle, end)
    none = pa.scalar(None, pa.int64())
    return {
        "n_units": pa.array(counts),
        "form": pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, characters(prefix)),
        "middle_chars": pc.if_else(plain, none, characters(middle)),
        "output": pc.if_else(plain, texts, pc.if_else(first, spm, psm)),
    }


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of a bounded number of bytes in its last column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def draws(id_: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that depend on the seed and the id only."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``(id, n_units, form, prefix_chars, middle_chars, output)`` of every document.

    The form is ``plain`` (the text itself), ``psm`` or ``spm``. Null texts are empty; empty texts and those that hold a
    mark stay plain. Null ids draw as an empty id. Texts are used whole; long ones are worked on one at a time. Repeated
    rows each give a row, equal ids draw alike, extra columns are ignored, and an empty table gives no rows.
    """
    kinds = "n_units long, form string, prefix_chars long, middle_chars long, output binary"
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL(kinds).fields])
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                numbers = [part.column(1 + i).to_numpy() for i in range(4)]
                found = rearranged(pc.cast(part.column(5), BYTES), numbers, rate, suffix_first)
                found["output"] = pc.cast(found["output"], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *found.values()], schema.names)

    rows = docs.select(F.col(id_col).alias("id"), *draws(F.col(id_col), seed), text)
    return rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. A rearranged output holds each mark once, at the borders of its pieces."""
    pieces = F.split(F.substring(output, len(PREFIX) + 1, 2**31 - 1), "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    psm, spm = F.concat(pieces[0], pieces[2], pieces[1]), F.concat(pieces[1], pieces[2], pieces[0])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart have a word in between, at most half the radius from either. Every
fingerprint therefore emits all variants within half the radius; fingerprints meet on equal variants and colliding
pairs are deduplicated and verified. With ``parts=1`` the ball is that of the whole word (2081 variants at radius 4).
With ``parts=2`` the word is cut in two: one half differs in at most half the bits, so each half emits its own ball,
of half that radius (66 variants at radius 4). Both give the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import components, stored

SHINGLE_WORDS = 4
RADIUS = 4
#: Buckets of up to so many fingerprints are linked within one task, by vectors; larger ones meet on whole-word balls.
LINKED = 20_000


def text_fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts, stops = (stops - lengths).tolist(), stops.tolist()
    if len(words) > width:
        starts, stops = starts[: len(words) - width + 1], stops[width - 1 :]
    else:
        starts, stops = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)`` for every row: words are runs of other than ASCII white space, lower-cased in A-Z, shingles repeat."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [text_fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed 64-bit numbers."""
    masks = [sum(1 << i for i in some) for r in range(radius + 1) for some in combinations(range(bits), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def variants(words: DataFrame, radius: int, parts: int) -> DataFrame:
    """``(key, fp)``: each part of the word with every mask of its ball; the key tells the parts apart."""
    bits = 64 // parts
    masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, -(-(radius // parts) // 2))])
    if parts == 1:
        return words.select("fp", F.explode(masks).alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("key"), "fp")
    cut = F.lit((1 << bits) - 1).cast("long")
    each = [
        F.shiftrightunsigned("fp", bits * p).bitwiseAND(cut).bitwiseOR(F.lit(p << 32).cast("long")) for p in range(parts)
    ]
    spread = words.select("fp", F.explode(F.array(*each)).alias("word")).select("fp", "word", F.explode(masks).alias("m"))
    return spread.select(F.col("word").bitwiseXOR(F.col("m")).alias("key"), "fp")


def near(a: str, b: str, radius: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(words: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect distinct fingerprints as all pairs within the radius would: a breadth-first tree of each group."""
    found, rest = [], words
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            word = queue.pop()
            close = _apart(rest, word) <= radius
            if close.any():
                found += [(word, x) for x in rest[close]]
                queue += list(rest[close])
                rest = rest[~close]
    return found


def bucket_links(keyed: DataFrame, radius: int, all_pairs: int = 0, trees: int = 1) -> DataFrame:
    """Links ``(a, b)``, a < b, among the distinct fingerprints of each bucket of ``keyed(key, fp)``.

    Buckets of up to ``all_pairs`` give all their pairs within the radius, others trees that connect the same groups.
    A bucket beyond ``LINKED`` is only named by its key; its fingerprints meet on whole-word balls instead, where the
    smallest of each ball stands for all. So work is linear in the rows whatever a bucket's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "crowded"]
        every = {n: np.triu_indices(n, 1) for n in range(3, all_pairs + 1)}

        def solve(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            size = np.diff(edge)
            two = edge[:-1][size == 2]
            close = two[_apart(fp[two], fp[two + 1]) <= radius]
            a, b, crowded = [fp[close]], [fp[close + 1]], []
            for begin, n in zip(edge[:-1][size > 2], size[size > 2], strict=True):
                some = fp[begin : begin + n]
                if n > LINKED:
                    crowded.append(key[begin])
                elif n <= all_pairs:
                    i, j = every[n]
                    good = _apart(some[i], some[j]) <= radius
                    a.append(some[i][good])
                    b.append(some[j][good])
                else:
                    for tree in range(trees):
                        order = np.random.default_rng(tree).permutation(some) if tree else np.sort(some)
                        links = spanning_links(order, radius)
                        a.append(np.array([x for x, _ in links], np.int64))
                        b.append(np.array([y for _, y in links], np.int64))
            a, b = np.concatenate(a), np.concatenate(b)
            none = [None] * len(crowded)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*np.minimum(a, b), *none], pa.int64()),
                    pa.array([*np.maximum(a, b), *none], pa.int64()),
                    pa.array([*[None] * len(a), *crowded], pa.int64()),
                ],
                names,
            )

        rest_key, rest_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            key = np.concatenate((rest_key, batch.column(0).to_numpy()))
            fp = np.concatenate((rest_fp, batch.column(1).to_numpy()))
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield solve(key[:last], fp[:last])
            # of a crowded bucket only enough is held to know it by
            rest_key, rest_fp = key[last:][: LINKED + 1], fp[last:][: LINKED + 1]
        if len(rest_key):
            yield solve(rest_key, rest_fp)

    grouped = keyed.repartition("key").sortWithinPartitions("key")
    found = stored(grouped.mapInArrow(run, "a long, b long, crowded long").distinct(), "bucket_links")
    links = found.where("a is not null").select("a", "b")
    crowded = found.where("crowded is not null").select(F.col("crowded").alias("key"))
    if crowded.isEmpty():
        return links
    hot = stored(keyed.join(crowded, "key").select("fp").distinct(), "crowded")
    whole = stored(variants(hot, radius + radius % 2, 1), "balls")
    hubs = stored(whole.groupBy("key").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")
    star = whole.join(hubs, "key").where("fp <> hub").where(near("fp", "hub", radius))
    return links.unionByName(star.select(F.col("hub").alias("a"), F.col("fp").alias("b"))).distinct()


def links(words: DataFrame, radius: int = RADIUS, parts: int = 2) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fp`` exactly as all pairs within ``radius`` would."""
    return bucket_links(variants(words, radius, parts), radius)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    parts: int = 2,
) -> DataFrame:
    """One row per input row: ``id, fp, component_id``, the component named by the smallest id it reaches.

    Equal fingerprints are one node, so groups of copies cost one row each. Texts without words (null, empty, blank)
    have fingerprint zero and link like any other. Null ids take part but name a component only if it has no other
    id. Repeated rows give repeated rows; extra columns are ignored. An empty table gives no rows.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    prints = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    words = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "words")
    group = components(links(words.select("fp"), radius, parts))
    member = words.join(group.withColumnRenamed("node", "fp"), "fp", "left")
    member = stored(member.select("fp", "first", F.coalesce("component", "fp").alias("component")), "members")
    names = member.groupBy("component").agg(F.min("first").alias("component_id"))
    names = stored(member.join(names, "component").select("fp", "component_id"), "names")
    return prints.join(names, "fp").select("id", "fp", "component_id")



def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group one row, that with the smallest id (null last).

    Of rows that repeat both id and text one stays. Columns pass unchanged, whatever their names.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, own = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    row = row.withColumns({"th": F.xxhash64(F.coalesce(text, F.lit(""))), "own": own})
    key = F.struct(F.col("own").isNull().alias("none"), "own", "th")
    found = near_duplicates(row.select(key.alias("id"), text.alias("text")), "id", "text", **how)
    kept = stored(found.where("id = component_id").groupBy("id.own", "id.th").agg(F.count("*").alias("n")), "kept")

    def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
        on = (F.col("r.th") == F.col("k.th")) & F.col("r.own").eqNullSafe(F.col("k.own"))
        return rows.alias("r").join(keys.alias("k"), on, "left_semi")

    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return among(row, kept).select("row.*")
    single = among(row, repeated).dropDuplicates(["own", "th"])
    return among(row, kept.where("n = 1")).unionByName(single).select("row.*")

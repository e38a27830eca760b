"""Benchmark decontamination by latent semantic retrieval.

Documents are read as overlapping passages. The passages' TF-IDF matrix, over the terms that the benchmark knows and
that are rare enough to tell passages apart, gets a distributed randomised SVD; benchmark items and passages are
compared by cosine in the latent space, and candidates are verified by their longest common subsequence of words and
by the item's answer, its last sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import stored

#: Passages are two neighbouring halves of so many words; item parts have at most one half.
HALF = 64
RANK = 128
#: A term in a larger share of the passages has no weight, unless it is one of an item's rarest terms.
COMMON_SHARE = 0.002
RAREST = 8
#: What a term weighs at least, if it has weight: the words of an item that leaked into many documents are common there.
LEAST_WEIGHT = 2.0
COSINE = 0.35
LCS_SHARE = 0.6
#: With the whole answer in the passage, this share of the item is enough.
LCS_SHARE_WITH_ANSWER = 0.5
#: Item parts compared in one go; more are done in blocks of so many.
BLOCK_ITEMS = 4000
SEED = 11

find_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return find_words((text or "").lower())


@dataclass
class Part:
    item: object
    words: list[int]
    answer: list[int]


def item_parts(rows: list[tuple[object, str | None]]) -> tuple[list[Part], dict[str, int]]:
    """The items in parts of at most one half, the last one ending with the item, and the terms' numbers."""
    terms: dict[str, int] = {}
    parts = []
    for item, text in rows:
        words = [terms.setdefault(w, len(terms)) for w in words_of(text)]
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", (text or "").strip()) if find_words(s)]
        answer = [terms[w] for w in words_of(sentences[-1])][-HALF:] if sentences else []
        starts = list(range(0, max(1, len(words) - HALF + 1), HALF))
        if len(words) > HALF and starts[-1] + HALF < len(words):
            starts.append(len(words) - HALF)
        parts += [Part(item, words[s : s + HALF], answer) for s in starts if words]
    return parts, terms


def common_subsequence(masks: dict[int, int], length: int, other: list[int]) -> int:
    """The length of the longest common subsequence; ``masks`` has the places of each term in the one of ``length``."""
    full = (1 << length) - 1
    row = full
    for term in other:
        if mask := masks.get(term):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def term_numbers(texts: list[str | None], terms: dict[str, int]) -> list[list[int]]:
    get = terms.get
    return [[get(w, -1) for w in words_of(x)] for x in texts]


def numbered(docs: DataFrame, terms: dict[str, int]) -> DataFrame:
    """``(id, th, words)``: the texts of ``docs(id, th, text)`` as numbers of terms, -1 for words that aren't any. Texts are read
    once here; what follows reads the numbers, which take a fraction of their room."""
    schema = T.StructType([docs.schema["id"], docs.schema["th"], T.StructField("words", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                words = pa.array(term_numbers(part.column(2).to_pylist(), terms), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), words], schema.names)

    return stored(docs.select("id", "th", "text").mapInArrow(run, schema), "words")


def parts_of(lists: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Up to 500 lists at a time: the first one's place, all their numbers, and their sizes."""
    for begin in range(0, len(lists), 500):
        part = lists.slice(begin, 500)
        offsets = part.offsets.to_numpy()
        yield begin, part.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), np.diff(offsets).astype(np.int64)


def passage_terms(flat: np.ndarray, size: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of each passage the different terms with weight: text, number in the text and term, ascending; all passages. Texts
    come as one array of terms and their sizes."""
    halves = -(-size // HALF)
    last = np.maximum(halves - 2, 0)
    at = np.flatnonzero((flat >= 0) & (weight[flat] > 0))
    starts = np.cumsum(size) - size
    text = np.searchsorted(starts, at, side="right") - 1
    half = (at - starts[text]) // HALF
    text, half, term = np.concatenate((text, text)), np.concatenate((half, half - 1)), np.tile(flat[at], 2)
    good = (half >= 0) & (half <= last[text])
    text, half, term = text[good], half[good], term[good]
    base = np.cumsum(last + 1) - (last + 1)
    code = np.unique((base[text] + half) * len(weight) + term)
    number, term = code // len(weight), code % len(weight)
    text = np.searchsorted(base, number, side="right") - 1
    return text, number - base[text], term, int((last + 1)[size > 0].sum())


def document_frequencies(words: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many passages each term is, and the number of passages. Bounded by the terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(n_terms + 1, np.int64), 0
        for batch in batches:
            for _, flat, size in parts_of(batch.column(0)):
                _, _, term, n = passage_terms(flat, size, np.ones(n_terms))
                count[:n_terms] += np.bincount(term, minlength=n_terms)
                total += n
        count[n_terms] = total
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["term", "n"])

    table = words.select("words").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(n_terms + 1, np.int64)
    count[table["term"].to_numpy()] = table["n"].to_numpy()
    return count[:n_terms], int(count[n_terms])


def term_weights(frequency: np.ndarray, passages: int, parts: list[Part]) -> np.ndarray:
    """The terms' inverse document frequencies; common ones have none, but each part keeps its rarest terms.

    Terms that no passage has count for nothing: of an item whose words are common because many copies of it leaked, the
    words that the copies replaced would otherwise be all that is left.
    """
    idf = np.log((1.0 + passages) / (1.0 + frequency)) + 1e-3
    kept = (frequency > 0) & (frequency <= max(20.0, COMMON_SHARE * passages))
    for part in parts:
        own = np.unique(part.words)
        own = own[frequency[own] > 0]
        kept[own[np.argsort(frequency[own], kind="stable")[:RAREST]]] = True
    return np.where(kept, np.maximum(idf, LEAST_WEIGHT), 0.0)


def passage_rows(words: DataFrame, weight: np.ndarray) -> DataFrame:
    """The terms with weight of every passage that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, flat, size in parts_of(batch.column(0)):
                text, number, term, _ = passage_terms(flat, size, weight)
                edge = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
                offsets = pa.array(np.concatenate((edge, [len(term)])).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([lists], ["terms"])

    return words.select("words").mapInArrow(run, "terms array<int>")


def _rows_times(values: np.ndarray, begin: np.ndarray, columns: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows, each from ``begin`` on, times a matrix."""
    return np.add.reduceat(values[:, None] * matrix[columns], begin, axis=0)


def _normed(weight: np.ndarray, term: np.ndarray, begin: np.ndarray) -> np.ndarray:
    value = weight[term]
    norm = np.sqrt(np.add.reduceat(value**2, begin))
    return value / np.repeat(norm, np.diff(np.concatenate((begin, [len(term)]))))


def gram_times(rows: DataFrame, weight: np.ndarray, matrix: np.ndarray | None, rank: int) -> np.ndarray:
    """AᵀA times a matrix over the passages A: each task adds up its share, shares are added up term by term.

    ``None`` stands for the random matrix, which every task draws from the same seed.
    """
    n_terms = len(weight)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = matrix if matrix is not None else np.random.default_rng(SEED).standard_normal((n_terms, rank)).astype(np.float32)
        out, seen = np.zeros((n_terms, rank)), False
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                lists = batch.column(0).slice(at, 4000)
                offsets = lists.offsets.to_numpy()
                term = lists.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)
                if not len(term):
                    continue
                begin = (offsets[:-1] - offsets[0]).astype(np.int64)
                value = _normed(weight, term, begin).astype(np.float32)
                z = _rows_times(value, begin, term, by)
                z = np.repeat(z, np.diff(np.concatenate((begin, [len(term)]))), axis=0) * value[:, None]
                order = np.argsort(term, kind="stable")
                edge = np.flatnonzero(np.diff(term[order], prepend=-1))
                out[term[order][edge]] += np.add.reduceat(z[order], edge, axis=0)
                seen = True
        if seen:
            some = np.flatnonzero(np.abs(out).sum(axis=1))
            for part in np.array_split(some, -(-len(some) // 2000)):
                flat = pa.array(out[part].astype(np.float32).ravel())
                lists = pa.FixedSizeListArray.from_arrays(flat, rank).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(part), lists], ["term", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, rank)
            for term, v in zip(batch.column(0).to_pylist(), values, strict=True):
                total[term] = total[term] + v if term in total else v.astype(np.float64)
        if total:
            lists = pa.array([v.astype(np.float32) for v in total.values()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), lists], ["term", "v"])

    schema = "term long, v array<float>"
    table = rows.mapInArrow(share, schema).repartition("term").mapInArrow(add, schema).toArrow()
    out = np.zeros((n_terms, rank))
    if table.num_rows:
        out[table["term"].to_numpy()] = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, rank)
    return out


def latent_space(rows: DataFrame, weight: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors (terms by rank) of the passages, by a randomised range finder.

    One pass samples the range, a second one applies AᵀA once more; the small matrix QᵀAᵀAQ gives the vectors.
    """
    q, _ = np.linalg.qr(gram_times(rows, weight, None, rank))
    again = gram_times(rows, weight, q.astype(np.float32), rank)
    energy, u = np.linalg.eigh(q.T @ again)
    return (q @ u[:, np.argsort(-energy)]).astype(np.float32)


def latent(space: np.ndarray, weight: np.ndarray, term: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space; what has no share in it stays zero."""
    z = _rows_times(_normed(weight, term, begin).astype(np.float32), begin, term, space)
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    return np.where(norm > 1e-6, z / np.maximum(norm, 1e-6), 0.0).astype(np.float32)


MATCH_FIELDS = [("item", None), ("passage", T.IntegerType()), ("cosine", T.DoubleType()), ("lcs_share", T.DoubleType()), ("answer_share", T.DoubleType())]


def _search(docs: DataFrame, items: DataFrame, parts: list[Part], terms: dict[str, int], rank: int) -> DataFrame:
    words = numbered(docs, terms)
    frequency, passages = document_frequencies(words, len(terms))
    weight = term_weights(frequency, passages, parts)
    schema = T.StructType(
        [docs.schema["id"], docs.schema["th"], *[T.StructField(n, t or items.schema["item"].dataType) for n, t in MATCH_FIELDS]]
    )
    parts = [p for p in parts if (weight[p.words] > 0).any()]  # no passage has a word of the others
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    rank = min(rank, len(weight))
    rows = stored(passage_rows(words, weight), "passages")
    space = latent_space(rows, weight, rank)
    own = [np.unique([w for w in p.words if weight[w] > 0]) for p in parts]
    begin = np.cumsum([0, *map(len, own)])[:-1]
    wanted = latent(space, weight, np.concatenate(own).astype(np.int64), begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [(masks_of(p.words), masks_of(p.answer)) for p in parts]
        for batch in batches:
            for at, flat, size in parts_of(batch.column(2)):
                text, number, term, _ = passage_terms(flat, size, weight)
                ends, found = np.cumsum(size), []
                edge = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
                stops = np.append(edge, len(term))
                for block in range(0, len(edge), 1024):
                    some = stops[block : block + 1025]
                    z = latent(space, weight, term[some[0] : some[-1]], some[:-1] - some[0])
                    cosine = z @ wanted.T
                    last = -1
                    for i, k in np.argwhere(cosine >= COSINE).tolist():
                        if i != last:
                            row, passage = int(text[edge[block + i]]), int(number[edge[block + i]])
                            start = int(ends[row] - size[row]) + passage * HALF
                            words = flat[start : min(start + 2 * HALF, int(ends[row]))].tolist()
                            there, last = set(words).__contains__, i
                        part, (mask, answer) = parts[k], masks[k]
                        if sum(map(there, part.words)) < LCS_SHARE_WITH_ANSWER * len(part.words):
                            continue  # too few of the item's words are there, in whatever order
                        share = common_subsequence(mask, len(part.words), words) / len(part.words)
                        if share < LCS_SHARE_WITH_ANSWER:
                            continue
                        told = common_subsequence(answer, len(part.answer), words) / max(1, len(part.answer))
                        if share >= LCS_SHARE or told == 1.0:
                            found.append((at + row, part.item, passage, float(cosine[i, k]), share, told))
                row, *rest = zip(*found, strict=True) if found else ((),) * 6
                take = pa.array(row, pa.int64())
                kinds = [pa_type, pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(x, k) for x, k in zip(rest, kinds, strict=True)]],
                    names=schema.names,
                )

    from pyspark.sql.pandas.types import to_arrow_type

    pa_type = to_arrow_type(items.schema["item"].dataType)
    return words.mapInArrow(run, schema)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rank: int = RANK,
) -> DataFrame:
    """``(id, th, item, passages, cosine, lcs_share, answer_share)``: each item found in each document, best values.

    ``th`` is the text's hash, which tells rows of one id apart. Words are runs of word characters, lower-cased. Null
    and empty texts hold nothing, null or wordless items are found nowhere; rows that repeat id and text give one row;
    extra columns are ignored; empty tables give no rows. Items go in blocks, so what travels to tasks stays bounded.
    """
    docs = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text")
    )
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    found = None
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        parts, terms = item_parts([(r["item"], r["text"]) for r in some])
        if parts:
            new = _search(docs, items, parts, terms, rank)
            found = new if found is None else found.unionByName(new)
    if found is None:
        kinds = [f"cast(null as {t.simpleString()}) as {n}" for n, t in [(n, t or items.schema["item"].dataType) for n, t in MATCH_FIELDS]]
        found = docs.where("false").selectExpr("id", "th", *kinds)
    return found.groupBy("id", "th", "item").agg(
        F.countDistinct("passage").alias("passages"), *[F.max(n).alias(n) for n, _ in MATCH_FIELDS[2:]]
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns unchanged."""
    leaks = matches(docs, benchmark, id_col, text_col, **columns).select("id", "th").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    th = F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
    on = (th == F.col("l.th")) & F.col(f"row.`{id_col}`").eqNullSafe(F.col("l.id"))
    return row.join(leaks.alias("l"), on, "left_anti").select("row.*")

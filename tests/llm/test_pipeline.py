"""Every stage of the corpus pipeline against brute force on its own input, and the whole run."""

import itertools
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest

from test_copies import brute_fingerprint, edit_distance, groups
from tracewell.llm import decontam, lines, packing, quality, queries
from tracewell.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, columns = [docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert name == "packing" or docs.columns == columns
        seen.append(docs.collect())
    return seen


def test_stages_are_the_dealt_ones():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_quality(spark, steps):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    want = {r.id for r in quality.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in steps[1]} == want and 0 < len(want) < len(steps[0])
    texts = {r.doc_id: r.text for r in steps[0]}
    assert all(r.text == texts[r.doc_id] for r in steps[1])


def similar_lines(kinds):
    """All pairs of edit similarity 0.8; letters that differ in number settle most pairs."""
    kinds = sorted(kinds, key=len)
    size = np.array([len(k) for k in kinds])
    letters = {c: i for i, c in enumerate(sorted(set("".join(kinds))))}
    counts = np.zeros((len(kinds), len(letters)), np.int16)
    for i, k in enumerate(kinds):
        for c, n in Counter(k).items():
            counts[i, letters[c]] = n
    for i, k in enumerate(kinds):
        room = (0.2 * size[i + 1 :] + 1e-9).astype(int)
        change = counts[i + 1 :] - counts[i]
        least = np.maximum(np.maximum(change, 0).sum(axis=1), np.maximum(-change, 0).sum(axis=1))
        for j in np.flatnonzero(least <= room):
            if lines._distance(k, kinds[i + 1 + j]) <= room[j]:
                yield k, kinds[i + 1 + j]


def test_distance_is_the_edit_distance():
    draw = random.Random(2)
    for _ in range(400):
        a, b = ("".join(draw.choices("abcé ", k=draw.randint(1, 30))) for _ in range(2))
        assert lines._distance(a, b) == edit_distance(a, b)


def test_lines(steps):
    occurrences = [(r.doc_id, k, lines.normalised(x)) for r in steps[1] for k, x in enumerate(r.text.split("\n"))]
    occurrences = sorted(o for o in occurrences if o[2])
    kinds = sorted({o[2] for o in occurrences})
    close = list(similar_lines(kinds))
    of, first = groups(kinds, close), {}
    for o in occurrences:
        first.setdefault(of[o[2]], o[:2])
    gone = {o[:2] for o in occurrences if first[of[o[2]]] != o[:2]}
    after = {r.doc_id: r for r in steps[2]}
    assert gone and len(after) == len(steps[1])
    for r in steps[1]:
        kept = "\n".join(x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in gone)
        assert (after[r.doc_id].text, after[r.doc_id].n_chars) == (kept, len(kept))


def test_near_duplicates(steps):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in steps[2]}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    kept = {i for i, root in groups(sorted(prints), near).items() if i == root}
    assert {r.doc_id for r in steps[3]} == kept < set(prints)


def test_decontamination(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    parts, terms = decontam.item_parts(items)
    masks = [decontam.masks_of(p.words) for p in parts]

    def leaks(text):
        words = decontam.term_numbers([text], terms)[0]
        for at in range(0, max(1, len(words) - decontam.HALF), decontam.HALF):
            window = words[at : at + 2 * decontam.HALF]
            if any(decontam.common_subsequence(m, len(p.words), window) >= 0.6 * len(p.words) for m, p in zip(masks, parts, strict=True)):
                return True
        return False

    assert {r.doc_id for r in steps[4]} == {r.doc_id for r in steps[3] if not leaks(r.text)} < {r.doc_id for r in steps[3]}


def test_packing_and_whole_run(spark, steps):
    encode = packing.text_encoder(queries.tokenizer_path())
    want = Counter({r.doc_id: len(encode(r.text)) // 4 + 1 for r in steps[4]})
    got = Counter()
    for r in steps[5]:
        got[r.doc_id] += r.length
    assert got == want
    again = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, again.collect())) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in steps[5])

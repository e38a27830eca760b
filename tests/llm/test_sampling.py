"""Importance resampling, fill-in-middle and mixing against brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict
from glob import glob

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import importance, infill, mixing, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string"


def duck():
    con = duckdb.connect()
    for file in glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file).removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_fill_in_middle"])
def test_queries_match_sql(spark, name):
    result = duck().execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, SF).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, result.fetchall())) and got


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_runs(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, longest, buckets, seed, least, share):
    def counts(texts):
        return Counter(zlib.crc32(r.encode()) % buckets for t in texts for r in brute_runs(t, longest)[1])

    s, t = counts([d[1] for d in docs]), counts(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows, eligible = [], []
    for i, text in docs:
        n, runs = brute_runs(text, longest)
        weight = sum(gain[zlib.crc32(r.encode()) % buckets] for r in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
        if n >= least:
            eligible.append(len(rows) - 1)
    drawn = share[0] * len(eligible) // share[1]
    order = sorted(eligible, key=lambda k: (-rows[k][4], rows[k][0] is None, rows[k][0] or 0))[:drawn]
    rank = {k: place for place, k in enumerate(order, 1)}
    return sorted(repr((*r, rank.get(k))) for k, r in enumerate(rows))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_is_brute_force(spark, rng, words, longest):
    lines = [" ".join(rng.choices(words, k=rng.randint(0, 6))) + rng.choice(["", ".", " X9"]) for _ in range(30)]
    docs = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "\n\n \n"), (203, "Ünï A\x00b " * 30_000), (None, "a b c d e f"), (None, None), docs[5], docs[5]]
    target = [" ".join(rng.choices(words, k=8)) for _ in range(20)] + [None, ""]
    table = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, score int, rank int, place string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(table, wanted, longest=longest, buckets=97, seed=5, least_words=3, share=(1, 3))
    want = brute_resample(docs, target, longest, 97, 5, 3, (1, 3))
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_resampling_of_little(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "s"), (2, None, "s")], DOCS)
    assert importance.resample(none, some).collect() == []
    got = importance.resample(some, none, least_words=0, share=(1, 1)).orderBy("id").collect()
    assert [r.n_features for r in got] == [2, 0] and sorted(r["rank"] for r in got) == [1, 2]
    assert {r["rank"] for r in importance.resample(some, none).collect()} == {None}


def test_hashed_words_are_forgotten_without_a_change(monkeypatch, words):
    text = " ".join(words * 3).encode()
    whole = importance.Features(2, 50)
    want = whole.hashed(whole.runs(whole.words(text)))
    monkeypatch.setattr(importance, "REMEMBERED", 10)
    small = importance.Features(2, 50)
    assert [small.hashed(small.runs(small.words(text))) for _ in range(3)] == [want] * 3


def brute_infill(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, len(units))))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_is_brute_force(spark, rng, monkeypatch):
    alphabet = ["a", "é", "漢", "🙂", " ", "\n", "\t", "\x0b", "\x1c", " ", " ", "<", "S", ">", "\x00"]
    docs = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 40)))) for i in range(600)]
    docs += [(i, t) for i, t in enumerate(["", None, " ", "   \n", "a", "<P>", "x <S> y", "a<M>", "<S", "p<", ">", "<P"] * 8, 1000)]
    docs += [(2000 + i, "word  wörd\n" * 40_000) for i in range(4)] + [(None, "a b c"), (None, None), docs[3], docs[3]]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n_units int, output string")
    found = infill.transform(table).withColumn("text", infill.restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in found.collect()]
    want = [(i, *brute_infill(i, t), t or "") for i, t in docs]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    assert infill.transform(table.limit(0)).collect() == []


def test_infill_in_small_parts(monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch({"a": [1, 2, 3, 4, 5], "text": [b"x" * 5, None, b"", b"y" * 100, b"z"]})
    monkeypatch.setattr(infill, "PART_BYTES", 10)
    assert [p["a"].to_pylist() for p in infill.parts(batch)] == [[1, 2, 3], [4], [5]]
    assert list(infill.parts(batch.slice(0, 0))) == []


def brute_targets(per, weights=(1, 2, 3), most=3):
    order = sorted((s for s in per if s is not None)) + [None] * (None in per)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped, total = {}, sum(per.values())
    while True:
        rest = [s for s in order if s not in stopped]
        share = (total - sum(stopped.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * share > most * per[s]]
        if not over:
            return stopped | {s: weight[s] * share for s in rest}
        stopped |= {s: most * per[s] for s in over}


def given(multiplier, sizes, mean):
    return sum(c * min(3, math.exp(min(50, multiplier * c / mean))) for c in sizes)


def check_mix(rows, docs, near):
    per, sizes = defaultdict(int), defaultdict(list)
    for i, text, source in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        per[source] += n
        sizes[source].append(n)
    want, taken = brute_targets(per), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == per[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        small = min((n for n in sizes[source] if n), default=0)
        assert abs(taken[source] - target) <= max(near * target, small), source
    return want, sizes


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = mixing.mix(docs).collect()
    check_mix(found, [(r.doc_id, r.text, r.source) for r in docs.collect()], 0.01)
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect())) == sorted(map(tuple, found))


def test_mix_of_odd_sources(spark, rng, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 50)
    docs = [(i, "w " * min(20_000, int(rng.paretovariate(0.9) * 5)), rng.choice(["b", "b", "a", "Z", "é", None])) for i in range(1500)]
    docs += [(5000 + i, "same five words in all", "b") for i in range(700)]  # a hot cell
    docs += [(7000 + i, t, "empty") for i, t in enumerate(["", None, " \n"] * 40)]
    docs += [(None, "one two", "Z")] * 30 + [(8000, "x y z", "tiny"), (8000, "x y z", "tiny")]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", size int, copies string").repartition(6)
    check_mix(mixing.mix(table).collect(), docs, 0.002)
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], DOCS)
    assert {(r.target, r.taken) for r in mixing.mix(none).collect()} == {(0.0, 0)}
    assert mixing.mix(none.limit(0)).collect() == []


def test_multipliers_solve_the_dual(spark, rng):
    docs = [(s, max(1, int(rng.paretovariate(1.1) * 20))) for s in "abcdef" for _ in range(400)]
    counts = spark.createDataFrame(docs, "source string, size long").groupBy("source", "size").agg(F.count("*").alias("n"))
    per = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("m"))
    ratio = F.element_at(F.lit([0.001, 0.3, 0.999, 1.2, 2.5, 2.9999]), (F.ascii("source") - 96).cast("int"))
    wanted = per.select("source", "source_size", (F.col("source_size") / F.col("m")).alias("mean"), (ratio * F.col("source_size")).alias("target"))
    for r in mixing.balanced(counts, wanted).collect():
        sizes = [n for s, n in docs if s == r.source]
        low, high = -1e6, 1e6
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (low, middle) if given(middle, sizes, r.mean) > r.target else (middle, high)
        assert given(r.multiplier, sizes, r.mean) == pytest.approx(r.target, rel=1e-8)
        assert r.multiplier == pytest.approx(low, rel=1e-4, abs=1e-6)


def test_copies_follow_rates(rng):
    import pandas as pd

    sizes = sorted({rng.randint(1, 3000) for _ in range(400)}, reverse=True)
    rates = np.minimum(3, np.exp(0.0004 * np.array(sizes)))
    cells = pd.DataFrame({"source": "s", "size": sizes, "block": 0, "source_size": 0, "target": 0.0, "n": 2, "rate": rates})
    done = mixing.settle(cells, 3)
    copies = 2 * done["copies"] + done["more"]
    assert abs((copies * done["size"]).sum() - 2 * (rates * sizes).sum()) <= max(1, min(sizes))
    assert (np.abs(copies - 2 * rates) <= 2.001).all() and (done["more"] < 2).all()

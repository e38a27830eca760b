"""SimHash links, repeated substrings and fuzzy lines against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from tracewell.llm import lines, simhash, substrings


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_fingerprint(text, width=4):
    kept = (text or "").encode().lower().split()
    shingles = [b" ".join(kept[i : i + width]) for i in range(max(1, len(kept) - width + 1))] if kept else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "a b c", "A B c D", "É é x Y z w v", "to be or not " * 300])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == signed(brute_fingerprint(text))


@pytest.mark.parametrize(("linked", "parts"), [(20_000, 2), (3, 2), (20_000, 1), (20_000, 4)])
def test_links_connect_as_all_pairs(spark, rng, monkeypatch, linked, parts):
    monkeypatch.setattr(simhash, "LINKED", linked)
    words = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        words.add(centre)
        for _ in range(rng.choice([0, 1, 3, 50])):
            x = centre if rng.random() < 0.6 else rng.choice(sorted(words))
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            words.add(x)
    near = [(signed(a), signed(b)) for a, b in itertools.combinations(words, 2) if (a ^ b).bit_count() <= 4]
    table = spark.createDataFrame([(signed(w),) for w in words], "fp long")
    found = [(r.a, r.b) for r in simhash.links(table, 4, parts).collect()]
    assert set(map(tuple, map(sorted, found))) <= set(map(tuple, map(sorted, near)))
    nodes = [signed(w) for w in words]
    assert groups(nodes, found) == groups(nodes, near)


def test_near_duplicates_with_odd_rows(spark, rng, words):
    base = [" ".join(rng.choices(words, k=150)) for _ in range(20)]
    texts = [*base, *[b.replace(b.split()[70], "zz", 1) for b in base[:8]], base[0], base[0], None, "", "  ", "one", "One"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], "x"), (None, base[1], None)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    prints = [brute_fingerprint(t) for t in texts]
    want = groups(range(len(texts)), [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert Counter((r.id, r.component_id) for r in found if r.id is not None) == Counter([*want.items(), (5, want[5])])
    assert [r.component_id for r in found if r.id is None] == [want[1]]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == ["doc_id", "text", "fp"]


def test_components_of_a_chain_and_a_star(spark):
    from tracewell.llm.common import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 151), 100)}


def covered(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        yield mask


@pytest.mark.parametrize(("crowd", "tile"), [(2048, 1 << 20), (3, 1 << 20), (2048, 64)])
def test_repeated_substrings(spark, rng, monkeypatch, crowd, tile):
    monkeypatch.setattr(substrings, "SORTED_RUNS", crowd)
    monkeypatch.setattr(substrings, "TILE", tile)
    few = ["ab", "c", "déa", "bb", "cad"]

    def text(n):
        return " ".join(rng.choices(few, k=n))

    shared = [text(9) for _ in range(3)]
    docs = [text(rng.randint(0, 60)) for _ in range(50)] + [text(5) + rng.choice(shared) + text(5) for _ in range(25)]
    docs += ["ab " * 40, "ab " * 33, docs[3], docs[3], "", None, docs[4][:50] + "X" + docs[4][50:], "x" * 19, "x" * 20, "x" * 21]
    table = spark.createDataFrame([(i, t, "n") for i, t in enumerate(docs)], "doc_id long, text string, spans string")
    got = {r.id: r for r in substrings.remove_repeats(table.repartition(3), min_len=20, grain=8).collect()}
    data = [(t or "").encode() for t in docs]
    for i, mask in enumerate(covered(data, 20)):
        kept = bytes(b for b, m in zip(data[i], mask, strict=True) if not m)
        spans = sum(1 for k in range(len(mask)) if mask[k] and (k == 0 or not mask[k - 1]))
        assert (bytes(got[i].kept), len(got[i].starts), got[i].n_bytes) == (kept, spans, len(data[i])), i


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_lines(spark, rng, words):
    base = [" ".join(rng.choices(words, k=30)) for _ in range(40)]
    near = [b.replace(b.split()[9], b.split()[9] + "q", 1) for b in base[:15]]
    docs = [(i, "\n".join([*base[4 * i : 4 * i + 4], "", "!!", "Same, line 4 here"])) for i in range(10)]
    docs += [(20 + i, x.upper() + "\nsame line 7  here") for i, x in enumerate(near)] + [(50, None), (51, ""), (52, "Same, line 4 here"), (None, base[20])]
    schema = "doc_id long, text string, gone string"
    table = spark.createDataFrame([(i, t, "g") for i, t in docs], schema)
    got = {r.doc_id: r for r in lines.dedupe_lines(table).collect()}

    occurrences = [(i, k, lines.normalised(x)) for i, t in docs for k, x in enumerate((t or "").split("\n"))]
    occurrences = [(i is not None, i or 0, k, x) for i, k, x in occurrences if x]
    kinds = sorted({x for *_, x in occurrences})
    prints = dict(zip(kinds, (int(f) & (1 << 64) - 1 for f in lines.word_fingerprints(kinds)), strict=True))
    close = [
        (a, b)
        for a, b in itertools.combinations(kinds, 2)
        if (prints[a] ^ prints[b]).bit_count() <= lines.RADIUS and 1 - edit_distance(a, b) / max(len(a), len(b)) >= 0.8
    ]
    assert close
    of = groups(kinds, close)
    first = {}
    for o in sorted(occurrences):
        first.setdefault(of[o[3]], o[:3])
    gone = {o[:3] for o in occurrences if first[of[o[3]]] != o[:3]}
    for i, t in docs:
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i is not None, i or 0, k) not in gone)
        assert got[i].text == want, i
    assert got[0].gone == "g"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert lines.dedupe_lines(none).count() == 0


def test_a_very_long_text(spark, words, rng):
    long = " ".join(rng.choices(words, k=400_000))
    table = spark.createDataFrame([(0, long), (1, long[1000:1500]), (2, "x" * 300)], "doc_id long, text string")
    got = {r.id: r for r in substrings.remove_repeats(table).collect()}
    assert (got[1].kept, len(got[0].starts)) == (b"", 1)
    assert hashlib.sha256(got[0].kept).digest() == hashlib.sha256((long[:1000] + long[1500:]).encode()).digest()
    assert got[2].kept == b""


def test_letter_counts_never_rule_out_similar_lines(rng):
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("abcdeé 🙂", k=rng.randint(1, 60)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "a", " "])
        pairs.append((a, "".join(b)))
    counts = [lines.letter_counts([p[k] for p in pairs]) for k in (0, 1)]
    distance = [edit_distance(a, b) for a, b in pairs]
    assert lines.may_be_similar(*counts, np.array(distance)).all()
    assert not lines.may_be_similar(*counts, np.array(distance) // 3).all()


def one_word_changes(n, seed=5):
    """Pairs of a distinct sf0.01 line and the line with one word replaced, of edit similarity 0.8 at least."""
    draw = random.Random(seed)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    kinds = sorted({plain for t in texts for raw in (t or "").split("\n") if (plain := lines.normalised(raw))})
    vocabulary = [w for k in kinds[::20] for w in k.split()]
    pairs = []
    for line in draw.sample(kinds, n):
        changed = line.split()
        changed[draw.randrange(len(changed))] = draw.choice(vocabulary)
        changed = " ".join(changed)
        if changed != line and lines.edit_similar(line, changed):
            pairs.append((line, changed))
    return pairs


def test_changed_words_are_compared():
    pairs = one_word_changes(3000)
    keys = [list(map(set, lines.line_keys([p[side] for p in pairs]))) for side in (0, 1)]
    prints = [lines.word_fingerprints([p[side] for p in pairs]) for side in (0, 1)]
    met = [bool(a & b) and (int(p) ^ int(q)) & (1 << 64) - 1 for a, b, p, q in zip(*keys, *prints, strict=True)]
    met = [m is not False and m.bit_count() <= lines.RADIUS for m in met]
    for least, most in [(1, 5), (6, 10), (11, 20), (21, 40), (41, 80), (81, 10**6)]:
        own = [m for m, (a, _) in zip(met, pairs, strict=True) if least <= len(a.split()) <= most]
        print(f"{least}-{most} words: {sum(own)} of {len(own)}")
        assert sum(own) >= 0.95 * len(own), (least, most)


def test_lines_against_all_pairs_by_edit_similarity(spark):
    pairs = one_word_changes(150, 6)
    docs = [(i, a) for i, (a, _) in enumerate(pairs)] + [(1000 + i, b) for i, (_, b) in enumerate(pairs)]
    # many lines of one set of words, the smallest unlike the two that are alike
    shuffled = [" ".join(random.Random(i).sample(pairs[0][0].split(), len(pairs[0][0].split()))) for i in range(60)]
    docs += [(2000 + i, x) for i, x in enumerate(shuffled)] + [(3000 + i, x[:-1] + "q") for i, x in enumerate(shuffled)]
    docs += [(4000 + i, f"same first half of the words {i * 'x '}and {i * 'qy'}") for i in range(60)]
    kinds = sorted({lines.normalised(t) for _, t in docs})
    of = groups(kinds, [(a, b) for a, b in itertools.combinations(kinds, 2) if lines.edit_similar(a, b)])
    first = {}
    for i, t in docs:
        first[of[lines.normalised(t)]] = min(i, first.get(of[lines.normalised(t)], i))
    got = {r.doc_id for r in lines.dedupe_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.text}
    assert got >= set(first.values())
    assert len(got - set(first.values())) <= 0.01 * len(docs)


def test_letters_rule_out_chance_meetings_but_no_similar_lines(rng):
    pairs = [(a, b) for a, b in one_word_changes(600, 8) if len(a) < 200]
    unlike = ["".join(rng.choices("etaoinshrdlu ", k=80)) for _ in range(200)]
    for first, second, alike in (*[(a, b, True) for a, b in pairs], *[(a, b, False) for a, b in itertools.pairwise(unlike)]):
        most = np.array([int(0.2 * max(len(first), len(second)) + 1e-9)])
        packed = [lines.packed_letters([x]) for x in (first, second)]
        sizes = [np.array([len(x)], np.int32) for x in (first, second)]
        allowed = bool(lines.letters_allow(*packed, *sizes, most)[0])
        assert allowed or not alike
        change = np.abs(np.subtract(*(lines.letter_counts([x])[0, : lines.LETTERS] for x in (first, second))))
        if change.max() < 8:  # four bits show it whole
            assert allowed == (change.sum() + abs(len(first) - len(second)) <= 2 * most[0])
    assert lines.packed_letters(["", "x" * (lines.LETTERED + 1)]).tolist() == [[0, 0], [0, 0]]


def test_unlike_lines_of_a_key_are_not_listed(spark, rng):
    texts = ["".join(rng.choices("etaoin ", k=60)) for _ in range(15)] + ["".join(rng.choices("shrdlu ", k=60)) for _ in range(15)]
    texts += [texts[0][:-1] + "q", texts[15][:-3] + "etc"]
    known = [(1, i, 5, len(t), *lines.packed_letters([t])[0].tolist()) for i, t in enumerate(texts)]
    keyed = spark.createDataFrame(known, "key long, lh long, fp long, size int, low long, high long")
    got = {(r.a, r.b) for r in lines.line_pairs(keyed).collect()}
    like = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if lines.edit_similar(texts[i], texts[j])}
    assert like and like <= got and not any((i % 30 < 15) != (j % 30 < 15) for i, j in got if j < 30)


def test_bounds_and_early_ends_agree_with_the_distance(rng):
    for _ in range(600):
        words = ["".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 60))]
        changed = list(words)
        for _ in range(rng.randint(0, 12)):
            i = rng.randrange(len(changed) + 1)
            changed[i : i + rng.randint(0, 3)] = rng.choice([[], ["ab"], ["x", "cab"], [rng.choice(words)]])
        a, b = " ".join(words), " ".join(changed)
        distance, most = edit_distance(a, b) if len(a) < 90 else lines._distance(a, b), int(0.2 * max(len(a), len(b)) + 1e-9)
        assert lines.edit_similar(a, b) == (distance <= most)
        assert (lines._distance(a, b, most) <= most) == (distance <= most)
        assert not lines._side_by_side(a.split(" "), b.split(" "), most) or distance <= most


def test_lines_normalised_together(rng):
    letters = [*"aBéÉİΣς_9٣²Ⅷ \t\r\x0b.", " ", " ", "🙂", "𝐀", "𠀀", "\U00010400", "\U000e0001", "\x85", "é"]
    some = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(3000)]
    some += [f"a{chr(c)}b {chr(c)}" for c in range(0x30000) if c != 10 and not 0xD800 <= c < 0xE000]
    assert lines.all_normalised(some) == [lines.normalised(x) for x in some]
    assert lines.all_normalised([]) == [] and lines.all_normalised([""]) == [""]


def test_pairs_compared_side_by_side_agree_with_single_ones(rng):
    pairs = []
    for many in (3, 12, 60, 180, 1500):
        for _ in range(150 if many < 1000 else 3):
            words = ["".join(rng.choices("abcé🙂", k=rng.randint(1, 6))) for _ in range(rng.randint(1, many))]
            changed = list(words)
            for _ in range(rng.randint(0, 2 + many // 5)):
                i = rng.randrange(len(changed) + 1)
                changed[i : i + rng.randint(0, 3)] = rng.choice([[], ["ab"], ["x", "cab"], [rng.choice(words)]])
            pairs.append((" ".join(words), " ".join(changed)))
    pairs += [("", ""), ("", "a"), ("a" * 64, "a" * 52 + "b" * 12), ("a" * 64, "a" * 51 + "b" * 13), ("x" * 300, "x" * 240)]
    pairs += [("".join(rng.choices("etaoin ", k=n)), "".join(rng.choices("etaoin ", k=n))) for n in (40, 64, 65, 128, 250) * 20]
    want = [lines._distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert 200 < sum(want) < len(want) - 200
    for size in (1, 40, len(pairs)):
        got = [lines.edit_similar_all(*map(list, zip(*pairs[at : at + size], strict=True))) for at in range(0, len(pairs), size)]
        assert np.concatenate(got).tolist() == want
    assert lines.edit_similar_all([], []).tolist() == []


def test_a_key_of_many_unlike_lines_is_not_crowded(spark, rng):
    unlike = ["".join(rng.choices("etaoinshrdlu ", k=rng.randint(60, 200))) for _ in range(150)]
    unlike += [unlike[0][:-1] + "q", unlike[5][:-3] + "etc"]
    alike = [f"{'one line that many documents hold ' * 3}{i:03}" for i in range(120)]
    known = [(key, 1000 * key + i, 5, len(t), *lines.packed_letters([t])[0].tolist()) for key, own in ((1, unlike), (2, alike)) for i, t in enumerate(own)]
    keyed = spark.createDataFrame(known + known[:9], "key long, lh long, fp long, size int, low long, high long")
    got = lines.line_pairs(keyed).collect()
    assert {r.crowded for r in got} == {None, 2}
    assert {r.a for r in got if r.crowded} == {2000 + i for i in range(120)}
    pairs = {(r.a - 1000, r.b - 1000) for r in got if not r.crowded}
    like = {(i, j) for i, j in itertools.combinations(range(len(unlike)), 2) if lines.edit_similar(unlike[i], unlike[j])}
    assert like and like <= pairs and len(pairs) < 16 * len(unlike)


def test_forest_connects_as_all_pairs(rng):
    texts = ["".join(rng.choices("abcdefgh ", k=50)) for _ in range(25)]
    for _ in range(150):
        line = list(rng.choice(texts))
        for _ in range(rng.randint(1, 8)):
            line[rng.randrange(len(line))] = rng.choice("abcdefgh")
        texts.append("".join(line))
    search, asked = lines.forest(np.arange(len(texts)), texts), 0
    try:
        pairs = next(search)
        while True:
            asked += len(pairs[0])
            pairs = search.send(lines.edit_similar_all(*pairs))
    except StopIteration as done:
        found = done.value
    prints = lines.word_fingerprints(texts).tolist()
    near = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= lines.RADIUS]
    near = [(a, b) for a, b in near if lines.edit_similar(texts[a], texts[b])]
    assert groups(range(len(texts)), found) == groups(range(len(texts)), near)
    assert len(found) < len(near) and asked < len(texts) ** 2 / 2


def test_keys_and_fingerprints_made_together(rng):
    texts = ["".join(rng.choices("abcé 🙂", k=k)).strip() for k in (1, 3, 4, 9, 10, 31, 99, 200, 253, 254, 255, 510, 3000, 70_000) for _ in range(3)]
    texts = [t or "a" for t in texts]
    for text, got in zip(texts, lines.word_fingerprints(["", *texts])[1:].tolist(), strict=True):
        bits = np.unpackbits(lines._grams([text], lines.GRAM)[0].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        assert got == np.packbits(2 * bits.sum(axis=0) > len(bits), bitorder="little").view("<i8")[0]
    alone = [set(lines.line_keys([t])[0]) for t in texts]
    assert [set(k) for k in lines.line_keys(texts)] == alone
    turns = lines.passes()
    assert sorted(band for turn in turns for band in turn) == list(range(lines.BANDS)) and len(turns) == lines.PASSES
    found = [set() for _ in texts]
    for row, key in lines.numbered_keys(texts, turns):
        assert (np.diff(row) >= 0).all()
        for i, k in zip(row.tolist(), key.tolist(), strict=True):
            found[i].add(k)
    assert found == alone

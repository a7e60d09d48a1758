from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import ngram_join as n
from tidemark.llm.components import components
from tidemark.llm.words import chunks, shingle_sets, split_words


def plain_set(text, width=3):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    up, number = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                up[max(root(a), root(b))] = min(root(a), root(b))
                number[a] += 1
                number[b] += 1
    members = {}
    for k in range(len(rows)):
        members.setdefault(root(k), []).append(rows[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return sorted(((str(i), len(sets[k]), str(least[root(k)]) if sets[k] else str(i), number[k]) for k, (i, _) in enumerate(rows)))


def near(words, rng, text, edits):
    out = list(text)
    for _ in range(edits):
        place, act = rng.randrange(len(out)), rng.random()
        if act < 0.4:
            out[place] = words(1)[0]
        elif act < 0.7 and len(out) > 1:
            del out[place]
        else:
            out.insert(place, words(1)[0])
    return out


def test_words_split_at_ascii_space_only():
    texts = ["  A\x0bb c\x85d \x1c e\r\n", "", "x", None, "É ÀB"]
    offsets, index, words = split_words(pa.array(texts, pa.string()))
    found = [[words[i] for i in index[a:b]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert found == [(t or "").encode().lower().split() for t in texts]
    assert list(chunks(pa.array(["aaaa", None, "bb", "c" * 50, "d"]), 6)) == [(0, 3), (3, 4), (4, 5)]


def test_linked_sets_share_a_signature(words):
    rng, links = random.Random(3), 0
    for width, percent in ((3, 90), (5, 80)):
        for _ in range(150):
            base = words(rng.choice([3, 5, 12, 15, 30, 60, 120, 300, 700]))
            texts = [" ".join(near(words, rng, base, rng.randint(0, max(1, len(base) // (40 if width == 3 else 30))))) for _ in range(5)]
            sets = shingle_sets(pa.array(texts), width)
            plain = [plain_set(t, width) for t in texts]
            assert [len(s) for s in sets] == [len(s) for s in plain]
            places, blobs = n._packed(np.concatenate(sets).view(np.int64), np.repeat(np.arange(5), [len(s) for s in sets]))
            seen = [[] for _ in range(5)]
            for place, blob in zip(places, blobs, strict=True):
                for node, x in zip(*n._shared(place, [blob]), strict=True):
                    seen[node].append(x)
            codes = [set(n.prefix(len(s), np.array(x, n._SEEN), percent).tolist()) for s, x in zip(sets, seen, strict=True)]
            for a in range(5):
                for b in range(a):
                    if texts[a] != texts[b] and 100 * len(plain[a] & plain[b]) >= percent * len(plain[a] | plain[b]):
                        links += 1
                        assert codes[a] & codes[b]
    assert links > 300


def test_product_is_the_plain_overlap(words, monkeypatch):
    monkeypatch.setattr(n, "COLUMNS", 7)
    rng = random.Random(1)
    base = words(40)
    texts = [" ".join(near(words, rng, base, rng.randint(0, 6))) for _ in range(20)]
    plain = [plain_set(t) for t in texts]
    sets = shingle_sets(pa.array(texts), 3)
    expected = np.array([[len(a & b) for b in plain] for a in plain])
    assert (n.overlaps(sets, sets) == expected).all()
    assert (n.overlaps(sets[:7], sets[7:]) == expected[:7, 7:]).all()


def test_pairs_are_discarded_by_bounds_that_lose_no_link(words, monkeypatch):
    monkeypatch.setattr(n, "COLUMNS", 11)
    rng = random.Random(5)
    for percent in (50, 80, 90, 100):
        base = words(60)
        texts = [" ".join(near(words, rng, base[: rng.randint(5, 60)], rng.randint(0, 8))) for _ in range(30)] + [" ".join(base)] * 2
        plain, sets = [plain_set(t) for t in texts], shingle_sets(pa.array(texts), 3)
        expected = np.array([[100 * len(a & b) >= percent * len(a | b) for b in plain] for a in plain])
        assert (n.links_between(sets, sets, percent) == expected).all()
        assert (n.links_between(sets[:9], sets[9:], percent) == expected[:9, 9:]).all()


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "one two three four"), ("a", "one two three four"), ("x1", "other words here"), (None, "alone")], "doc_id string, text string")
    found = sorted((str(r["doc_id"]), str(r["component_id"]), r["n_links"]) for r in n.ngram_join(docs).collect())
    assert found == [("None", "None", 0), ("a", "a", 1), ("b", "a", 1), ("x1", "x1", 0)]
    assert sorted(str(r["doc_id"]) for r in n.one_of_each(docs).collect()) == ["None", "a", "x1"]


def test_join_against_all_pairs(spark, words):
    rng, texts = random.Random(7), []
    for size in (8, 12, 20, 40, 90, 200):
        for _ in range(4):
            base = words(size)
            texts += [" ".join(near(words, rng, base, rng.randint(0, max(1, size // 30)))) for _ in range(6)]
    hub = words(120)
    texts += [" ".join(near(words, rng, hub, rng.randint(0, 2))) for _ in range(60)] + [" ".join(hub)] * 30
    texts += ["a b", "A  b", "b a", "a", "A", "", " ", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block in (256, 5):
        found = sorted(((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["n_links"]) for r in n.ngram_join(docs, block=block).collect()))
        assert found == plain_components(rows)


def test_one_of_each_by_id_and_text(spark, words):
    """An id with several texts keeps those of them that no smaller id has; only rows that go or repeat are dealt out."""
    x, y, z = (" ".join(words(30)) for _ in range(3))
    rows = [(1, x), (5, x), (5, y), (5, y), (7, y), (8, z), (9, None), (9, None), (9, ""), (None, x), (None, z)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' as key")
    kept = sorted((tuple(r) for r in n.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, x, "own"), (5, y, "own"), (8, z, "own"), (9, None, "own"), (9, "", "own")], key=str)


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = sorted(((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["n_links"]) for r in n.ngram_join(odd).collect()))
    assert found == plain_components(rows)
    assert n.ngram_join(none).collect() == []
    kept = n.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({i for i, _, c, _ in found if i == c})
    assert n.one_of_each(none).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(200, 100 + k) for k in range(50)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
    up = {}
    for a, b in edges:
        for x in (a, b):
            up.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(up[a], up[b])
            if up[a] != low or up[b] != low:
                up[a] = up[b] = low
                changed = True
    loops = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert found == {k: v for k, v in up.items() if k not in loops}


def test_packed_signatures_are_the_same():
    rng = np.random.default_rng(4)
    codes, nodes = rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(-(2**63), 2**63 - 1, 5000)
    places, blobs = n._packed(codes, nodes)
    assert len(set(places)) == len(places) <= n.BUCKETS
    found = set()
    for place, blob in zip(places, blobs, strict=True):
        a, b = n._unpacked([blob])
        found |= {(place, x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    low, high = codes.view(np.uint64) & np.uint64((1 << 48) - 1), (codes.view(np.uint64) >> np.uint64(48)) % np.uint64(n.BUCKETS)
    assert found == set(zip(high.tolist(), low.tolist(), nodes.tolist(), strict=True))
    assert n._packed(codes[:0], nodes[:0]) == ([], [])


def test_the_stage_s_definition_against_all_pairs(spark, words):
    rng, texts = random.Random(9), []
    for size in (6, 12, 30, 60, 200):
        for _ in range(5):
            base = words(size)
            texts += [" ".join(near(words, rng, base, rng.randint(0, max(1, size // 25)))) for _ in range(5)]
    texts += ["a b c", "A  b c", None, ""]
    rows = list(enumerate(texts))
    sets = [plain_set(t, 5) for t in texts]
    up = list(range(len(rows)))
    for _ in range(6):
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
    found = {r["doc_id"]: r["component_id"] for r in n.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width=5, percent=80).collect()}
    assert found == dict(enumerate(up)) and len(set(up)) < len(rows) - 40


def test_texts_that_only_share_passages_are_left_out(spark, words):
    """Many documents with one long passage, their own else: none is signed, and no group is formed of them."""
    passage, rng = words(60), random.Random(3)
    own = lambda: " ".join(f"{w}{rng.randrange(10**9)}" for w in words(200))
    texts = [f"{own()} {' '.join(passage)} {own()}" for _ in range(60)]
    copy = texts[0].split()
    texts.append(" ".join([*copy[:100], "other", *copy[101:]]))
    sets = shingle_sets(pa.array(texts), 5)
    count = {}
    for x in sets:
        for g in x.tolist():
            count[g] = count.get(g, 0) + 1
    alone = [sum(g % n.SAMPLE == 0 and count[g] == 1 for g in x.tolist()) for x in sets]
    assert [k for k, x in enumerate(sets) if 100 * alone[k] <= 20 * len(x)] == [0, 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in n.ngram_join(docs, width=5, percent=80).collect()}
    assert found == {k: (0 if k == 60 else k, 1 if k in (0, 60) else 0) for k in range(61)}


def test_unshared_counts():
    codes = np.array([5, 5, 7, 7, 9, 11, 11, 12], np.int64)
    nodes = np.array([1, 2, 3, 3, 1, 0, 4, -8], np.int64)  # 3 alone with itself; 0 stands for several
    found = dict(zip(*(x.tolist() for x in n._unshared(codes, nodes)), strict=True))
    assert found == {3: 1, 1: 1, -8: 1}

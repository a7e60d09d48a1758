from __future__ import annotations

import hashlib
import random
import re

from tidemark.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, t in items:
        own = plain_words(t)
        m = min(13, len(own))
        windows = {tuple(own[k : k + m]) for k in range(len(own) - m + 1)} if m else set()
        for k in range(len(words) - m + 1):
            if m and tuple(words[k : k + m]) in windows:
                hit.update(range(k, k + m))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as n_words")


def cases(words):
    rng = random.Random(6)
    items = [(k, " ".join(words(rng.choice([1, 2, 5, 12, 13, 14, 40])))) for k in range(2, 30)]
    items += [(40, "The the THE, the"), (41, items[20][1]), (42, None), (43, "!!"), (None, "zeta eta theta iota")]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "the-the the.the THE the"), (4, "x zeta, ETA theta iota y")]
    for k in range(60):
        own = words(rng.randint(1, 60))
        if k % 2:
            piece = plain_words(rng.choice(items[:28])[1])
            at = rng.randrange(len(own) + 1)
            own[at:at] = piece[rng.randrange(len(piece)) :] if k % 3 == 0 else piece
        docs.append((10 + k, rng.choice([" ", ", ", "\n"]).join(own)))
    return docs, items


def test_against_plain_search(spark, words):
    docs, items = cases(words)
    rows, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items)
    expected = sorted((i, *plain(t, items)) for i, t in docs)
    assert sorted(map(tuple, d.decontamination(rows, benchmark).collect())) == expected
    assert sorted(map(tuple, d.decontamination(rows, benchmark, block_bytes=600).collect())) == expected
    assert sorted(map(tuple, d.decontamination(rows, benchmark, block_bytes=600, piece=3).collect())) == expected
    assert sorted(map(tuple, d.decontamination(rows, benchmark, piece=1).collect())) == expected


def test_odd_rows(odd, none, spark):
    items = [(1, "One TWO"), (2, "an unnamed text of some words that says very little of use")]
    found = d.decontamination(odd, bench(spark, items)).collect()
    assert sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in found) == sorted((str(r["doc_id"]), *plain(r["text"], items)) for r in odd.collect())
    assert d.decontamination(none, bench(spark, items)).collect() == []
    assert not any(r["contaminated"] for r in d.decontamination(odd, bench(spark, items).limit(0)).collect())
    marked = d.mark(odd, bench(spark, items)).where("not __tm_contaminated").select(*odd.columns)
    assert marked.count() == sum(not r["contaminated"] for r in found)


def test_search_against_plain_comparison():
    rng = random.Random(8)
    for _ in range(300):
        alphabet = [bytes([97 + k]) for k in range(rng.choice([1, 2, 3, 8]))]
        some = lambda n: [rng.choice(alphabet) for _ in range(n)]  # noqa: E731, B023
        window = rng.choice([1, 2, 3, 5, 13])
        items = [(f"i{k}", b" ".join(some(rng.randint(0, 30)))) for k in range(rng.randint(1, 6))]
        words = some(rng.randint(0, 60)) + [b"zz"] + some(rng.randint(0, 20))
        spans, found = d.Searcher(items, window).occurrences(words)
        hit, expected = set(), set()
        for item, text in items:
            own = text.split()
            m = min(window, len(own))
            for s in range(len(own) - m + 1) if m else ():
                for k in range(len(words) - m + 1):
                    if words[k : k + m] == own[s : s + m]:
                        hit.update(range(k, k + m))
                        expected.add(item)
        assert found == expected and {k for a, b in spans for k in range(a, b)} == hit


def test_blocks_are_drawn_one_by_one_and_bounded(spark, words):
    items = [(1, " ".join(words(900))), (1, "the same item"), (1, "the same item")] + [(k, " ".join(words(30))) for k in range(2, 60)]
    count, blocks = d._blocks(bench(spark, items * 3), "item_id", "text", 13, 4000, 50)
    sizes = [sum(len(f.stream) for f in b.finders) for b in blocks]
    assert len(sizes) == count > 4 and max(sizes) < 4000 / 3


def test_tables_are_small(words):
    import pickle

    text = " ".join(words(100_000)).encode()
    assert len(pickle.dumps(d.Searcher([("a", text)], 13).finders)) < 60 * 100_000

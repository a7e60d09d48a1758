from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import cotraining as c


def corpus(spark, words, n=1500):
    rng, rows, labels = random.Random(8), [], []
    for k in range(n):
        kind = rng.choice(["good", "good", "good", "junk", "toxic"])
        own = words(60)
        if kind == "junk":
            own = [w + rng.choice(["###", "$$$", "***"]) for w in own]
        if kind == "toxic":
            for place in rng.sample(range(60), 4):
                own[place] = rng.choice(["vileone", "viletwo", "vilethree"])
        source = "bad.example" if kind != "good" and rng.random() < 0.8 else "fine.example"
        rows.append((k, " ".join(own), "en", source, 0, kind))
        if k < n // 2:
            labels.append((k, 0 if kind == "junk" else 1, 1 if kind == "toxic" else 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kind string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, words):
    docs, labels = corpus(spark, words)
    kind = {r["doc_id"]: r["kind"] for r in docs.collect()}
    found = [r for r in c.cotraining(docs, labels, pseudo=50).collect() if r["doc_id"] >= 750]
    right = [r["kept"] == (kind[r["doc_id"]] == "good") for r in found]
    assert sum(right) / len(right) > 0.97
    assert all(r["kept"] for r in found if kind[r["doc_id"]] == "good" and r["meta_score"] > 0.5)
    assert abs(sum(r["score"] for r in found) / len(found) - sum(kind[r["doc_id"]] == "good" for r in found) / len(found)) < 0.05


def test_a_run_repeats_exactly(spark, words):
    docs, labels = corpus(spark, words, 300)
    one, two = (sorted(map(tuple, c.cotraining(docs, labels, pseudo=20).collect())) for _ in range(2))
    assert one == two


def test_odd_rows(odd, none, labels_of):
    found = c.cotraining(odd, labels_of([])).collect()
    assert len(found) == 10 and all(r["kept"] and r["score"] == 0.5 for r in found)
    assert c.cotraining(none, labels_of([(1, 1, 0)])).collect() == []
    found = c.cotraining(odd, labels_of([(4, 1, 0), (4, 0, 1), (7, 1, None), (None, 1, 0), (6, None, 0)])).collect()
    assert len(found) == 10


def test_both_views_teach_and_no_labelled_content_is_handed_on(spark, words):
    docs, labels = corpus(spark, words)
    copies = docs.where("doc_id < 100").withColumn("doc_id", F.col("doc_id") + 10_000)  # unlabelled copies of labelled texts
    featured = c.features(docs.unionByName(copies))
    model = c.CoTraining(featured, labels, 600, c.SAMPLE_BYTES, 2, 30)
    marked = {r["doc_id"] for r in labels.collect()}
    shut = {bytes(r["key"]) for r in featured.collect() if r["doc_id"] in marked}
    for number in (0, 1):
        for view in (0, 1):
            for good in (True, False):
                own = [x for x in model.offers if x[:3] == (number, view, good)]
                assert 10 <= len(own) <= 60, (number, view, good, len(own))
    assert not any(x[3] in shut or x[4] in marked or x[4] >= 10_000 for x in model.offers)
    for view in (0, 1):
        keys = [x[3] for x in model.offers if x[1] == view]
        assert len(keys) == len(set(keys))
    train, calibrate, combine = map(set, model.sides)
    assert train and calibrate and combine and not (train & calibrate or train & combine or calibrate & combine)


def test_copies_with_other_metadata_are_one_content(spark, words):
    """No content lies on two sides or is handed on beside a label, whatever the metadata of its copies."""
    docs, labels = corpus(spark, words)
    moved = docs.where("doc_id < 400").withColumns({"doc_id": F.col("doc_id") + 10_000, "source": F.lit("mirror.example"), "lang": F.lit("fr")})
    more = labels.where("doc_id < 200").withColumn("doc_id", F.col("doc_id") + 10_000)  # half of the copies are labelled too
    both = docs.unionByName(moved)
    featured = c.features(both)
    model = c.CoTraining(featured, labels.unionByName(more), 2000, c.SAMPLE_BYTES, 2, 30)
    text = {r["doc_id"]: r["text"] for r in both.collect()}
    sides = [{text[i] for i in side} for side in model.sides]
    assert sum(map(len, model.sides)) == 950 and not (sides[0] & sides[1] or sides[0] & sides[2] or sides[1] & sides[2])
    marked = {text[r["doc_id"]] for r in labels.collect()}
    assert model.offers and not any(text[x[4]] in marked for x in model.offers)


def test_accuracy_of_each_view(spark, words):
    """The combination is no worse than either view on held-out documents, and subtracts none."""
    docs, labels = corpus(spark, words)
    kind = {r["doc_id"]: r["kind"] == "good" for r in docs.collect()}
    model = c.CoTraining(c.features(docs), labels, c.LABELLED, c.SAMPLE_BYTES, c.ROUNDS, 50)
    found = [r for r in model.scores().collect() if r["doc_id"] >= 750]
    right = {v: sum((r[v] >= 0.5) == kind[r["doc_id"]] for r in found) / len(found) for v in ("content_score", "meta_score", "score")}
    assert (model.combination[0] >= 0).all() and right["score"] >= max(right["content_score"], right["meta_score"]) - 0.01 > 0.9


def test_a_view_that_would_be_subtracted_is_left_out():
    rng = np.random.default_rng(3)
    good = rng.random(500) < 0.5
    x = np.stack([good * 2.0 - 1 + rng.normal(size=500), -(good * 1.0) + rng.normal(size=500)], axis=1)
    assert c.platt(x, good)[0][1] < 0
    weights, shift = c.stack(x, good)
    assert weights[1] == 0 and np.allclose((weights[0], shift), (c.platt(x[:, :1], good)[0][0], c.platt(x[:, :1], good)[1]))


def test_the_sample_is_bounded_in_bytes(spark, words):
    docs, labels = corpus(spark, words, 400)
    size = lambda m: sum(map(len, m.sides))
    featured = c.features(docs)
    whole = c.CoTraining(featured, labels, 10_000, 1 << 30, 0, None)
    part = c.CoTraining(featured, labels, 10_000, 20_000, 0, None)
    assert size(whole) == 200 and 0 < size(part) < 120
    assert size(c.CoTraining(featured, labels, 50, 1 << 30, 0, None)) == 50


def test_against_plain_cotraining(spark, words):
    """The whole procedure again, on dense tables and with sorted lists."""
    docs, labels = corpus(spark, words, 400)
    pseudo, rows = 15, c.features(docs).collect()
    truth = {r["doc_id"]: r["quality"] == 1 and not r["toxic"] for r in labels.collect()}
    shares = c.features(docs).select("key", *(c.share_of_key(F.col("key"), n).alias(f"share{n}") for n in range(c.ROUNDS))).collect()
    place = {bytes(r["key"]): [r[f"share{n}"] for n in range(c.ROUNDS)] for r in shares}

    def dense(raw, bits):
        out = np.zeros(1 << bits)
        out[np.frombuffer(bytes(raw), np.uint32)] = 1
        return out

    bits, names = (c.CONTENT_BITS, c.META_BITS), ("content", "meta")
    ids = [np.unique(np.concatenate([np.frombuffer(bytes(r[n]), np.uint32) for r in rows])) for n in names]
    table = {bytes(r["key"]): [dense(r[n], b)[i] for n, b, i in zip(names, bits, ids, strict=True)] for r in rows}
    known = [(r["doc_id"], bytes(r["key"])) for r in sorted(rows, key=lambda r: r["doc_id"]) if r["doc_id"] in truth]
    side = lambda k: c.xxhash.xxh64_intdigest(k) % 5
    sets = [[(table[k][v], float(truth[i])) for i, k in known if side(k) > 1] for v in (0, 1)]

    def fit(view):
        x, y = np.array([a for a, _ in sets[view]]), np.array([b for _, b in sets[view]])
        ones, zeros = max(1, y.sum()), max(1, (1 - y).sum())
        n1, n0 = x.T @ y, x.T @ (1 - y)
        share = (n1 + n0) / (ones + zeros)
        z = np.abs(n1 / ones - n0 / zeros) / np.sqrt(np.maximum(share * (1 - share) * (1 / ones + 1 / zeros), 1e-12))
        used = (z >= c.MIN_Z) & (n1 + n0 >= c.MIN_DOCS)
        x, w, b = x[:, used], np.zeros(used.sum()), 0.0
        g2, h2 = np.full(used.sum(), 1e-8), 1e-8
        for _ in range(400):
            p = 1 / (1 + np.exp(-(x @ w + b)))
            error = np.where(True, (1 - y) * p / (2 * zeros) - y * (1 - p) / (2 * ones), 0)
            g = x.T @ error + 1e-4 * w
            g2, h2 = g2 + g * g, h2 + error.sum() ** 2
            w, b = w - 0.3 * g / np.sqrt(g2), b - 0.3 * error.sum() / np.sqrt(h2)
        raw = lambda k: table[k][view][used] @ w + b
        held = [(raw(k), truth[i]) for i, k in known if side(k) == 0]
        slope, shift = c.platt(np.array([[a] for a, _ in held]), np.array([y for _, y in held]))
        return lambda k: float(np.clip(slope[0] * raw(k) + shift, -12, 12))

    shut = {k for _, k in known}
    taught = [set(), set()]
    models = [fit(0), fit(1)]
    for number in range(c.ROUNDS):
        lessons = []
        for view in (0, 1):
            left = [(int(np.floor(c.STEPS * models[view](k))), k) for k in table if k not in shut and k not in taught[view]]
            for good in (True, False):
                steps = sorted({s for s, _ in left}, reverse=good)
                room = pseudo
                for step in steps:
                    own = [k for s, k in left if s == step]
                    if len(own) >= room:
                        lessons += [(view, k) for k in own if place[k][number] < room / len(own)]
                        break
                    lessons += [(view, k) for k in own]
                    room -= len(own)
        for view, k in sorted(set(lessons)):
            sets[1 - view].append((table[k][1 - view], 1 / (1 + np.exp(-models[view](k)))))
            taught[view].add(k)
        models = [fit(0), fit(1)]
    held = [([m(k) for m in models], truth[i]) for i, k in known if side(k) == 1]
    weights, shift = c.platt(np.array([a for a, _ in held]), np.array([y for _, y in held]))
    expected = {bytes(r["key"]): 1 / (1 + np.exp(-(weights @ [m(bytes(r["key"])) for m in models] + shift))) for r in rows}
    key = {r["doc_id"]: bytes(r["key"]) for r in rows}
    found = c.cotraining(docs, labels, pseudo=pseudo).collect()
    assert len(found) == 400 and all(abs(r["score"] - expected[key[r["doc_id"]]]) < 1e-6 for r in found)


def test_one_id_with_several_texts_repeats(spark, words):
    docs, labels = corpus(spark, words, 200)
    twice = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" more"))))
    one, two = (sorted(map(tuple, c.cotraining(twice.repartition(n), labels, pseudo=10).collect())) for n in (2, 5))
    assert len(one) == 400 and all(abs(a - b) < 1e-9 for x, y in zip(one, two, strict=True) for a, b in zip(x[:4], y[:4], strict=True))

from __future__ import annotations

import collections

from pyspark.sql import functions as F

from tidemark.llm import mixing as m


def test_odd_rows(odd, none):
    found = m.mixing(odd).collect()
    assert len(found) == 10 and all(0 <= r["probability"] <= 1 and r["weight"] >= 1 for r in found)
    assert {r["sampled"] for r in found if r["doc_id"] == 7}.__len__() == 1
    assert m.mixing(none).collect() == []
    kept = m.sample(odd)
    assert kept.columns == odd.columns


def test_margins_meet_the_targets(spark, words):
    rows = [(k, " ".join(words(20 + k % 40)) + (" | " if k % 4 == 0 else "\n" if k % 4 == 1 else ""), "en" if k % 5 else "de", f"s{k % 3 if k % 7 else 0}", 0) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cells = m.mixed(docs).groupBy(*m.MARGINS).agg(F.sum("tokens").cast("long").alias("tokens"), F.count("*").alias("docs"))
    targets = {"source": {"s0": 1, "s1": 1, "s2": 2}, "lang": {"en": 1, "de": 1}}
    fitted = m.rake(cells, targets, sweeps=20).collect()
    share = {k: collections.Counter() for k in m.MARGINS}
    for r in fitted:
        for k in m.MARGINS:
            share[k][r[k]] += r["share"]
    assert all(abs(share["source"][s] - t) < 1e-6 for s, t in (("s0", 0.25), ("s1", 0.25), ("s2", 0.5)))
    assert all(abs(share["lang"][s] - 0.5) < 1e-6 for s in ("en", "de")) and abs(sum(share["topic"].values()) - 1) < 1e-9


def test_samples_follow_the_probabilities(spark, words):
    rows = [(k, " ".join(words(30)), "en", "big" if k % 10 else "small", 0) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = m.mixing(docs, rate=0.3).collect()
    by = {s: [r for r in found if r["source"] == s] for s in ("big", "small")}
    assert by["small"][0]["probability"] > by["big"][0]["probability"]
    for group in by.values():
        expected = sum(r["probability"] for r in group)
        assert abs(sum(r["sampled"] for r in group) - expected) < 5 * (expected**0.5)
    assert sorted(r["doc_id"] for r in m.sample(docs, rate=0.3).collect()) == sorted(r["doc_id"] for r in found if r["sampled"])


def test_the_sample_meets_the_targets_where_cells_are_capped(spark, words):
    rows = [(k, " ".join(words(30)), "de" if k % 10 == 0 else "en", f"s{k % 3}", 0) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    given = {"targets": {"lang": {"en": 3, "de": 2}}, "rate": 0.9, "sweeps": 3}
    assert {r["lang"] for r in m.mixing(docs, **given).where("weight > 1").collect()} == {"de"}  # about 3.6
    kept = collections.Counter(r["lang"] for r in m.sample(docs, **given).collect())
    assert abs(kept["de"] / kept.total() - 0.4) < 0.02 and abs(kept.total() / len(rows) - 0.9) < 0.03


def test_shuffled_cells_give_the_same(odd, monkeypatch):
    first = sorted(map(str, m.mixing(odd).collect()))
    monkeypatch.setattr(m, "BROADCAST_CELLS", 0)
    assert sorted(map(str, m.mixing(odd).collect())) == first

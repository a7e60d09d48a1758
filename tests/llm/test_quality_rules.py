from __future__ import annotations

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q

duckdb = pytest.importorskip("duckdb")

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count, hit = collections.Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            hit.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def test_odd_rows(odd, none, labels_of):
    none_labelled = labels_of([])
    found = q.quality_rules(odd, none_labelled).collect()
    expected = sorted((str(r["doc_id"]), *plain(r["text"])) for r in odd.collect())
    assert sorted((str(r["doc_id"]), *tuple(r)[1:7]) for r in found) == expected
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert q.quality_rules(none, none_labelled).collect() == []
    kept = q.keep_good(odd, labels_of([(4, 1, 0), (4, 0, None), (None, 1, 0), (5, None, 0), (404, 1, 1)]))
    assert kept.columns == odd.columns and kept.count() == sum(not x[6] for x in expected)


def test_repeats_against_plain_counts(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(300):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 40))]
        text = [rng.choice("abcdefghijk") for _ in range(rng.randint(0, 40))] + block * rng.randint(1, 3) + [rng.choice("abcdefg") for _ in range(rng.randint(0, 20))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(text))
    rows = q.with_counts(spark.createDataFrame(enumerate(texts), "k int, text string")).orderBy("k").collect()
    for r, t in zip(rows, texts, strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(t)[:5]


@pytest.mark.parametrize(("x", "n", "p"), [(0, 100, 0.01), (3, 500, 0.02), (10, 2000, 0.01), (5, 3, 0.5), (0, 100_000, 0.004), (350, 100_000, 0.004)])
def test_binomial(spark, x, n, p):
    found = spark.range(1).select(q.binomial_cdf(F.lit(x).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    if x >= n * p:
        assert found == 1
    else:
        log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
        assert math.isclose(found, sum(math.exp(log(k)) for k in range(x + 1)), rel_tol=1e-8, abs_tol=1e-300)


def test_certified_cutoffs_catch_junk(spark, labels_of, words):
    rng, rows, marks = random.Random(3), [], []
    for k in range(3000):
        junk = k % 6 == 0
        own = words(30)
        text = " ".join(w + ("###" if junk and rng.random() < 0.8 else "") for w in own)
        lang = "en" if k % 3000 else None
        rows.append((k, text, lang, "s", len(text)))
        if k % 2 == 0 or k > 2000:
            marks.append((k, 0 if junk else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = q.quality_rules(docs, labels_of(marks)).collect()
    assert all(r["kept"] for r in found if r["doc_id"] % 6)
    assert not any(r["kept"] for r in found if r["doc_id"] % 6 == 0 and r["doc_id"])
    assert {r["kept"] for r in found if r["doc_id"] == 0} == {True}  # its stratum has too few labels
    few = q.quality_rules(docs, labels_of(marks[:100])).collect()
    assert all(r["kept"] for r in few)


def test_risk_bounds_what_is_lost(spark):
    """Where every cutoff would reject more good documents than the risk allows, none is certified."""
    rows = [(k, " ".join(["a#"] * (k % 10 == 0) * 10 + [f"w{k}x{n}" for n in range(25)]), "en") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counted = q.with_counts(docs.selectExpr("doc_id", "lang as stratum", "text")).drop("text")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(2000)], "doc_id long, quality int, toxic int")
    cuts = q.cutoffs(counted, labels, price=-1e9).first()
    assert cuts["cut_symbols"] is None or cuts["cut_symbols"] > 0.12


def test_native_plan(odd, labels_of):
    plan = q.quality_rules(odd, labels_of([]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_certified_cutoffs_against_sql(spark, words, tmp_path):
    """Two languages with enough labels for some rules, one with too few, and one null."""
    rng, rows, marks = random.Random(11), [], []
    for k in range(6000):
        lang = rng.choice(["en", "en", "de", "de", "fr", None]) if k % 50 == 0 else rng.choice(["en", "de"])
        bad = rng.random() < 0.3
        own = words(rng.randint(22, 40))
        act = rng.choice(["symbols", "capitals", "lines", "long", "plain"]) if bad else "capitals" if rng.random() < 0.002 else "plain"
        if act == "symbols":
            own = [w + rng.choice(["#", "$$", ""]) for w in own]
        elif act == "capitals":
            own = [w.upper() for w in own]
        elif act == "long":
            own = [w * 4 for w in own]
        text = " ".join(own) if act != "lines" else "\n".join(own + own[:6])
        rows.append((k, text, lang, "s", len(text)))
        marks.append((k, 0 if bad else 1, 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, labels = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "labels"))
    counted = q.with_counts(docs.selectExpr("doc_id", "coalesce(lang, '') as stratum", "text")).drop("text")
    cuts = {r["stratum"]: r for r in q.cutoffs(counted, labels).collect()}
    assert sum(cuts[s][f"cut_{rule}"] is not None for s in ("en", "de") for rule in q.RULES) >= 6
    assert all(cuts[s][f"cut_{rule}"] is None for s in ("fr", "") for rule in q.RULES)
    connection = duckdb.connect()  # the shared one has views of these names
    connection.execute(f"create or replace temp view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    connection.execute(f"create or replace temp view labels as select * from '{tmp_path}/labels.parquet/*.parquet'")
    expected = sorted(map(str, connection.execute(q.oracle()).fetchall()))
    found = [tuple(r) for r in q.quality_rules(docs, labels).collect()]
    assert sorted(map(str, found)) == expected and 500 < sum(not r[7] and not r[6] for r in found)

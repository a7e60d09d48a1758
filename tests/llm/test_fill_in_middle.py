"""Fill-in-the-middle against plain regular expressions, and exact round trips."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import fill_in_middle as M
from tidemark.llm.queries import op13_fill_in_middle

UNITS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^ \t\n\x0b\x0c\r]*[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+", "char": r"(?s)."}
TEXT = st.text(st.sampled_from("\n \ta<PSM>é\U0001f600"), max_size=25)


def plain(doc_id, text, unit="line", rate=100, spm=50):
    """(n, form, prefix_chars, middle_chars, output) by the unit's pattern."""
    units = re.findall(UNITS[unit], text)
    assert "".join(units) == text
    n, digest = len(units), hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=600, deadline=None)
@given(st.integers(-9, 10**6), TEXT, st.sampled_from(sorted(UNITS)))
def test_as_plain_patterns(doc_id, text, unit):
    assert M.transformed(doc_id, text, "7", unit, 100, 50) == plain(doc_id, text, unit)


def test_rows(spark, odd):
    texts = ["", None, "\n", "\n\n", "a", "a\n", "\na", "a<P", "<S", "x<M>y", "<<P", "a\r\nb\n", "one\ntwo\nthree", "S>\nM>\nP>\n", "<P\n<S\n<M\n<", "é\n\U0001f600\n你", "\x00\n\x00"]
    rows = [(k * 100 + j, t) for j, t in enumerate(texts) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as form", "1 as n", "2 as output").repartition(3)
    for unit in UNITS:
        found = M.fill_in_middle(df, unit=unit).select("*", M.restored().alias("text")).collect()
        assert sorted((r[0], *r[1:6]) for r in found if r["form"] != "plain") == sorted(y for d, t in rows for y in [(d, *plain(d, t or "", unit))] if y[2] != "plain")
        assert {r["doc_id"]: (r["n"], r["form"], r["output"]) for r in found} == {d: (x[0], x[1], x[4]) for d, t in rows for x in [plain(d, t or "", unit)]}
        assert {r["doc_id"]: r["text"] for r in found} == {d: t or "" for d, t in rows}
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_edges(spark, odd, none):
    found = M.fill_in_middle(odd).select("*", M.restored().alias("text")).collect()
    texts = sorted((r["text"] or "") for r in odd.collect())
    assert sorted(r["text"] for r in found) == texts
    assert M.fill_in_middle(none).collect() == []
    assert [r["doc_id"] for r in found].count(7) == 2 and len({tuple(r) for r in found if r["doc_id"] == 7}) == 1


def test_rates(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "concat('a', char(10), 'b', char(10), id) as text")
    some = M.fill_in_middle(df, rate=30, spm=100).groupBy("form").count().collect()
    share = {r["form"]: r["count"] / 3000 for r in some}
    assert set(share) == {"plain", "spm"} and abs(share["spm"] - 0.3) < 0.05


def test_query_restores_every_text(spark, sf):
    df = op13_fill_in_middle(spark, sf)
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "string", "bigint", "bigint", "string", "string"]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in df.collect():
        n, form, a, b, output = plain(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[1:6] == (n, form, a, b, hashlib.sha256(output.encode()).hexdigest())
        assert r["restored_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()

"""The pipeline's stages against plain versions, on the smallest driver tables and on odd rows."""

from __future__ import annotations

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_decontamination import plain as plain_hits  # noqa: E402
from tests.llm.test_ngram_join import plain_set  # noqa: E402
from tests.llm.test_pii import plain_base  # noqa: E402
from tests.llm.test_quality_rules import plain as plain_quality  # noqa: E402
from tidemark.llm import mixing, pii  # noqa: E402


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert out.columns == names
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert set(after) == {i for i, r in before.items() if not plain_quality(r["text"])[5]}  # labels are too few for rules
        elif name == "ngram_join":
            sets = {i: plain_set(r["text"], 5) for i, r in before.items()}  # five words, 0.8: the definition for near-duplicate stages
            close = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
            up = {i: i for i in sets}
            for _ in range(8):
                for a in sets:
                    for b in sets:
                        if a < b and close(sets[a], sets[b]):
                            up[b] = min(up[a], up[b])
            assert set(after) == {i for i in sets if up[i] == i}
        elif name == "decontamination":
            assert set(after) == {i for i, r in before.items() if not plain_hits(r["text"], items)[4]}
        elif name == "pii":
            assert set(after) == set(before)
            for i, r in before.items():
                base = plain_base(r["text"])
                assert all(r["text"][s:e] not in after[i]["text"] or r["text"].count(r["text"][s:e]) > 1 for s, _, e in base)
                if after[i]["text"] != r["text"]:
                    assert base or "[ID]" in after[i]["text"]
                    assert after[i]["n_chars"] == len(after[i]["text"])
        else:
            chosen = {r["doc_id"] for r in mixing.mixing(spark.read.parquet(str(tmp_path / "pii"))).collect() if r["sampled"]}
            assert set(after) == chosen
        before = after
    assert pii.KINDS[-1] == "id" and len(pipeline.STAGES) == k + 1


def test_odd_rows_pass_every_stage(odd, none, spark, sf):
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd, sf).columns == odd.columns
        assert stage(spark, none, sf).collect() == []


def test_run_is_the_stages(spark, sf):
    assert pipeline.run(spark, sf).count() > 0

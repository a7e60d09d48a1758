from __future__ import annotations

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm import token_counts as t  # noqa: E402


def plain(name, texts):
    path = str(public_tokenizers.path(name))
    if name.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    import tokenizers

    model = tokenizers.Tokenizer.from_file(path)
    return [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_odd_rows(odd, none, name):
    path = str(public_tokenizers.path(name))
    found = t.token_counts(odd, path).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    expected = sorted((str(r["doc_id"]), len(x.encode()), n, n > 4096) for r, x, n in zip(odd.collect(), texts, plain(name, texts), strict=True))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found) == expected
    assert t.token_counts(none, path).collect() == []


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    path, cache = str(public_tokenizers.path("piece_bpe_32k.model")), str(tmp_path / "cache")
    table = lambda: sorted(map(tuple, spark.read.parquet(cache).select("content", "n_tokens").collect()))
    docs = spark.createDataFrame([(k, f"text {k % 3} </s> <s>") for k in range(50)], "doc_id long, text string").repartition(5)
    first = sorted(map(tuple, t.token_counts(docs, path, cache).collect()))
    assert len(table()) == 3 and len(first) == 50
    assert sorted(map(tuple, t.token_counts(docs, path, cache).collect())) == first and len(table()) == 3
    more = docs.unionByName(spark.createDataFrame([(99, "new")], "doc_id long, text string"))
    assert len(t.token_counts(more, path, cache).collect()) == 51 and len(table()) == 4
    other = str(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r["n_tokens"] for r in t.token_counts(docs, other, cache).collect()} == set(plain("byte_bpe_50k.json", ["text 0 </s> <s>", "text 1 </s> <s>", "text 2 </s> <s>"]))
    assert len(table()) == 7


def test_a_text_that_two_runs_appended_counts_once(spark, tmp_path):
    path, cache = str(public_tokenizers.path("piece_bpe_32k.model")), str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "one text"), (2, "one text")], "doc_id long, text string")
    first = sorted(map(tuple, t.token_counts(docs, path, cache).collect()))
    spark.createDataFrame(spark.read.parquet(cache).collect(), t._CACHE).write.mode("append").parquet(cache)
    assert sorted(map(tuple, t.token_counts(docs, path, cache).collect())) == first


def test_equal_after_the_tokenizer_s_own_normaliser_is_one_entry(spark, tmp_path):
    path, cache = str(public_tokenizers.path("word_bpe_49k.json")), str(tmp_path / "cache")  # it lower-cases
    texts = ["Some Words here", "some words HERE", "a <|startoftext|> b", "a <|STARTOFTEXT|> b", "Some words there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in t.token_counts(docs, path, cache).collect()}
    assert [found[k] for k in range(5)] == plain("word_bpe_49k.json", texts)
    assert spark.read.parquet(cache).count() == 4


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_of_one_normal_form_have_one_count(name):
    import random

    rng = random.Random(4)
    encode, normalise, _ = t.load(str(public_tokenizers.path(name)))
    pieces = ["A", "a", " ", "  ", "\t", "É", "e\u0301", "\ufb01", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "\u200b", "\u3000", "x"]
    counts = {}
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))
        assert counts.setdefault(normalise(text), encode([text])[0]) == encode([text])[0], text


def test_a_hot_text_leaves_one_task(spark):
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(k, "the hot text" if k % 3 else f"text {k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    digests = t.staged(docs.mapInArrow(t._digests(path), "doc_id long, content binary, n_bytes long, key long, place long"), "digests")
    none = spark.createDataFrame([], "content binary, n_tokens long")
    moved = [r["text"] for r in t.missing_texts(docs, digests, none, path).collect()]
    assert moved.count("the hot text") == 1 and len(moved) == 301
    assert [r["text"] for r in t.missing_texts(docs, digests, none, path, hot=10_000).collect()].count("the hot text") == 9
    known = digests.where("doc_id % 3 > 0").select("content", t.F.lit(3).cast("long").alias("n_tokens")).distinct()
    assert "the hot text" not in [r["text"] for r in t.missing_texts(docs, digests, known, path).collect()]
    assert t.missing_texts(docs, digests, digests.selectExpr("content", "1L as n_tokens"), path) is None

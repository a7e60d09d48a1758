"""Alignment against plain whole-text encodings and counts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tidemark.llm import alignment as A
from tidemark.llm.queries import op11_tokenizer_alignment, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")


def encoded(text):
    """Ids and bytes of both sides of a whole text, or None."""
    import sentencepiece
    import tokenizers

    if not hasattr(encoded, "models"):
        a = tokenizers.Tokenizer.from_file(PATHS[0])
        a.encode_special_tokens = True
        encoded.models = a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), A.pieces_of(PATHS[0]).bytes
    a, b, raw = encoded.models
    whole = (" " + text).encode()
    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(k) for k in right]
    sides = [(k, raw[k]) for k in left], [(k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()) for k, p in zip(right, pieces, strict=True)]
    return sides if text and all(b"".join(x for _, x in s) == whole for s in sides) else None


def plain(rows):
    """Rows of the contract, token by token."""
    results, corpus = [], Counter()
    for doc, text in rows:
        sides = encoded(text or "")
        if sides is None:
            results.append((doc, None, None, None))
            continue
        a, b = sides
        i = j = at_a = at_b = 0
        links, groups, group = [], [], ([], [])
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            end_a, end_b = at_a + len(a[i][1]), at_b + len(b[j][1])
            if end_a <= end_b:
                group[0].append(a[i][0])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                group[1].append(b[j][0])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append("|".join(",".join(map(str, g)) for g in group))
                group = ([], [])
        corpus.update(links)
        results.append((doc, (len(a), len(b)), links, groups))
    best = Counter()
    for (_, b), n in corpus.items():
        best[b] = max(best[b], n)
    out = []
    for doc, sizes, links, groups in results:
        if sizes is None:
            out.append((doc, *ZERO))
        else:
            out.append((doc, *sizes, len(groups), len(links), sum(corpus[x] == best[x[1]] for x in links), sum(corpus[x] for x in links), ";".join(groups)))
    return out, corpus


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

ODD = [None, "", " ", "   ", "\n", "\n\n  \n", "a", " a", "a  b   c", "x\r\ny \r z;\r\n", "café naïve", "　a 　 b　 c", "a  b  c", "\x1c a\x1c b", "a▁b", "▁",
       "<s> </s> <unk> <|endoftext|> x<|endoftext|>", "\U0001f600\U0001f600 你好世界", "ﬁ Ａ é", "tab\tand\x0bvt\x0c ff", "a\x00b", "don't we'll I'M", "  lead and trail  ", "\x85x \x85 y", "1234567 12,345.67", "a​ b ﻿ c"]


def test_odd_texts_as_whole_texts(spark):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r", "\r\n", "　", " ", "a", "The", "word", "ing", "'s", ",", "...", "12", "é", "你", "\U0001f600", "▁", "<s>", "<|endoftext|>", "\x1f", "​", "_", ");", "}"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    rows = list(enumerate(texts))
    found = A.alignment(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), *PATHS)
    assert found.columns == COLUMNS
    assert order(found.collect()) == order(plain(rows)[0])


def test_edges(spark, odd, none):
    found = A.alignment(odd, *PATHS)
    assert found.columns == COLUMNS
    assert order(found.collect()) == order(plain([(r["doc_id"], r["text"]) for r in odd.collect()])[0])
    assert A.alignment(none, *PATHS).collect() == []
    assert A.pair_counts(none, *PATHS).collect() == []
    named = spark.createDataFrame([("x", "a b"), (None, None)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_links"] > 0 for r in A.alignment(named, *PATHS).collect()} == {"x": True, None: False}


def test_whole_texts_where_words_do_not_apply(monkeypatch):
    texts = [t for t in ODD if t]
    split, whole = A.Aligner(*PATHS), A.Aligner(*PATHS)
    assert split.splits
    whole.splits = False
    one, other = split.block(texts), whole.block(texts)
    assert (one[0] == other[0]).all() and [";".join(x) for x in one[1]] == [";".join(x) for x in other[1]]
    assert all((x == y).all() for x, y in zip(one[2:], other[2:], strict=True))


def test_small_blocks_parts_and_a_short_memory(spark, monkeypatch, words):
    """Many blocks and parts, and sums added in two steps, give the same rows."""
    rows = [(k, " ".join(words(60))) for k in range(60)] + [(100 + k, "the hot text of all") for k in range(90)]
    expected, corpus = plain(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    aligner = A.Aligner(*PATHS)
    links = A._parts(docs, *PATHS, True)[1]
    cells = A.WIDTH * aligner.n_a
    one = A._summed(links, cells, 0)
    monkeypatch.setattr(A, "FAN", 2)
    assert order(one.collect()) == order(A._summed(links, cells, 5 * A.PART - 1).collect())  # five parts, then three, two and one
    monkeypatch.setattr(A, "PART", 500)
    assert order(A.alignment(docs, *PATHS).collect()) == order(expected)
    pairs = A.pair_counts(docs, *PATHS).collect()
    assert {(r["a_id"], r["b_id"]): r["n_links"] for r in pairs} == dict(corpus)
    top = {b: max(n for (_, y), n in corpus.items() if y == b) for _, b in corpus}
    assert all(r["best"] == (r["n_links"] == top[r["b_id"]]) for r in pairs)


def test_a_worker_forgets(monkeypatch, words):
    texts = [[" ".join(words(30)) for _ in range(5)] for _ in range(6)]
    kept = A.Aligner(*PATHS)
    expected = [kept.block(t) for t in texts]
    monkeypatch.setattr(A, "WORDS", 40)
    short = A.Aligner(*PATHS)
    for t, e in zip(texts, expected, strict=True):
        found = short.block(t)
        assert (found[0] == e[0]).all() and found[1] == e[1] and all((x == y).all() for x, y in zip(found[2:], e[2:], strict=True))


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*r[:-1], r[-1] and hashlib.sha256(r[-1].encode()).hexdigest()) for r in plain(rows)[0]]
    found = op11_tokenizer_alignment(spark, sf)
    assert found.columns == [*COLUMNS[:-1], "groups_sha256"]
    assert [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert order(found.collect()) == order(expected)


@pytest.mark.parametrize("values", [[], [0], [255, 3], [256], [1 << 20, 7], [1 << 40]])
def test_packing(values):
    import numpy as np

    assert A._unpack(A._pack(np.array(values, np.int64))).tolist() == values

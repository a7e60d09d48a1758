from __future__ import annotations

import collections
import itertools
import math
import random
import zlib

import numpy as np

from tidemark.llm import hmm


def small_model(states=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    return hmm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states).T)


def test_likelihood_is_the_sum_over_paths():
    m = small_model()
    for sequence in ([0], [1, 2], [3, 0, 1, 1]):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = m.start[path[0]] * m.emit[sequence[0], path[0]]
            for a, b, c in zip(path, path[1:], sequence[1:], strict=False):
                p *= m.step[a, b] * m.emit[c, b]
            total += p
        assert math.isclose(hmm.log_likelihoods([np.array(sequence, np.uint16)], m)[0], math.log10(total))


def test_expected_counts_are_those_of_all_paths():
    m, sequences = small_model(), [np.array(s, np.uint16) for s in ([0, 1, 2], [3], [1, 1])]
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s in sequences:
        paths = []
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for a, b, c in zip(path, path[1:], s[1:], strict=False):
                p *= m.step[a, b] * m.emit[c, b]
            paths.append((path, p))
        total = sum(p for _, p in paths)
        for path, p in paths:
            start[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                step[a, b] += p / total
            for a, c in zip(path, s, strict=True):
                emit[c, a] += p / total
    for found, expected in zip(hmm.expected_counts(sequences, m), (start, step, emit), strict=True):
        assert np.allclose(found, expected)


def test_batches_do_not_matter():
    rng, m = np.random.default_rng(1), small_model()
    sequences = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 5000, 3, 3, 700, 2)]
    together = hmm.log_likelihoods(sequences, m)
    assert np.allclose(together, [hmm.log_likelihoods([s], m)[0] for s in sequences])


def plain_base(rows):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = collections.Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, x in rows:
        t = tokens(x)
        out.append((i, held(i), len(t), sum(w in counts for w in t), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)))
    return out


def check(found, rows):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=key)
    for a, b in zip(got, sorted(plain_base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def test_odd_rows(odd, none):
    found = hmm.hmm_scores(odd, common=200, own=50, rounds=1).collect()
    check(found, [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in found)
    assert hmm.hmm_scores(none).collect() == []


def test_latent_states_help_on_held_out_texts(spark):
    rng = random.Random(4)
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(80)] for letters in ("abcdef", "ghijkl", "mnopqr")]
    rows = [(k, " ".join(rng.choice(tongues[k % 3]) for _ in range(60))) for k in range(300)]
    found = hmm.hmm_scores(spark.createDataFrame(rows, "doc_id long, text string"), own=64, suffix=64, common=100, rounds=6).collect()
    check(found, rows)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.2 * sum(r["n_tokens"] for r in held)


def test_word_probabilities_add_up(spark):
    docs = spark.createDataFrame([(k, "a b b c c c dd dd ee") for k in range(20)], "doc_id long, text string")
    counts = hmm.count_tokens(docs.select("text"))
    v = hmm.Vocabulary(counts, own=2, suffix=8, common=2)
    norms, cache = 10 ** v.log_norms(), {}
    total = collections.Counter()
    for r in counts.where("token is not null").collect():
        w = bytes(r["token"])
        k = v.common[w][0] if w in v.common else hmm._suffix_class(w, 2, 8, cache)
        total[k] += (r["n"] + 0.5) / norms[k] if k >= 2 else 1
    for k, p in total.items():
        assert k < 2 and p == 1 or math.isclose(p + 0.5 / norms[k], 1)


def test_blocks_do_not_matter():
    """Long texts keep only some forward vectors; the counts are those of the whole text."""
    rng, m = np.random.default_rng(2), small_model()
    sequences = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 257, 3, 3, 64, 65, 2)]
    whole = hmm.expected_counts(sequences, m)
    for cells in (1, 2, 7, 64, 128, 300):
        assert all(np.allclose(a, b) for a, b in zip(hmm.expected_counts(sequences, m, cells), whole, strict=True))


def test_a_text_beyond_any_block_is_one_text():
    rng, m = np.random.default_rng(3), small_model()
    long = rng.integers(0, 4, 300_000).astype(np.uint16)
    start, step, emit = hmm.expected_counts([long], m)
    assert math.isclose(start.sum(), 1) and math.isclose(step.sum(), len(long) - 1, rel_tol=1e-9)
    assert np.allclose(emit.sum(axis=1), np.bincount(long, minlength=4))


def plain_scores(rows, own, suffix, states, rounds):
    """The whole operator again: counts, classes, Baum-Welch and likelihoods, one text at a time."""
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter(t for i, x in rows if not held(i) for t in tokens(x))
    ranked = sorted((w for w in counts if w is not None), key=lambda w: (-counts[w], w))
    alone = {w: k for k, w in enumerate(ranked[:own])}
    cls = lambda w: own + suffix if w is None else alone[w] if w in alone else own + hmm.xxhash.xxh64_intdigest(w[-3:]) % suffix
    mass, distinct = np.zeros(own + suffix + 1), np.zeros(own + suffix + 1)
    for w, n in counts.items():
        mass[cls(w)] += n
        distinct[cls(w)] += 1
    prior = (mass + 0.5) / (mass + 0.5).sum()
    model = hmm.Model.first(prior, states)
    for _ in range(rounds):
        start, step, emit = np.ones(states), np.ones((states, states)), prior[:, None] * np.full(states, 10.0)
        for i, x in rows:
            if held(i):
                continue
            s = [cls(w) for w in tokens(x)]
            alpha, beta = [model.start * model.emit[s[0]]], [np.ones(states)]
            for c in s[1:]:
                alpha.append(alpha[-1] @ model.step * model.emit[c])
            for c in reversed(s[1:]):
                beta.insert(0, model.step @ (model.emit[c] * beta[0]))
            total = alpha[-1].sum()
            for t, c in enumerate(s):
                emit[c] += alpha[t] * beta[t] / total
                if t:
                    step += np.outer(alpha[t - 1], model.emit[c] * beta[t]) * model.step / total
            start += alpha[0] * beta[0] / total
        model = hmm.Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    out = {}
    for i, x in rows:
        s = [cls(w) for w in tokens(x)]
        alpha = model.start * model.emit[s[0]]
        for c in s[1:]:
            alpha = alpha @ model.step * model.emit[c]
        shared = sum(math.log10((counts[w] + 0.5) / (mass[cls(w)] + 0.5 * (distinct[cls(w)] + 1))) for w in tokens(x) if own <= cls(w) < own + suffix)
        out[i] = math.log10(alpha.sum()) + shared
    return out


def test_scores_against_a_plain_model(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(40)]
    rows = [(k, " ".join(rng.choice(vocabulary[k % 3 * 10 :]) for _ in range(rng.randint(0, 25)))) for k in range(60)] + [(60, None), (61, "never seen words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for common in (100, 6):  # 6: most words' counts come by the join
        found = {r["doc_id"]: r["score"] for r in hmm.hmm_scores(docs, states=3, rounds=2, own=6, suffix=5, common=common).collect()}
        expected = plain_scores(rows, 6, 5, 3, 2)
        assert set(found) == set(expected)
        if common == 100:
            assert all(math.isclose(found[i], expected[i], rel_tol=1e-9) for i in expected)
        else:
            assert all(math.isfinite(found[i]) for i in expected)

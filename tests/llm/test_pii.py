from __future__ import annotations

import hashlib
import random
import re
import time

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_is_the_plain_expressions():
    rng = random.Random(1)
    for alphabet in ("a1.@-", "a1.@-+ 2(%_", "0123456789 -", "12.5 ", "+1 ()-.9", "a@b.c@é-._"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
            assert pii.base_spans(text) == plain_base(text), text
    for text in ["4111 1111 1111 1111", "a@b@c.d", "x@y.z_w@v.u", "1.2.3.4.5.6.7.8", "000255.0.0.1", "9" * 40, "+1 (017) 555-7713.", "a@b..c"]:
        assert pii.base_spans(text) == plain_base(text), text


def test_base_is_linear():
    began = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "+1 (" * 50_000, "a.b@" * 50_000, "1 " * 100_000):
        pii.analyse(text.encode())
    assert time.time() - began < 10


def test_odd_rows(odd, none, spark):
    found = pii.find(odd).collect()
    assert len(found) == 10 and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in found)
    assert pii.find(none).collect() == [] and pii.redact(none).collect() == []
    out = pii.redact(odd)
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))


def test_every_kind_is_counted_by_itself(spark):
    texts = ["a@b.c 1.2.3.4 5.6.7.8 4111 1111 1111 1111 +1 (017) 555-7713", "1.2.3.4 a@b.c d@e.f", "4111 1111 1111 1111", "+1 (017) 555-7713, +1 (017) 555-7714", "none", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(rows).collect():
        base = plain_base(texts[r["doc_id"]] or "")
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(kind == k for _, kind, _ in base) for k in range(4)], texts[r["doc_id"]]


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = []
    for k in range(40):
        rows.append((k, f"please call user{k}@mail.example.com now. ticket {k}"))
        rows.append((100 + k, f"the total {rng.randrange(10**7, 10**8)} units were sold in all of spring"))
    rows += [(900 + k, f"hello, please call AB-{7000000 + k} now.") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert found[0]["n_email"] == 1 and found[0]["spans"].startswith("email:12:")
    start = len("hello, please call ")
    assert all(found[900 + k]["spans"] == f"id:{start}:{start + 10}" for k in range(3))
    assert all(found[900 + k]["base_sha256"] == hashlib.sha256(b"").hexdigest() for k in range(3))
    assert all(found[100 + k]["spans"] == "" for k in range(40))
    accepted = {r["pattern"] for r in pii.patterns(docs).collect()}
    assert "call _" in accepted and "total _" not in accepted
    clean = {r["doc_id"]: r for r in pii.redact(docs.selectExpr("*", "length(text) as n_chars")).collect()}
    assert clean[0]["text"] == "please call [EMAIL] now. ticket 0" and clean[0]["n_chars"] == 33
    assert clean[900]["text"] == "hello, please call [ID] now."


def test_overlapping_spans_are_one():
    assert pii.redacted("abcdefgh", [(1, 2, 4), (3, 3, 6), (7, 1, 8)]) == "a[CARD]g[IP]"


def plain_patterns(texts, rounds, confidence=pii.CONFIDENCE, support=pii.SUPPORT, share=pii.SHARE):
    """The bootstrap again, on lists of words and dictionaries."""
    units = []  # per text: (core, is a seed, covered) of its words, a base span as one unit
    for text in texts:
        page = pii.Page((text or "").encode())
        own, at, seeds = [], 0, sorted(page.seeds())
        cores = [page.core(k) for k in range(len(page.places))]
        for a, b, what in seeds:
            own.append((a, b, what))
        units.append((cores, own))
    words_of = lambda c, a, b: [c[k] if 0 <= k < len(c) else b"" for k in (a - 2, a - 1, b + 1)]

    def around(second, first, after):
        out = []
        if first:
            out.append(first + b" _")
            if second:
                out.append(second + b" " + first + b" _")
            if after:
                out.append(first + b" _ " + after)
        return out + ([b"_ " + after] if after else [])

    def occurrences():
        for cores, own in units:
            inside = {k for a, b, _ in own for k in range(a, b + 1)}
            for a, b, what in own:
                for p in around(*words_of(cores, a, b)):
                    yield p, what, True
            for k, core in enumerate(cores):
                if core and k not in inside:
                    for p in around(*words_of(cores, k, k)):
                        yield p, core, False

    every = list(occurrences())
    beliefs, believed_contexts, accepted = {}, [], {}
    for p, what, seed in every:
        if seed:
            beliefs[what] = 1.0
            believed_contexts.append((p, what))
    for number in range(rounds):
        known, times = {}, {}
        for p, what in believed_contexts:
            known.setdefault(p, set()).add(what)
            times[p] = times.get(p, 0) + 1
        others = {}
        for p, _, seed in every:
            others[p] = others.get(p, 0) + (not seed)
        left = {p for p, x in known.items() if len(x) >= support and times[p] >= share * (times[p] + others[p])}
        members = {p: set() for p in left}
        for p, what, _ in every:
            if p in left:
                members[p].add(what)
        accepted = {}
        for p, x in members.items():
            value = sum(beliefs.get(i, 0.0) for i in x) / (len(x) + 1)
            if value >= confidence and sum(beliefs.get(i, 0.0) >= 0.5 for i in x) >= support:
                accepted[p] = value
        reached = {}
        for p in accepted:
            for i in members[p]:
                reached.setdefault(i, []).append(accepted[p])
        new = {}
        for i, x in reached.items():
            belief = 1.0
            for value in x:
                belief *= 1 - min(value, 0.999)
            if i not in beliefs and len(x) > 1 and 1 - belief >= 0.5:
                new[i] = 1 - belief
        if not new:
            break
        beliefs.update(new)
        believed_contexts += [(p, what) for p, what, seed in every if not seed and what in new]
    return {p.decode(): v for p, v in accepted.items()}


def texts_of_many_kinds(rng):
    filler = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te") for b in ("ra", "ne", "vo", "pi")]
    some = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    out = []
    for k in range(160):
        kind = k % 8
        if kind in (0, 6, 7):
            out.append(f"{some(4)} write to user{k}@mail{k % 3}.example.org today {some(5)}")
        elif kind == 1:
            out.append(f"{some(4)} write to Agent-{k // 8 % 10}X today {some(5)}")  # unseen, in the same frame
        elif kind == 2:
            out.append(f"{some(3)} handle Agent-{k // 8 % 10}X speaking {some(3)}")  # taught by the frame before
        elif kind == 3:
            out.append(f"{some(3)} secret = \"{k:04d}abcdef{k * 7919:010d}fedc\" {some(3)}")
        elif kind == 4:
            out.append(f"{some(3)} the +1 (212) 555-{1000 + k} {some(3)}")
        elif kind == 5:
            out.append(f"{some(3)} the {rng.choice(filler)} of the {rng.choice(filler)} {some(3)} the {some(2)}")
        else:
            out.append(f"{some(6)}.\n{some(8)}")
    return out + [None, "", "handle ZED-1 speaking", 'secret = "swordfish" ' + "x" * 5000, "y" * 200 + " write to " + "Q" * 300 + " today " + "z" * 400]


def test_the_bootstrap_against_plain_lists(spark):
    texts = texts_of_many_kinds(random.Random(6))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for rounds in (1, 2, 3):
        expected = plain_patterns(texts, rounds)
        found = {r["pattern"]: r["confidence"] for r in pii.patterns(docs, rounds=rounds).collect()}
        assert set(found) == set(expected) and all(abs(found[p] - expected[p]) < 1e-9 for p in found)
    assert "to _ today" in found and "handle _" in found and "secret = _" in found and "the _" not in found
    spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    cut = lambda i: [texts[i][int(s):int(e)] for kind, s, e in (x.split(":") for x in spans[i].split(",") if x) if kind == "id"]
    assert cut(162) == ["ZED-1"] and cut(163) == ["swordfish"] and cut(164) == ["Q" * 300]  # long words are whole
    right = {"Agent", "ZED-1", "swordfish", "Q" * 300}
    flagged = [w for i in range(len(texts)) if texts[i] for w in cut(i)]
    assert flagged and all(w.split("-")[0] in right or w in right or pii.is_key(w.encode()) for w in flagged)  # precision 1
    assert all(cut(k) for k in range(160) if k % 8 in (1, 2, 3))  # recall 1


def test_a_key_is_no_span_by_itself(spark):
    docs = spark.createDataFrame([(1, "a commit 0123456789abcdef0123456789abcdef here")], "doc_id long, text string")
    assert pii.find(docs).first()["spans"] == ""

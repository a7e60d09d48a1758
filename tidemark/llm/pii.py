"""Personal data by bootstrapped contextual extraction (operator 1).

*Base* spans come from fixed expressions (email, ip, card, phone).  They seed a
graph between lexical patterns (the words before and after an identifier) and
instances, and so do *keys*: words of at least 20 letters, digits, ``-`` and
``_``, five of each kind or more.  A key is no span by itself, only in an
accepted pattern.

A round of the bootstrap:

1. *Induction.*  The contexts of all believed instances (first the seeds) are
   patterns; candidates are those that at least ``support`` of them share.
2. *Pruning.*  All occurrences of the candidates are counted; one of which fewer
   than ``share`` are believed instances says nothing, and is left.
3. *Graph.*  Every word in a candidate's context, whatever it looks like, is an
   instance of it.  Spark scores the graph: a pattern's confidence is the
   belief-weighted share of its distinct instances, smoothed by one unknown; it
   is accepted at ``confidence`` with ``support`` believed instances.
4. *Discovery.*  An instance that is no seed takes the noisy or of its accepted
   patterns once there are two of them, so that no pattern confirms itself; those
   believed by a half or more seed the next round, which ends when there are none.

Words in an accepted context are added as spans of kind ``id``; base spans
always stay.  Context words are whole words, of any length.

Every step is a pass over the texts with a filter of fixed size for what is
sought (2 MB; what it lets through by chance is dropped by an exact join), so
only contexts of believed instances and words in candidates' contexts leave a
task, as hashes, combined per batch.  Texts are never shuffled by ``find``.

The expressions run in linear time on any text: an email is sought around each
``@``, digit runs are entered at their start and never given back.

Defined results: a null text is empty (no spans); very long texts are read
whole; patterns of equal confidence are accepted alike; repeated rows give
repeated results, their instances count once; an empty table gives an empty
result; other columns play no role.
"""

from __future__ import annotations

import bisect
import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary, bitmap, may_have, staged, whole_text
from tidemark.llm.words import chunks, mix, split_words

KINDS = ("email", "ip", "card", "phone", "id")
CONFIDENCE, SUPPORT, SHARE, ROUNDS = 0.8, 5, 0.1, 3

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_KEY = re.compile(rb"[A-Za-z0-9_-]{20,}")
_NOT_DIGIT = bytes(c for c in range(256) if not 0x30 <= c <= 0x39)
_LETTERS = str.maketrans({c: None for c in " ().+-"})
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
_LETTER = bytes(c for c in range(256) if not (0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A))
_EDGE = ".,;:!?()[]{}<>\"'|#*$%&"
_EDGE_BYTES = _EDGE.encode()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(x)] for x in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str):
    at, done, floor = text.find("@"), 0, 0
    while at >= 0:
        floor = max(floor, done)
        local = text[floor:at]
        start = floor + len(local.rstrip(_LOCAL))
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            yield start, match.end()
            done = match.end()
        floor = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str, has_digits: bool = True) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end), ascending."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if has_digits:
        for m in _IP.finditer(text):
            if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].translate(_LETTERS)
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(m[0].translate(_LETTERS)) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def is_key(core: bytes) -> bool:
    return len(core) >= 20 and _KEY.fullmatch(core) is not None and len(core.translate(None, _NOT_DIGIT)) >= 5 and len(core.translate(None, _LETTER)) >= 5


def core_of(word: bytes) -> bytes:
    return word.strip(_EDGE_BYTES).lower()


def _hash(core: bytes) -> int:
    """0 for no word."""
    return (xxhash.xxh3_64_intdigest(core) or 1) if core else 0


def codes(second: np.ndarray, first: np.ndarray, after: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(code, whether there is one) of the four patterns around an instance: "first _", "second first _", "first _ after", "_ after"."""
    a, b = mix(first + np.uint64(0x9E3779B97F4A7C15)), mix(after + np.uint64(0xC2B2AE3D27D4EB4F))
    has_first, has_after = first != 0, after != 0
    return [(a, has_first), (mix(a ^ mix(second + np.uint64(0x165667B19E3779F9))), has_first & (second != 0)), (mix(a + b), has_first & has_after), (b, has_after)]


class Page:
    """The words of one text, and its seeds."""

    def __init__(self, raw: bytes):
        digits = raw.translate(None, _NOT_DIGIT)
        self.text = raw.decode()
        self.base = base_spans(self.text, bool(digits)) if digits or b"@" in raw else []
        self._places: list[tuple[int, int]] | None = None
        self.keys = [k for k, w in enumerate(raw.split()) if is_key(core_of(w))] if len(digits) >= 5 and _KEY.search(raw) else []

    @property
    def places(self) -> list[tuple[int, int]]:
        """[start, end) of every word, in code points."""
        if self._places is None:
            self._places = [m.span() for m in _WORD.finditer(self.text)]
        return self._places

    def covered(self) -> list[tuple[int, int]]:
        """[first, last] words of every base span."""
        if not self.base:
            return []
        starts, ends = [a for a, _ in self.places], [b for _, b in self.places]
        return [(bisect.bisect_right(ends, s), bisect.bisect_left(starts, e) - 1) for s, _, e in self.base]

    def core(self, word: int) -> bytes:
        start, end = self.places[word] if 0 <= word < len(self.places) else (0, 0)
        return core_of(self.text[start:end].encode())

    def span(self, word: int) -> tuple[int, int]:
        """The word without the marks around it."""
        start, end = self.places[word]
        whole = self.text[start:end]
        return start + len(whole) - len(whole.lstrip(_EDGE)), end - len(whole) + len(whole.rstrip(_EDGE))

    def seeds(self) -> list[tuple[int, int, bytes]]:
        """(first word, last word, what it is) of base spans, and of keys in none."""
        covered = self.covered()
        inside = {w for a, b in covered for w in range(a, b + 1)}
        found = [(a, b, self.text[s:e].lower().encode()) for (a, b), (s, _, e) in zip(covered, self.base, strict=True)]
        return found + [(k, k, self.core(k)) for k in self.keys if k not in inside]


def analyse(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, bytes]]]:
    """Base spans, and seeds by their words."""
    page = Page(raw)
    return page.base, page.seeds()


class Chunk:
    """The words of many texts as hashes, with the codes of the patterns around each of them."""

    def __init__(self, text: pa.Array):
        self.offsets, index, words = split_words(text)
        hashed = np.array([_hash(w.strip(_EDGE_BYTES)) for w in words], np.uint64)
        self.instance = hashed[index] if len(words) else np.zeros(0, np.uint64)
        self.raw = [x or b"" for x in text.cast(pa.binary()).to_pylist()]
        self.free = self.instance != 0

    def neighbour(self, step: int) -> np.ndarray:
        """The word ``step`` places on in the same text, 0 where there is none."""
        n, out = len(self.instance), np.zeros(len(self.instance), np.uint64)
        owner = np.repeat(np.arange(len(self.raw)), np.diff(self.offsets))
        here = np.arange(max(0, -step), min(n, n - step))
        here = here[owner[here] == owner[here + step]]
        out[here] = self.instance[here + step]
        return out

    def codes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return codes(self.neighbour(-2), self.neighbour(-1), self.neighbour(1))

    def hide(self, keys: bool) -> None:
        """The words of base spans, and of ``keys`` where wanted, are no instances of their own."""
        for k, raw in enumerate(self.raw):
            page = Page(raw) if b"@" in raw or len(raw.translate(None, _NOT_DIGIT)) >= 4 else None
            if page is not None and (page.base or page.keys):
                for a, b in [*page.covered(), *((w, w) for w in page.keys if keys)]:
                    self.free[self.offsets[k] + a : self.offsets[k] + b + 1] = False


def _chunks(batches):
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        for start, end in chunks(column):
            yield batch.slice(start, end - start)


_CONTEXT = "code long, pattern string, instance long, n long"


def _context_batch(rows: list[tuple[bytes, bytes, bytes, int]]) -> pa.RecordBatch:
    """Patterns around instances, given as (second, first, after, instance), with the number of times."""
    table: collections.Counter = collections.Counter()
    if rows:
        hashed = [np.array([_hash(r[k]) for r in rows], np.uint64) for k in range(3)]
        for kind, (code, valid) in enumerate(codes(*hashed)):
            for k in np.flatnonzero(valid):
                second, first, after, instance = rows[k]
                words = ([first, b"_"], [second, first, b"_"], [first, b"_", after], [b"_", after])[kind]
                table[int(code[k].view(np.int64)), b" ".join(words).decode(), instance] += 1
    columns = list(zip(*table, strict=True)) if table else [(), (), ()]
    kinds = [pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), pa.array(list(table.values()), pa.int64())], names=["code", "pattern", "instance", "n"])


def _around(page: Page, a: int, b: int, instance: int) -> tuple[bytes, bytes, bytes, int]:
    return page.core(a - 2), page.core(a - 1), page.core(b + 1), instance


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _seed_contexts(batches):
    for part in _chunks(batches):
        rows = []
        for raw in binary(part, "__tm_text"):
            if b"@" in raw or len(raw.translate(None, _NOT_DIGIT)) >= 4:
                page = Page(raw)
                rows += [_around(page, a, b, _signed(_hash(what))) for a, b, what in page.seeds()]
        yield _context_batch(rows)


def _contexts_of(sought):
    """Contexts of the words whose hash may be in the filter ``sought``."""

    def run(batches):
        for part in _chunks(batches):
            chunk = Chunk(part.column(0))
            hit = np.flatnonzero(may_have(sought.value, chunk.instance) & chunk.free)
            rows, pages = [], {}
            if len(hit):
                chunk.hide(keys=True)
            for k in hit[chunk.free[hit]]:
                doc = int(np.searchsorted(chunk.offsets, k, "right")) - 1
                if doc not in pages:
                    pages = {doc: Page(chunk.raw[doc])}
                word = int(k - chunk.offsets[doc])
                rows.append(_around(pages[doc], word, word, int(chunk.instance[k].view(np.int64))))
            yield _context_batch(rows)

    return run


def _met(sought, pairs: bool):
    """(code, instance, n) of the patterns that may be in the filter ``sought``; without ``pairs`` all instances as one, 0."""

    def run(batches):
        for part in _chunks(batches):
            chunk = Chunk(part.column(0))
            found = [(code, np.flatnonzero(valid & chunk.free & may_have(sought.value, code))) for code, valid in chunk.codes()]
            if any(len(at) for _, at in found):
                chunk.hide(keys=True)
            own = [(code[at[chunk.free[at]]], chunk.instance[at[chunk.free[at]]]) for code, at in found]
            code = np.concatenate([c for c, _ in own])
            instance = np.concatenate([i for _, i in own]) if pairs else np.zeros(len(code), np.uint64)
            order = np.lexsort((instance, code)) if pairs else np.argsort(code)
            code, instance = code[order], instance[order]
            fresh = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (instance[1:] != instance[:-1])])) if len(code) else order
            n = np.diff(np.concatenate([fresh, [len(code)]]))
            yield pa.RecordBatch.from_arrays([pa.array(code[fresh].view(np.int64)), pa.array(instance[fresh].view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "instance", "n"])

    return run


_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("stop", pa.int32())])
_FOUND = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("codes", pa.list_(pa.int64()))])
_NEW = "__tm_base array<struct<start int, rank int, stop int>>, __tm_sha string, __tm_found array<struct<start int, stop int, codes array<long>>>"


def label(span: tuple[int, int, int]) -> str:
    return f"{KINDS[span[1]]}:{span[0]}:{span[2]}"


def _in_patterns(text: pa.Array, sought: bytes | None) -> tuple[list[Page], list[list[dict]]]:
    """Every text, and its words outside base spans whose patterns may be in the filter."""
    if sought is None:
        pages = [Page(x or b"") for x in text.cast(pa.binary()).to_pylist()]
        return pages, [[] for _ in pages]
    chunk = Chunk(text)
    pages, codes_at = [Page(x) for x in chunk.raw], collections.defaultdict(list)
    for code, valid in chunk.codes():
        for k in np.flatnonzero(valid & chunk.free & may_have(sought, code)):
            codes_at[int(k)].append(int(code[k].view(np.int64)))
    found: list[list[dict]] = [[] for _ in pages]
    hidden: dict[int, set[int]] = {}
    for k in sorted(codes_at):
        doc = int(np.searchsorted(chunk.offsets, k, "right")) - 1
        page, word = pages[doc], k - int(chunk.offsets[doc])
        if doc not in hidden:
            hidden[doc] = {w for a, b in page.covered() for w in range(a, b + 1)}
        if word not in hidden[doc]:
            start, stop = page.span(word)
            found[doc].append({"start": start, "stop": stop, "codes": codes_at[k]})
    return pages, found


def _analysed(docs: DataFrame, text: str, keep_text: bool, accepted: DataFrame) -> DataFrame:
    """``docs`` with row ids, base spans, their digest, and the words that may be in accepted patterns."""
    kept = [f for f in docs.schema if keep_text or f.name != text]
    sought = None if accepted.isEmpty() else docs.sparkSession.sparkContext.broadcast(bitmap(accepted, "code"))

    def run(batches):
        for part in _chunks(batches):
            pages, found = _in_patterns(part.column(part.num_columns - 1), sought.value if sought else None)
            base = pa.array([[dict(zip(("start", "rank", "stop"), s, strict=True)) for s in p.base] for p in pages], pa.list_(_SPAN))
            sha = pa.array([hashlib.sha256(",".join(map(label, p.base)).encode()).hexdigest() for p in pages], pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(part.num_columns - 1)), base, sha, pa.array(found, pa.list_(_FOUND))], names=[*part.schema.names[:-1], "__tm_base", "__tm_sha", "__tm_found"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "__tm_row long", _NEW])
    rows = docs.select(*(f"`{f.name}`" for f in kept), F.monotonically_increasing_id().alias("__tm_row"), whole_text(text).alias("__tm_text"))
    return staged(rows.mapInArrow(run, schema), "pii")  # row ids are fixed from here on


def patterns(docs: DataFrame, text: str = "text", confidence: float = CONFIDENCE, support: int = SUPPORT, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """Accepted patterns of the texts: (code, pattern, confidence, support, instances)."""
    spark = docs.sparkSession
    texts = docs.select(whole_text(text).alias("__tm_text"))

    def scan(run, schema: str) -> DataFrame:
        return texts.mapInArrow(run, schema)

    contexts = staged(scan(_seed_contexts, _CONTEXT).groupBy("code", "instance").agg(F.min("pattern").alias("pattern"), F.sum("n").alias("n")), "pii-contexts")
    seeds = contexts.select("instance").distinct()
    beliefs = staged(seeds.withColumn("belief", F.lit(1.0)), "pii-beliefs")  # of all instances that are believed so far
    edges = accepted = None
    for number in range(rounds):
        known = contexts.groupBy("code").agg(F.min("pattern").alias("pattern"), F.count("*").alias("support"), F.sum("n").alias("n"))
        candidates = staged(known.where(F.col("support") >= support), "pii-candidates")
        if candidates.isEmpty():
            break
        filter_ = spark.sparkContext.broadcast(bitmap(candidates, "code"))
        times = scan(_met(filter_, False), "code long, instance long, n long").groupBy("code").agg(F.sum("n").alias("others"))
        left = staged(candidates.join(times, "code", "left").where(F.col("n") >= share * (F.col("n") + F.coalesce("others", F.lit(0)))), "pii-left")
        if left.isEmpty():
            break
        filter_ = spark.sparkContext.broadcast(bitmap(left, "code"))
        words = scan(_met(filter_, True), "code long, instance long, n long").select("code", "instance").distinct().join(left.select("code"), "code", "left_semi")
        edges = staged(words.unionByName(contexts.select("code", "instance").join(left.select("code"), "code", "left_semi")).distinct(), "pii-edges")
        joined = edges.join(beliefs, "instance", "left")
        scored = joined.groupBy("code").agg((F.sum(F.coalesce("belief", F.lit(0.0))) / (F.count("*") + 1)).alias("confidence"), F.count("*").alias("instances"), F.count_if(F.col("belief") >= 0.5).alias("support"))
        accepted = staged(scored.where((F.col("confidence") >= confidence) & (F.col("support") >= support)).join(left.select("code", "pattern"), "code"), "pii-patterns")
        if number + 1 == rounds:
            break
        reached = edges.join(accepted, "code").groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("belief"), F.count("*").alias("of")).where("of > 1 and belief >= 0.5").drop("of")
        new = staged(reached.join(beliefs, "instance", "left_anti"), "pii-new")
        if new.isEmpty():
            break
        beliefs = staged(beliefs.unionByName(new), "pii-beliefs")
        filter_ = spark.sparkContext.broadcast(bitmap(new, "instance"))
        more = scan(_contexts_of(filter_), _CONTEXT).join(new.select("instance"), "instance", "left_semi").select("code", "instance", "pattern", "n")
        contexts = staged(contexts.unionByName(more).groupBy("code", "instance").agg(F.min("pattern").alias("pattern"), F.sum("n").alias("n")), "pii-contexts")
    return accepted if accepted is not None else spark.createDataFrame([], "code long, confidence double, instances long, support long, pattern string")


def _all_spans(analysed: DataFrame, accepted: DataFrame) -> DataFrame:
    """``analysed`` with ``__tm_all``: base and added spans in order."""
    token = analysed.select("__tm_row", F.explode("__tm_found").alias("x"))
    uses = token.select("__tm_row", F.struct(F.col("x.start").alias("start"), F.lit(KINDS.index("id")).alias("rank"), F.col("x.stop").alias("stop")).alias("span"), F.explode("x.codes").alias("code"))
    added = uses.join(accepted.select("code"), "code").groupBy("__tm_row").agg(F.collect_set("span").alias("__tm_added"))
    open_ = F.size("__tm_found") > 0
    some = analysed.where(open_).join(staged(added, "pii-added"), "__tm_row", "left")
    merged = F.array_sort(F.when(F.col("__tm_added").isNull(), F.col("__tm_base")).otherwise(F.concat("__tm_base", "__tm_added")))
    names = [*analysed.columns, "__tm_all"]
    rest = analysed.where(~open_).withColumn("__tm_all", F.col("__tm_base"))
    return rest.select(names).unionByName(some.withColumn("__tm_all", merged).select(names))


def _label(span):
    return F.concat(F.element_at(F.array(*map(F.lit, KINDS)), span["rank"] + 1), F.lit(":"), span["start"].cast("string"), F.lit(":"), span["stop"].cast("string"))


def _of_kind(kind: int):
    """The number of base spans of a kind; the lambda has one parameter, since Spark gives a second one the element's index."""
    return F.size(F.filter("__tm_base", lambda x: x["rank"] == kind)).cast("long")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **graph) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    accepted = patterns(rows, "text", **graph)
    spans = _all_spans(_analysed(rows, "text", False, accepted), accepted)
    counts = [_of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return spans.select("doc_id", *counts, F.col("__tm_sha").alias("base_sha256"), F.array_join(F.transform("__tm_all", _label), ",").alias("spans"))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span, overlapping ones as one, replaced by its kind in brackets."""
    out, at, k = [], 0, 0
    while k < len(spans):
        start, kind, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", **graph) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced, and ``n_chars`` (where there is one) counted anew where that changed it; null texts stay null."""
    accepted = patterns(docs, text, **graph)
    spans = _all_spans(_analysed(docs, text, True, accepted), accepted).select(*(f"`{c}`" for c in docs.columns), "__tm_all")
    at = docs.columns.index(text)
    size = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns[:-1])
            texts = columns[at].to_pylist()
            sizes = columns[size].to_pylist() if size is not None else None
            for k, row in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if row and texts[k] is not None:
                    texts[k] = redacted(texts[k], [(x["start"], x["rank"], x["stop"]) for x in row])
                    if sizes is not None:
                        sizes[k] = len(texts[k])
            columns[at] = pa.array(texts, pa.string())
            if sizes is not None:
                columns[size] = pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return spans.mapInArrow(run, ", ".join(f"`{f.name}` {'string' if f.name == text else f.dataType.simpleString()}" for f in docs.schema))

"""Benchmark decontamination by word-level Wu-Manber search (operator 10).

Every benchmark item gives windows of ``window`` consecutive words; an item of
fewer words gives one window of all of them.  Windows of equal length form one
searcher.  Its *shift* table is keyed by blocks of two words and tells how far
the search position may move without passing an occurrence; where the shift is
zero, the *bucket* of the suffix block, divided by prefix block, names the
windows that direct comparison then confirms or refutes.

Words are numbers of the benchmark's own vocabulary and the tables are sorted
arrays over the items' words, so a searcher takes about 40 bytes a word of the
benchmark, besides the vocabulary.

*Blocks.*  Items are cut into pieces of ``PIECE`` words that overlap, so that no
window is lost and none is large, repeated pieces are one, and the pieces are
dealt into as many blocks as keep each at ``block_bytes`` at most.  One block at
a time is drawn to the driver, made into searchers, sent to the tasks and
searched in a pass over the documents, so any number of blocks takes the memory
of one.  With several blocks, only the hits leave a pass, under a digest of the
text, and only documents that have hits are joined with them; all others take no
part in a shuffle.

Defined results: a null or empty text has no words (all counts 0, not
contaminated); very long texts and items are searched whole; repeated rows give
repeated results, repeated items count once by their id; items that are null or
without words have no windows; an item whose id is null marks words but is not
listed; an empty benchmark hits nothing, an empty table gives an empty result;
other columns of the inputs play no role.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary, bitmap, may_have, staged, whole_text

WINDOW = 13
BLOCK_BYTES, PIECE = 16 << 20, 10_000

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TABLE = bytes(c if c in set(_WORD) else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class WuManber:
    """Finds the windows of ``length`` numbers of some items, whose numbers are below ``size``; -1 is a word of no item."""

    def __init__(self, length: int, items: list[np.ndarray], owners: list[int], size: int):
        self.length, self.size, self.block = length, size, min(2, length)
        self.default = length - self.block + 1
        self.stream = np.concatenate(items)
        sizes = np.array([len(x) for x in items], np.int64)
        first = np.cumsum(sizes) - sizes
        keys = self._keys(self.stream)
        place = np.arange(len(keys))
        item = np.repeat(np.arange(len(items)), sizes)[: len(keys)]
        inside = place + self.block <= first[item] + sizes[item]
        shift = length - self.block - (place - np.maximum(first[item], place - length + self.block))  # by the window that has the block farthest right
        order = np.lexsort((shift, keys))
        order = order[inside[order]]
        fresh = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        self.keys, self.shift = keys[order[fresh]], shift[order[fresh]].astype(np.int8 if length < 128 else np.int64)
        start = place[place + length <= first[item] + sizes[item]]
        suffix, prefix = keys[start + length - self.block], keys[start]
        order = np.lexsort((prefix, suffix))
        self.start, self.suffix, self.prefix = start[order], suffix[order], prefix[order]
        self.owner = np.array(owners, np.int64)[item[self.start]]

    def _keys(self, numbers: np.ndarray) -> np.ndarray:
        """The blocks of a text as numbers, -1 where a word is in no item."""
        if self.block == 1:
            return numbers
        return np.where((numbers[:-1] >= 0) & (numbers[1:] >= 0), numbers[:-1] * self.size + numbers[1:], -1)

    def search(self, numbers: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Yields the start of every occurrence, ascending, and the owners of the windows there."""
        m, before = self.length, self.length - self.block
        if len(numbers) < m:
            return
        keys = self._keys(numbers)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        steps = np.where(self.keys[at] == keys, self.shift[at], self.default)
        if steps[before:].all():
            return
        steps, end = steps.tolist(), before
        while end < len(steps):
            if steps[end]:
                end += steps[end]
                continue
            start = end - before
            lo, hi = np.searchsorted(self.suffix, keys[end]), np.searchsorted(self.suffix, keys[end], "right")
            low, high = (lo + np.searchsorted(self.prefix[lo:hi], keys[start], side) for side in ("left", "right"))
            if low < high:
                windows = self.stream[self.start[low:high, None] + np.arange(m)]
                same = (windows == numbers[start : start + m]).all(axis=1)
                if same.any():
                    yield start, self.owner[low:high][same].tolist()
            end += 1


class Searcher:
    """All windows of some items: the vocabulary, the items' ids and a finder for each length."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        by_length: dict[int, tuple[list[np.ndarray], list[int]]] = {}
        for item, text in items:
            numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)], np.int64)
            if len(numbers):
                arrays, owners = by_length.setdefault(min(window, len(numbers)), ([], []))
                arrays.append(numbers)
                owners.append(len(self.ids))
                self.ids.append(item)
        self.finders = [WuManber(size, *of, len(self.vocabulary)) for size, of in sorted(by_length.items())]

    def occurrences(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) spans of hit words, and the items found."""
        spans, found = [], set()
        if words and self.finders:
            numbers = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
            for finder in self.finders:
                for start, owners in finder.search(numbers):
                    spans.append((start, start + finder.length))
                    found.update(self.ids[k] for k in owners)
        return merged(spans), found - {None}


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def verdict(n_words: int, spans: list[tuple[int, int]], items: set[str]) -> tuple:
    n_hit = sum(end - start for start, end in spans)
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n_words


_RESULT = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _with_columns(batch: pa.RecordBatch, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    arrays = [pa.array(c, _ARROW[_RESULT[n]]) for n, c in zip(names, columns, strict=True)]
    kept = [i for i, n in enumerate(batch.schema.names) if n != "__tm_text"]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *arrays], names=[*(batch.schema.names[i] for i in kept), *(f"__tm_{n}" for n in names)])


def _pieces(window: int, piece: int):
    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), binary(batch, "text"), strict=True):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), piece) if words else ():
                    rows.append((item, b" ".join(words[at : at + piece + window - 1])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["item", "words"])

    return run


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int, piece: int) -> tuple[int, Iterator[Searcher]]:
    """The number of blocks, and their searchers one by one."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")).where("text is not null")
    pieces = staged(items.mapInArrow(_pieces(window, piece), "item string, words binary").distinct(), "decontamination-items")
    size = pieces.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    count = max(1, math.ceil(2 * size / block_bytes)) if size > block_bytes else 1

    def drawn():
        for k in range(count):
            part = pieces if count == 1 else pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == k)
            yield Searcher([(r["item"], bytes(r["words"])) for r in part.collect()], window)

    return count, drawn()


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, piece: int = PIECE) -> DataFrame:
    """``docs`` with ``__tm_``-prefixed result columns: n_words, n_hit, n_items, items_sha256, contaminated."""
    count, blocks = _blocks(benchmark, item, item_text, window, block_bytes, piece)
    plain = docs.withColumn("__tm_text", whole_text(text))
    if count > 1:
        return _mark_in_blocks(plain, docs, blocks)
    sent = docs.sparkSession.sparkContext.broadcast(next(blocks))
    return plain.mapInArrow(_verdicts(sent, None), _schema(docs))


def _schema(docs: DataFrame) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"__tm_{n} {t}" for n, t in _RESULT.items())])


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()


def _place(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(x[:8], "big") for x in digests], np.uint64)


def _verdicts(searcher, without):
    """Rows with their results; with ``without``, a filter of digests that have hits, only rows that it keeps out, which have none."""

    def run(batches):
        for batch in batches:
            raw = binary(batch, "__tm_text")
            if without is not None:
                keep = np.flatnonzero(~may_have(without.value, _place([_digest(x) for x in raw])))
                batch, raw = batch.take(pa.array(keep)), [raw[k] for k in keep]
            rows = []
            for words in map(words_of, raw):
                rows.append(verdict(len(words), *(searcher.value.occurrences(words) if searcher is not None else ([], set()))))
            yield _with_columns(batch, list(_RESULT), rows)

    return run


def _mark_in_blocks(plain: DataFrame, docs: DataFrame, blocks: Iterator[Searcher]) -> DataFrame:
    """One pass per block of items; only documents with hits are joined with them, by a digest of the text."""
    context, texts, parts = docs.sparkSession.sparkContext, plain.select("__tm_text"), []
    for block in blocks:
        sent = context.broadcast(block)

        def found(batches, sent=sent):
            for batch in batches:
                seen: dict[bytes, tuple] = {}
                for raw in binary(batch, "__tm_text"):
                    spans, items = sent.value.occurrences(words_of(raw))
                    if spans:
                        key = _digest(raw)
                        seen[key] = (int(_place([key]).view(np.int64)[0]), [x for s in spans for x in s], sorted(items))
                columns = list(zip(*seen.values(), strict=True)) if seen else [(), (), ()]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["key", "place", "spans", "items"])

        parts.append(staged(texts.mapInArrow(found, "key binary, place long, spans array<long>, items array<string>").dropDuplicates(["key"]), "decontamination"))
        sent.destroy()  # its pass is written
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    merged_hits = hits.groupBy("key", "place").agg(F.flatten(F.collect_list("spans")).alias("__tm_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("__tm_items"))
    merged_hits = staged(merged_hits, "decontamination-hits")
    filter_ = context.broadcast(bitmap(merged_hits, "place"))
    keep = [f.name for f in docs.schema]

    def keyed(batches):
        for batch in batches:
            digests = [_digest(x) for x in binary(batch, "__tm_text")]
            maybe = pa.array(np.flatnonzero(may_have(filter_.value, _place(digests))))
            own = batch.take(maybe)
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(digests, pa.binary()).take(maybe)], names=[*own.schema.names, "__tm_key"])

    def finish(batches):
        for batch in batches:
            spans, items = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("__tm_spans", "__tm_items"))
            rows = []
            for raw, s, i in zip(binary(batch, "__tm_text"), spans, items, strict=True):
                s = s or []
                rows.append(verdict(len(words_of(raw)), merged(zip(s[::2], s[1::2], strict=True)), set(i or ())))
            yield _with_columns(batch.select([*keep, "__tm_text"]), list(_RESULT), rows)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    some = plain.mapInArrow(keyed, f"{own}, __tm_key binary").join(merged_hits.drop("place").withColumnRenamed("key", "__tm_key"), "__tm_key", "left")
    some = some.select(*[f"`{k}`" for k in keep], "__tm_text", "__tm_spans", "__tm_items").mapInArrow(finish, _schema(docs))
    return plain.mapInArrow(_verdicts(None, filter_), _schema(docs)).unionByName(some)


def decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark(docs.select("doc_id", "text"), benchmark, **options)
    return marked.select("doc_id", *(F.col(f"__tm_{n}").alias(n) for n in _RESULT))

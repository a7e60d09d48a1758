"""Cross-tokenizer alignment by id-striped dense count matrices (operator 11).

Every text, with a space before it, is encoded by two tokenizers: A, a byte-level
BPE (``.json``), and B, a sentencepiece BPE (``.model``) that adds the space
itself.  Byte offsets where tokens of both end cut the tokens into *groups*; an A
and a B token whose byte ranges overlap are *linked*.  How well a link fits is
the number of links, over all texts, between the same two ids.

1. One pass encodes the texts.  A *unit* is a distinct text of a block of at most
   ``BLOCK`` characters; a block gives a row per document and, for each stripe of
   B ids (id modulo the number of stripes), the links of its units, packed, with
   their sums per id pair.  The rows are staged.
2. The sums of a stripe, combined within blocks already, are added by
   ``np.add.at`` into the stripe's dense matrix of ``WIDTH`` B ids by all A ids;
   where they are many, in parts and then their results, so no task reads all of
   a stripe.
3. Links are dealt by stripe, stripes of many bytes in several parts, and the
   stripe's counts go first to each part: a task rebuilds the matrix, its row
   maxima give each B id's highest count, and the links that follow are scored
   against it.  A row of links gives one row of scores, packed; those of a block,
   one a stripe at most, are added up, and joined with its documents.

A stripe's matrix has the size of the vocabularies, never of the corpus, and only
one is held at a time.  A frequent id weighs on its stripe's parts, whose number
follows their bytes.

*Words.*  Where plain white space starts after another character both
tokenizers end a token (checked against the vocabularies when they are loaded),
so a text is aligned word by word, and a worker remembers ``WORDS`` of them.
Texts in which that does not hold (other white space before plain white space),
or all texts where a vocabulary or normaliser does not allow it, are encoded
whole.  The results are those of the whole text in both ways.

Defined results: null and empty texts, and texts whose joined tokens of A or B
differ from the space and the text (B has no way to write U+2581), have no tokens:
zeros, and '' for groups and digest.  Very long texts are encoded whole; repeated
rows give repeated results and each counts; ties for the highest count all count
as best; empty tables give empty results; other columns play no role; ids may be
null or of any type.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, whole_text

WIDTH = 256  # B ids of a stripe: a matrix of 256 x 50,257 counts has 103 MB
BLOCK = 1 << 21  # characters encoded at once
WORDS, WORD_CHARS = 1 << 18, 1 << 23  # words, and characters in them, that a worker remembers
PART, FAN = 16 << 20, 16  # bytes of links, or of sums, in one part of a stripe; partial sums added at once

_SPACES = " \t\n\x0b\x0c"
#: White space by any definition of it, beside _SPACES.
_OTHER = "\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
_PROBE = "  a  b \t\n\x0b\x0c éé ﬁ Ａ ① ½ c "
_ODD = re.compile(f"[{_OTHER}][{_SPACES}]")
_WORD = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
_PLAIN = re.compile(f" ?[^{_SPACES}{_OTHER}](?:[^{_SPACES}]*[^{_SPACES}{_OTHER}])?")


class _ByteBPE:
    """A tokenizer file of byte-level BPE: ids of texts, and the bytes of each id."""

    def __init__(self, data: bytes):
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(data.decode())
        self.model.no_truncation()
        self.model.no_padding()
        self.model.encode_special_tokens = True
        vocab = self.model.get_vocab(with_added_tokens=True)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(shown)))}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.bytes[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        newline = self.encode(["\n"])[0]
        self.newline = newline[0] if len(newline) == 1 else None
        self.splits = self.newline is not None and self.model.normalizer is None and "ByteLevel" in repr(self.model.pre_tokenizer) and "Sequence" not in repr(self.model.pre_tokenizer)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each on a line of its own, in one call: all of them, and how many each word has."""
        return _cut(self.encode(["\n" + "\n".join(words)])[0], self.newline)


class _Pieces:
    """A sentencepiece file: ids of texts that start with a space, which it adds itself, and the bytes of each id."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.newline, self.space = self.model.piece_to_id("<0x0A>"), self.model.piece_to_id("▁")
        inside = f"(?s).[{_SPACES}▁]|[{_SPACES[1:]}]."
        apart = all(re.search(inside, p.lstrip("▁")) is None for p in pieces if len(p) > 1 and not p.startswith("<"))
        kept = self.model.normalize(_PROBE) == "▁" + _PROBE.replace(" ", "▁")
        self.splits = apart and kept and self.model.is_byte(self.newline) and not self.model.is_unknown(self.space)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, add_bos=False, add_eos=False, num_threads=1)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """A text without a leading space is a word inside a text: it comes after a new line, which no piece has beside others."""
        found = self._ids([t[1:] if t[:1] == " " else "\n" + t for t in texts])
        return [[self.space] if t == " " else x if t[:1] == " " else x[2:] for t, x in zip(texts, found, strict=True)]

    def lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _cut(self._ids(["\n" + "\n".join(words)])[0][1:], self.newline)


def _cut(ids: list[int], newline: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.array(ids, np.int64)
    at = np.flatnonzero(flat == newline)
    return np.delete(flat, at), np.diff(at, append=len(flat)) - 1


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


def pieces_of(path: str) -> _ByteBPE | _Pieces:
    """The tokenizer of a file, by its ending."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    with open(path, "rb") as f:
        data = f.read()
    return _Pieces(data) if path.endswith(".model") else _ByteBPE(data)


class Aligner:
    """Aligns words and remembers them; one in each worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = pieces_of(a_path), pieces_of(b_path)
        self.splits = self.a.splits and self.b.splits
        self.n_a, self.n_stripes = len(self.a.bytes), math.ceil(len(self.b.bytes) / WIDTH)
        self.lengths = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        self.written = [[np.array([f"{k}{c}" for k in range(len(side.bytes))], object) for c in marks] for side, marks in ((self.a, ",|"), (self.b, ",;"))]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars = 0
        self.counts = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, broken
        self.start, self.keys = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.splits or _ODD.search(text):
            return [" " + text]
        return _WORD.findall(" " + text)

    def learn(self, words: list[str]) -> None:
        """Align words that the table lacks, all of them in a few calls."""
        plain, rest = [], [] if self.splits else words
        if self.splits:
            for w in words:
                (plain if _PLAIN.fullmatch(w) else rest).append(w)
        words = plain + rest
        sides = []
        for side in (self.a, self.b):
            found = side.lines(plain) if plain else _flat([])
            if len(found[1]) != len(plain):
                found = _flat(side.encode(plain))
            other = _flat(side.encode(rest) if rest else [])
            sides.append(tuple(map(np.concatenate, zip(found, other, strict=True))))
        known = len(self.index)
        self.index |= {w: known + k for k, w in enumerate(words)}
        self.chars += sum(map(len, words))
        broken = self._broken([w.encode() for w in words], sides)
        sides = [(ids[~np.repeat(broken, n)], np.where(broken, 0, n)) for ids, n in sides]
        counts, groups, start, keys = self._align(*sides)
        counts[:, 4] = broken
        self.counts = np.concatenate([self.counts, counts])
        self.groups += groups
        self.start = np.concatenate([self.start, self.start[-1] + start])
        self.keys = np.concatenate([self.keys, keys])

    def _broken(self, words: list[bytes], sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which words differ from their joined tokens on either side."""
        size, broken = np.fromiter(map(len, words), np.int64, len(words)), np.zeros(len(words), bool)
        for side, length, (ids, n) in zip((self.a, self.b), self.lengths, sides, strict=True):
            joined = [side.bytes[k] for k in ids.tolist()]
            same = np.bincount(np.repeat(np.arange(len(words)), n), length[ids], len(words)) == size
            if same.all() and b"".join(joined) == b"".join(words):
                continue
            end = np.cumsum(n).tolist()
            for k, (w, e) in enumerate(zip(words, end, strict=True)):
                broken[k] |= b"".join(joined[e - n[k] : e]) != w
        return broken

    def _align(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
        """Counts, groups as text, and id pairs of links for words whose tokens cover the same bytes on both sides."""
        flat, n = [a[0], b[0]], [a[1], b[1]]
        size = len(n[0])
        ends = [np.cumsum(length[x]) for length, x in zip(self.lengths, flat, strict=True)]
        cuts, both = np.union1d(*ends), np.intersect1d(*ends, assume_unique=True)
        word = np.cumsum(np.bincount(np.repeat(np.arange(size), n[0]), self.lengths[0][flat[0]], size)).astype(np.int64)
        counts = np.zeros((size, 5), np.int64)
        counts[:, 0], counts[:, 1] = n
        counts[:, 2], counts[:, 3] = (np.bincount(np.searchsorted(word, x), minlength=size) for x in (both, cuts))
        linked = [x[np.searchsorted(e, cuts)] for x, e in zip(flat, ends, strict=True)]
        group = [np.searchsorted(both, e) for e in ends]
        place = [np.arange(len(flat[0])) + np.searchsorted(group[1], group[0]), np.arange(len(flat[1])) + np.searchsorted(group[0], group[1], "right")]
        text = np.empty(len(flat[0]) + len(flat[1]), object)
        for side in (0, 1):
            last = np.zeros(len(flat[side]), bool)
            last[np.searchsorted(ends[side], both)] = True
            text[place[side]] = np.where(last, self.written[side][1][flat[side]], self.written[side][0][flat[side]])
        text, at, groups = text.tolist(), 0, []
        for k in (n[0] + n[1]).tolist():
            groups.append("".join(text[at : at + k])[:-1])
            at += k
        return counts, groups, np.cumsum(counts[:, 3]), self.key(*linked)

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (b % self.n_stripes * WIDTH + b // self.n_stripes) * self.n_a + a

    def block(self, texts: list[str]):
        """For distinct texts: their counts, groups as lists of texts, and (key, unit, links) sorted by both."""
        words, sizes = [], []
        for t in texts:
            found = self.words(t)
            words += found
            sizes.append(len(found))
        if len(self.index) > WORDS or self.chars > WORD_CHARS:
            self.forget()
        missing = [w for w in dict.fromkeys(words) if w not in self.index]
        if missing:
            self.learn(missing)
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        unit = np.repeat(np.arange(len(texts)), sizes)
        sums = np.stack([np.bincount(unit, self.counts[ids, k], len(texts)) for k in range(5)], 1).astype(np.int64) if len(texts) else np.zeros((0, 5), np.int64)
        good = sums[:, 4] == 0
        sums[~good] = 0
        written, at = [], 0
        for size, ok in zip(sizes, good.tolist(), strict=True):
            written.append([self.groups[k] for k in ids[at : at + size].tolist()] if ok else [])
            at += size
        kept = good[unit]
        code, times = np.unique(unit[kept] * len(self.index) + ids[kept], return_counts=True)
        unit, ids = np.divmod(code, len(self.index) or 1)
        n = self.counts[ids, 3]
        of = np.repeat(np.arange(len(ids)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.start[ids][of]
        pair = self.keys[place] * max(1, len(texts)) + unit[of]
        order = np.argsort(pair)
        pair, links = pair[order], times[of][order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        key, unit = np.divmod(pair[first], max(1, len(texts)))
        return sums, written, key, unit, np.add.reduceat(links, first) if first.size else links


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str, *state) -> Aligner:
    return Aligner(a_path, b_path)


def _state(path: str) -> tuple:
    x = os.stat(path)
    return x.st_mtime_ns, x.st_size


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up in the narrowest type that holds them, named by the first byte."""
    kind = np.min_scalar_type(int(values.max()) if values.size else 0)
    return kind.char.encode() + values.astype(kind).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.dtype(chr(raw[0])), offset=1).astype(np.int64)


_LINKS = "stripe int, batch long, n_units int, size long, keys binary, totals binary, width binary, units binary, links binary"


def _encode(a_path: str, b_path: str, digest: bool):
    schema = pa.schema(
        [("unit", pa.int32()), *((x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()), ("stripe", pa.int32()), ("batch", pa.int64())]
        + [("n_units", pa.int32()), ("size", pa.int64()), *((x, pa.binary()) for x in ("keys", "totals", "width", "units", "links"))]
    )

    def rows(ids: pa.Array, columns: dict) -> pa.RecordBatch:
        rest = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(ids), f.type) for f in schema]
        return pa.RecordBatch.from_arrays([ids, *rest], names=["doc_id", *schema.names])

    def block(ids: pa.Array, texts: list[str], batch: int):
        aligner = _aligner(a_path, b_path, _state(a_path), _state(b_path))
        units: dict[str, int] = {}
        of = [units.setdefault(t, len(units)) for t in texts]
        sums, written, key, unit, links = aligner.block(list(units))
        joined = [";".join(x) for x in written]
        if digest:
            joined = [x and hashlib.sha256(x.encode()).hexdigest() for x in joined]
        values = sums[of]
        yield rows(ids, {"unit": of, "groups": [joined[k] for k in of], "batch": [batch] * len(of)} | {x: values[:, k] for k, x in enumerate(("n_a", "n_b", "n_groups", "n_links"))})
        copies = np.bincount(of, minlength=len(units))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        if not first.size:
            return
        distinct, width = key[first], np.diff(first, append=len(key))
        totals = np.add.reduceat(links * copies[unit], first)
        cells = WIDTH * aligner.n_a
        stripe = distinct // cells
        starts = np.flatnonzero(np.diff(stripe, prepend=-1))
        out: dict[str, list] = {x: [] for x in ("stripe", "size", "keys", "totals", "width", "units", "links")}
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(stripe)], strict=True):
            at = slice(first[s], first[e] if e < len(first) else len(key))
            packed = {"keys": distinct[s:e] % cells, "totals": totals[s:e], "width": width[s:e], "units": unit[at], "links": links[at]}
            packed = {k: _pack(v) for k, v in packed.items()}
            out["stripe"].append(int(stripe[s]))
            out["size"].append(sum(map(len, packed.values())))
            for k, v in packed.items():
                out[k].append(v)
        n = len(starts)
        yield rows(pa.nulls(n, ids.type), out | {"batch": [batch] * n, "n_units": [len(units)] * n})

    def run(batches):
        batch = TaskContext.get().partitionId() << 40
        for b in batches:
            texts, start = b.column(1).to_pylist(), 0
            while start < len(texts):  # bounds what is encoded at once, not a text
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= BLOCK):
                    size += len(texts[end])
                    end += 1
                yield from block(b.column(0).slice(start, end - start), texts[start:end], batch)
                batch += 1
                start = end

    return run


def _add(cells: int):
    """The sums of one part of a stripe, added up in the stripe's dense matrix."""

    def run(table: pa.Table) -> pa.Table:
        matrix = np.zeros(cells, np.int64)
        for keys, totals in zip(table.column("keys"), table.column("totals"), strict=True):
            np.add.at(matrix, _unpack(keys.as_py()), _unpack(totals.as_py()))
        keys = np.flatnonzero(matrix)
        same = [table.column(c)[:1].cast(pa.int32()) for c in ("stripe", "part")]
        return pa.table([*same, pa.array([_pack(keys)], pa.binary()), pa.array([_pack(matrix[keys])], pa.binary())], names=["stripe", "part", "keys", "totals"])

    return run


def _summed(links: DataFrame, cells: int, size: int) -> DataFrame:
    """(stripe, keys, totals): one row a stripe.  ``size`` is the bytes of the largest stripe's sums.

    Sums are added in parts of about ``PART`` bytes, and their results ``FAN`` at a
    time, which the vocabularies bound, so a task's share doesn't grow with the input.
    """
    parts = max(1, math.ceil(size / PART))
    sums = links.select("stripe", "keys", "totals", F.pmod(F.hash("batch"), F.lit(parts)).alias("part"))
    while True:
        sums = sums.groupBy("stripe", "part").applyInArrow(_add(cells), "stripe int, part int, keys binary, totals binary")
        if parts == 1:
            return sums.drop("part")
        parts = math.ceil(parts / FAN)
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))


def _score(n_a: int):
    """The scores of units within one stripe, packed, for each row of links; rows come sorted by stripe and part, a stripe's counts before its links."""

    def run(batches):
        matrix, best, stripe, filled = np.zeros(WIDTH * n_a, np.int64), None, None, np.zeros(0, np.int64)
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for row in b.to_pylist():
                keys = _unpack(row["keys"])
                if row["batch"] is None:
                    if row["stripe"] != stripe:
                        matrix[filled] = 0
                        np.add.at(matrix, keys, _unpack(row["totals"]))
                        best, stripe, filled = matrix.reshape(WIDTH, n_a).max(1), row["stripe"], keys
                    continue
                count = matrix[keys]
                top = count == best[keys // n_a]
                of = np.repeat(np.arange(len(keys)), _unpack(row["width"]))
                units, links = _unpack(row["units"]), _unpack(row["links"])
                sums = np.zeros((2, row["n_units"]), np.int64)
                np.add.at(sums[0], units, links * top[of])
                np.add.at(sums[1], units, links * count[of])
                found = np.flatnonzero(sums[1])
                for c, x in zip(out, (row["batch"], _pack(found), *(_pack(s[found]) for s in sums)), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["batch", "units", "n_best", "count_sum"])

    return run


def _units(table: pa.Table) -> pa.Table:
    """(batch, unit, n_best, count_sum): the scores of one block's units added up over the stripes."""
    rows = [[_unpack(x.as_py()) for x in table.column(c)] for c in ("units", "n_best", "count_sum")]
    sums = np.zeros((2, max(int(u.max(initial=-1)) for u in rows[0]) + 1), np.int64)
    for units, best, total in zip(*rows, strict=True):
        sums[0][units] += best
        sums[1][units] += total
    unit = np.flatnonzero(sums[1])
    batch = np.full(len(unit), table.column("batch")[0].as_py())
    return pa.table({"batch": pa.array(batch, pa.int64()), "unit": pa.array(unit, pa.int32()), "n_best": sums[0][unit], "count_sum": sums[1][unit]})


def _parts(docs: DataFrame, a_path: str, b_path: str, digest: bool) -> tuple[DataFrame, DataFrame, Aligner]:
    """The staged rows of documents and of links, and an aligner for the sizes of the vocabularies."""
    rows = docs.select("doc_id", whole_text("text").alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, unit int, n_a long, n_b long, n_groups long, n_links long, groups string, {_LINKS}"
    table = staged(rows.mapInArrow(_encode(a_path, b_path, digest), schema), "alignment")
    return table.where("stripe is null"), table.where("stripe is not null"), _aligner(a_path, b_path, _state(a_path), _state(b_path))


def alignment(docs: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    ``groups`` is written as ``a1,a2|b1;a3|b2,b3``; with ``digest`` the column is
    ``groups_sha256`` instead, and the text is never stored.  The files must be
    readable on every executor.
    """
    rows, links, aligner = _parts(docs, a_path, b_path, digest)
    sizes = staged(links.groupBy("stripe").agg(F.sum("size").alias("size"), F.sum(F.octet_length("keys") + F.octet_length("totals")).alias("sums")), "alignment-sizes")  # a row a stripe: bounded by the vocabulary
    total, largest = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("sums"), F.lit(0))).first()
    parts = sizes.select("stripe", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    counts = _summed(links, WIDTH * aligner.n_a, largest)
    counts = counts.join(F.broadcast(parts), "stripe").select("stripe", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "keys", "totals")
    dealt = links.join(F.broadcast(parts), "stripe").select("stripe", F.pmod(F.hash("batch"), "parts").alias("part"), "batch", "n_units", "keys", "width", "units", "links")
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / PART))
    both = dealt.unionByName(counts, allowMissingColumns=True).repartition(n, "stripe", "part").sortWithinPartitions("stripe", "part", F.col("batch").asc_nulls_first())
    packed = both.mapInArrow(_score(aligner.n_a), "batch long, units binary, n_best binary, count_sum binary")
    scores = packed.groupBy("batch").applyInArrow(_units, "batch long, unit int, n_best long, count_sum long")  # at most one row a stripe
    out = rows.select("batch", "unit", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups").join(scores, ["batch", "unit"], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, F.col("groups").alias("groups_sha256" if digest else "groups"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a_id, b_id, n_links, best): every id pair that is linked, how often, and whether it is the B id's most frequent."""
    _, links, aligner = _parts(docs, a_path, b_path, True)
    largest = links.groupBy("stripe").agg(F.sum(F.octet_length("keys") + F.octet_length("totals")).alias("sums")).agg(F.coalesce(F.max("sums"), F.lit(0))).first()[0]
    n_a, n_stripes = aligner.n_a, aligner.n_stripes

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys, totals = _unpack(row["keys"]), _unpack(row["totals"])
                local, a = np.divmod(keys, n_a)
                best = np.zeros(WIDTH, np.int64)
                np.maximum.at(best, local, totals)
                columns = [(a, pa.int64()), (local * n_stripes + row["stripe"], pa.int64()), (totals, pa.int64()), (totals == best[local], pa.bool_())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], names=["a_id", "b_id", "n_links", "best"])

    return _summed(links, WIDTH * n_a, largest).mapInArrow(run, "a_id long, b_id long, n_links long, best boolean")

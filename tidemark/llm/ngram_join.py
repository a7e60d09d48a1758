"""N-gram Jaccard join by a blocked sparse matrix product (operator 9).

Documents link when the Jaccard similarity of their sets of distinct word
shingles is at least ``threshold`` percent; the result is every document's
connected component.

Only rows and columns of the document by n-gram matrix that can hold a link are
multiplied:

1. *Rows.*  A text that links with another shares at least ``threshold`` percent
   of its n-grams with it.  So one of which more than the rest of its n-grams
   occur in no other text links with none; counting those among the n-grams whose
   hash is divisible by ``SAMPLE`` is enough to tell, and loses no link.  This
   leaves out nearly all texts, also those that share passages with any number of
   others but are their own else.
   *Columns.*  For the texts that are left, n-grams are put in one order, by the
   number of these texts that have them and by hash.  The first
   S - ceil(t S / 100) + 1 of a text of S n-grams are its signatures: linked texts
   share at least one (the size-derived bound on what may differ).  The rarest
   come first, so a passage of many documents is none of them unless a text
   consists of such.  This is exact; no signature is dropped.
2. *Groups.*  Documents that share signatures, directly or over others, form
   groups.  A map-side combine keeps one document a signature and chunk and links
   the rest to it, so a signature of very many documents makes no hot task.
   N-grams travel packed, 14 bytes each, in one row a chunk and bucket, and are
   met bucket by bucket: a task holds 14 bytes for each text that has an n-gram
   of one bucket of ``BUCKETS``, the largest thing that grows with one group.
3. *Product.*  A group is cut into blocks of about ``block`` texts; every pair of
   blocks is one run, and runs are dealt to tasks in equal shares.  A run
   multiplies the blocks' incidence matrices, a block of columns at a time,
   accumulating overlap counts.  Pairs whose sizes differ too much are discarded
   before, and after every block of columns those that can't reach the overlap
   that their sizes demand, even if all n-grams left agreed; rows without a pair
   left are multiplied no more.  A run returns a spanning forest of the links and
   each text's number of links, never all pairs.
   Groups of one block (nearly all) are one run.

Equal texts are one row of the matrix: copies are found by a digest and carry
the links of their text.  N-grams are compared by 64-bit hash, texts by the
first 128 bits of their SHA-256.

Defined results: null, empty and blank texts have no shingles and link with
nothing, not even their copies; the component is the smallest doc_id reachable,
nulls aside, and null where a document that links with nothing has no id; ids
may have any type that has an order; very long texts are read whole; rows that
repeat an id and text are copies; an empty table gives an empty result; other
columns play no role.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FILTER_BITS, binary, bitmap, may_have, staged, whole_text
from tidemark.llm.components import components
from tidemark.llm.words import chunks, mix, shingle_sets
from tidemark.operators.membership import may_belong, membership

WIDTH, PERCENT = 3, 90
BLOCK, COLUMNS = 128, 4096
BUCKETS, GRAMS, SAMPLE = 4096, 1 << 18, 2


class Forest:
    """Union of integers towards the smallest."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while up.get(top, top) != top:
            top = up[top]
        while up.get(x, x) != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.up]


def _meet(codes: np.ndarray, nodes: np.ndarray, forest: Forest) -> np.ndarray:
    """Joins the nodes that share a code; indices of one row for each code."""
    order = np.argsort(codes, kind="stable")
    codes, nodes = codes[order], nodes[order]
    fresh = np.concatenate([[True], codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, bool)
    lead = nodes[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(codes) else nodes
    pairs = np.unique(np.stack([lead, nodes])[:, ~fresh], axis=1)
    for a, b in pairs.T.tolist():
        forest.join(a, b)
    return order[fresh]


_ROW = "a long, b long, key binary, id {}"


def _rows(a, b, key, ids: pa.Array) -> pa.RecordBatch:
    """``a``, ``b`` and ``key`` may be null; ``ids`` is a column, or its type for nulls."""
    if isinstance(ids, pa.DataType):
        ids = pa.nulls(len(a), ids)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(key, pa.binary()), ids], names=["a", "b", "key", "id"])


def digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def node_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def _packed(codes: np.ndarray, nodes: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Buckets by the highest bits of the codes, and for each 6 bytes of the code and 8 of the node for every signature."""
    place = (codes.view(np.uint64) >> np.uint64(48)).astype(np.int64) % BUCKETS
    order = np.argsort(place, kind="stable")
    place = place[order]
    raw = np.empty((len(order), 14), np.uint8)
    raw[:, :6] = codes[order].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
    raw[:, 6:] = nodes[order].astype("<i8").view(np.uint8).reshape(-1, 8)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
    ends = [*starts[1:].tolist(), len(place)]
    return place[starts].tolist(), [raw[x:y].tobytes() for x, y in zip(starts.tolist(), ends, strict=len(place) > 0)]


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 14)
    codes = np.zeros((len(raw), 8), np.uint8)
    codes[:, :6] = raw[:, :6]
    return codes.view("<i8").ravel(), np.ascontiguousarray(raw[:, 6:]).view("<i8").ravel()


def _distinct(text: pa.Array, width: int, sought: bytes | None) -> tuple[list[bytes], list[bytes], list[np.ndarray]]:
    """Digests of all texts, the distinct ones that may be in the filter, and their sets."""
    raw = [x or b"" for x in text.cast(pa.binary()).to_pylist()]
    keys = [digest(x) for x in raw]
    first = {k: n for n, k in reversed(list(enumerate(keys)))}
    own = list(first)
    if sought is not None and own:
        keep = may_have(sought, np.array([node_of(k) for k in own], np.int64))
        own = [k for k, x in zip(own, keep, strict=True) if x]
    return keys, own, shingle_sets(text.take(pa.array([first[k] for k in own], pa.int64())), width)


def _file(width: int):
    """Rows (null, node, digest + size, id) of documents, and (bucket, null, packed n-grams, null) of a part of the n-grams of their texts.

    An n-gram that several texts of a chunk have is one row, of node 0.
    """

    def run(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for start, end in chunks(text):
                keys, own, sets = _distinct(text.slice(start, end - start), width, None)
                size = {k: len(s).to_bytes(4, "big") for k, s in zip(own, sets, strict=True)}
                yield _rows([None] * (end - start), [node_of(k) for k in keys], [k + size[k] for k in keys], ids.slice(start, end - start))
                parts = [s[s % np.uint64(SAMPLE) == 0] for s in sets]
                grams = mix(np.concatenate([np.zeros(0, np.uint64), *parts]))
                nodes = np.repeat(np.array([node_of(k) for k in own], np.int64), [len(x) for x in parts])
                order = np.argsort(grams, kind="stable")
                grams, nodes = grams[order], nodes[order]
                fresh = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else order
                alone = np.diff(np.concatenate([fresh, [len(grams)]])) == 1
                places, blobs = _packed(grams[fresh].view(np.int64), np.where(alone, nodes[fresh], 0))
                yield _rows(places, [None] * len(places), blobs, ids.type)

    return run


def _unshared(codes: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes, and how many n-grams of each no other node has."""
    order = np.argsort(codes, kind="stable")
    codes, nodes = codes[order], nodes[order]
    fresh = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    low, high = np.minimum.reduceat(nodes, fresh), np.maximum.reduceat(nodes, fresh)
    return np.unique(low[(low == high) & (low != 0)], return_counts=True)


def _grams(width: int, sought):
    """Rows (bucket, null, packed n-grams) of the texts in the filter ``sought``, and (node, size, empty) of these texts."""

    def run(batches):
        for batch in batches:
            for start, end in chunks(batch.column(0)):
                _, own, sets = _distinct(batch.column(0).slice(start, end - start), width, sought.value)
                nodes = np.array([node_of(k) for k in own], np.int64)
                sizes = np.array([len(x) for x in sets], np.int64)
                kind = pa.int64()
                yield _rows(nodes, sizes, [b""] * len(nodes), kind)
                places, blobs = _packed(mix(np.concatenate([np.zeros(0, np.uint64), *sets])).view(np.int64), np.repeat(nodes, sizes))
                yield _rows(places, [None] * len(places), blobs, kind)

    return run


_SEEN = np.dtype([("gram", "<i8"), ("often", "u1")])


def _shared(place: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes, and their n-grams of one bucket that other nodes have too, with the number of nodes (255 at most)."""
    codes, nodes = _unpacked(blobs)
    order = np.lexsort((nodes, codes))
    codes, nodes = codes[order], nodes[order]
    keep = np.concatenate([[True], (codes[1:] != codes[:-1]) | (nodes[1:] != nodes[:-1])])
    codes, nodes = codes[keep], nodes[keep]
    fresh = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    times = np.diff(np.concatenate([fresh, [len(codes)]]))
    often = np.repeat(times, times)
    out = np.empty(int((often > 1).sum()), _SEEN)
    out["gram"], out["often"] = codes[often > 1] | (place << 48), np.minimum(often[often > 1], 255)
    return nodes[often > 1], out


def _by_node(found: list[tuple[np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    nodes, seen = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    order = np.argsort(nodes, kind="stable")
    nodes, seen = nodes[order], seen[order]
    starts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else order
    ends = [*starts[1:].tolist(), len(nodes)]
    return _rows(nodes[starts], [None] * len(starts), [seen[x:y].tobytes() for x, y in zip(starts.tolist(), ends, strict=len(nodes) > 0)], kind)


def prefix(size: int, seen: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a text of ``size`` n-grams, of which ``seen`` occur in other texts too; the others are the first in order, and meet none."""
    length = size - -(-percent * size // 100) + 1 - (size - len(seen))
    return seen["gram"][np.lexsort((seen["gram"], seen["often"]))[: max(0, length)]]


def _signed(percent: int):
    """Signatures (bucket, null, packed) and links (node, node, empty) from all rows of each node: (node, size, empty), (node, null, n-grams)."""

    def run(batches):
        node, size, blobs, found, total, kind = None, 0, [], [], 0, None

        def finish():
            own = prefix(size, np.frombuffer(b"".join(blobs), _SEEN), percent)
            if len(own):
                found.append((own, np.full(len(own), node, np.int64)))
            return len(own)

        def given():
            codes, nodes = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            forest = Forest()
            lead = _meet(codes, nodes, forest)
            links = forest.edges()
            places, packed = _packed(codes[lead], nodes[lead])
            return _rows([*places, *(x for x, _ in links)], [*[None] * len(places), *(y for _, y in links)], [*packed, *[b""] * len(links)], kind)

        for batch in batches:
            kind = batch.column(3).type
            for a, b, key in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if a != node:
                    total += finish() if node is not None else 0
                    if total >= GRAMS:
                        yield given()
                        found, total = [], 0
                    node, size, blobs = a, 0, []
                if b is not None:
                    size = b
                else:
                    blobs.append(key)
        if node is not None:
            finish()
        if found:
            yield given()

    return run


def _linked(place: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The links of nodes that share a code of a bucket, as a forest."""
    forest = Forest()
    _meet(*_unpacked(blobs), forest)
    links = np.array(forest.edges(), np.int64).reshape(-1, 2)
    return links[:, 0], links[:, 1]


def _counted(place: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _unshared(*_unpacked(blobs))


def _pairs(found: list[tuple[np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    a, b = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    return _rows(a, b, [b""] * len(a), kind)


def _summed(nodes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, at = np.unique(nodes, return_inverse=True)
    return nodes, np.bincount(at, numbers, len(nodes)).astype(np.int64)


def _sums(found: list[tuple[np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    """Numbers by node, packed in buckets of nodes."""
    nodes, numbers = _summed(*(np.concatenate([x[k] for x in found]) for k in (0, 1)))
    places, blobs = _packed(nodes & ~((1 << 48) - 1) | numbers, nodes)
    return _rows(places, [None] * len(places), blobs, kind)


def _totals(place: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    numbers, nodes = _unpacked(blobs)
    return _summed(nodes, numbers)


def _by_bucket(take, give, most: int = GRAMS):
    """``take`` (bucket, blobs) of every bucket, whose rows come together; ``give`` makes rows of what several gave, about ``most`` at once; other rows pass."""

    def run(batches):
        current, blobs, kind, taken, size = None, [], None, [], 0
        for batch in batches:
            kind = batch.column(3).type
            plain = batch.column(1).is_valid()
            yield batch.filter(plain)
            own = batch.filter(pa.array(~plain.to_numpy(zero_copy_only=False)))
            for place, blob in zip(own.column(0).to_pylist(), own.column(2).to_pylist(), strict=True):
                if place != current:
                    if blobs:
                        taken.append(take(current, blobs))
                        size += len(taken[-1][0])
                    if size >= most:
                        yield give(taken, kind)
                        taken, size = [], 0
                    current, blobs = place, []
                blobs.append(blob)
        if blobs:
            taken.append(take(current, blobs))
        if taken:
            yield give(taken, kind)

    return run


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """The rows of a bucket together, others spread."""
    packed = F.col("b").isNull()
    return rows.repartition(parts, F.when(packed, F.xxhash64("a")).otherwise(F.xxhash64("a", "b", "id"))).sortWithinPartitions(F.when(packed, F.col("a")))


def _texts_of(sought):
    def run(batches):
        words = np.frombuffer(sought.value, np.uint32)
        mask = (1 << FILTER_BITS) - 1
        for batch in batches:
            seen: dict[bytes, bytes] = {}
            for raw in binary(batch, "text"):
                key = digest(raw)
                bit = node_of(key) & mask
                if words[bit >> 5] >> np.uint32(bit & 31) & np.uint32(1):
                    seen[key] = raw
            yield pa.RecordBatch.from_arrays([pa.array([node_of(k) for k in seen], pa.int64()), pa.array(list(seen), pa.binary()), pa.array([x.decode() for x in seen.values()], pa.string())], names=["node", "key", "text"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray], need: np.ndarray | None = None) -> np.ndarray:
    """Sizes of all intersections: the product of one incidence matrix and the other's transpose, a block of columns at a time.

    Where ``need`` is given, pairs that can't reach it are discarded on the way and get 0.
    """
    sets, split = [*left, *right], len(left)
    column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = np.flatnonzero(count > 1)
    number = np.full(len(count), -1, np.int64)
    number[shared] = np.arange(len(shared))
    column, row = number[column], np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    rest = np.bincount(row, minlength=len(sets))  # n-grams of each row in the columns that are left
    out = np.zeros((split, len(right)), np.int64)
    alive = np.ones(out.shape, bool) if need is None else np.minimum(rest[:split, None], rest[None, split:]) >= need
    for start in range(0, len(shared), COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            break
        place = np.full(len(sets), -1, np.int64)
        place[rows], place[split + columns] = np.arange(len(rows)), len(rows) + np.arange(len(columns))
        used = place[row[lo:hi]] >= 0
        block = np.zeros((len(rows) + len(columns), min(COLUMNS, len(shared) - start)), np.float32)
        block[place[row[lo:hi][used]], column[lo:hi][used] - start] = 1
        out[np.ix_(rows, columns)] += (block[: len(rows)] @ block[len(rows) :].T).astype(np.int64)
        rest -= np.bincount(row[lo:hi], minlength=len(sets))
        if need is not None:
            alive &= out + np.minimum(rest[:split, None], rest[None, split:]) >= need
    return np.where(alive, out, 0)


def links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    a, b = (np.array([len(s) for s in x], np.int64) for x in (left, right))
    need = np.maximum(1, -(-percent * (a[:, None] + b[None, :]) // (100 + percent)))  # the least overlap that links
    return overlaps(left, right, need) >= need


def joined_by(link: np.ndarray) -> list[list[int]]:
    """Index lists of more than one row that the symmetric ``link`` joins."""
    left, out = np.ones(len(link), bool), []
    for k in range(len(link)):
        if left[k]:
            member = np.zeros(len(link), bool)
            front = np.zeros(len(link), bool)
            front[k] = True
            while front.any():
                member |= front
                front = link[front].any(axis=0) & ~member
            left &= ~member
            if member.sum() > 1:
                out.append(np.flatnonzero(member).tolist())
    return out


_LINK = "u binary, v binary, n long"


def _multiply(width: int, percent: int):
    """Rows (g, i, j, own, key, copies, text) come sorted by (g, i, j), all of a run together.

    Yields a forest of the links of each run as (u, v, null), and for every
    text with links (u, null, number of documents it links with).
    """

    def finish(place, rows):
        if len(rows) < 2:
            return []
        _, i, j = place
        sides = [[r for r in rows if r[0] == i], [r for r in rows if r[0] == j]] if i != j else [rows, rows]
        if not sides[0] or not sides[1]:
            return []
        sets = []
        for side in sides if i != j else sides[:1]:
            text = pa.array([r[3] for r in side], pa.string())
            sets.append([s for a, b in chunks(text) for s in shingle_sets(text.slice(a, b - a), width)])
        link = links_between(sets[0], sets[-1], percent)
        if i == j:
            np.fill_diagonal(link, False)
            both = link
        else:
            a, b = link.shape
            both = np.zeros((a + b, a + b), bool)
            both[:a, a:], both[a:, :a] = link, link.T
            rows = sides[0] + sides[1]
        out = []
        for members in joined_by(both):
            keys = sorted(rows[m][1] for m in members)
            out += [(k, keys[0], None) for k in keys[1:]]
        number = both @ np.array([r[2] for r in rows], np.int64)
        return out + [(rows[k][1], None, int(number[k])) for k in np.flatnonzero(number)]

    def batch_of(found):
        columns = list(zip(*found, strict=True)) if found else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], names=["u", "v", "n"])

    def run(batches):
        current, rows = None, []
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for g, i, j, *row in zip(*columns, strict=True):
                if (g, i, j) != current:
                    found += finish(current, rows)
                    current, rows = (g, i, j), []
                rows.append(row)
            yield batch_of(found)
        yield batch_of(finish(current, rows))

    return run


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, key (digest of the text), n_shingles, component_id, n_links (other documents that it links with)."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    schema = _ROW.format(dict(rows.dtypes)["doc_id"])

    filed = _dealt(rows.mapInArrow(_file(width), schema), parts)
    counted = _dealt(filed.mapInArrow(_by_bucket(_counted, _sums, 4 * GRAMS), schema), parts)
    read = staged(counted.mapInArrow(_by_bucket(_totals, _pairs), schema), "ngram-filed")
    found = read.where("octet_length(key) > 0").select(F.col("id").alias("doc_id"), F.col("b").alias("node"), F.expr("substring(key, 1, 16)").alias("key"), F.expr("cast(conv(hex(substring(key, 17, 4)), 16, 10) as long)").alias("n_shingles"))
    alone = read.where("octet_length(key) = 0").select(F.col("a").alias("node"), F.col("b").alias("alone"))
    rest = found.where("n_shingles > 0").select("node", "n_shingles").distinct().join(alone, "node", "left").where(100 * F.coalesce("alone", F.lit(0)) <= (100 - percent) * F.col("n_shingles"))
    able = spark.sparkContext.broadcast(bitmap(staged(rest.select("node"), "ngram-able"), "node"))  # of fixed size
    plain = _ROW.format("long")
    often = _dealt(rows.select("text").mapInArrow(_grams(width, able), plain), parts).mapInArrow(_by_bucket(_shared, _by_node, 4 * GRAMS), plain)
    signed = often.repartition(parts, F.xxhash64("a")).sortWithinPartitions("a").mapInArrow(_signed(percent), plain)
    met = staged(_dealt(signed, parts).mapInArrow(_by_bucket(_linked, _pairs), plain), "ngram-met")
    groups = components(met.select(F.col("a").alias("u"), F.col("b").alias("v")), "ngram-groups")

    classes = staged(found.where("n_shingles > 0").groupBy("key", "node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "ngram-classes")

    sought = spark.sparkContext.broadcast(bitmap(groups, "node"))  # of fixed size
    texts = rows.select("text").mapInArrow(_texts_of(sought), "node long, key binary, text string")
    placed = classes.join(groups, "node").select("node", "key", "copies", F.col("component").alias("g"))
    counted = placed.join(staged(placed.groupBy("g").agg(F.ceil(F.count("*") / block).alias("blocks")), "ngram-sizes"), "g")
    members = texts.join(staged(counted, "ngram-members"), ["node", "key"]).groupBy("node", "key", "g", "blocks", "copies").agg(F.first("text").alias("text"))
    own = members.withColumn("own", F.pmod(F.xxhash64("key"), "blocks"))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "copies", "text")
    runs = paired.repartitionByRange(parts, "g", "i", "j").sortWithinPartitions("g", "i", "j")
    links = staged(runs.mapInArrow(_multiply(width, percent), _LINK), "ngram-links")
    joined = components(links.where("v is not null").select("u", "v"), "ngram-components").withColumnRenamed("node", "key")
    numbers = links.where("v is null").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("other_links"))

    reached = classes.join(joined, "key", "left").join(numbers, "key", "left").where("copies > 1 or component is not null")
    reached = staged(reached.select("key", F.coalesce("component", "key").alias("component"), "least", (F.coalesce("other_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "ngram-reached")
    smallest = staged(reached.groupBy("component").agg(F.min("least").alias("component_id")), "ngram-smallest")
    shared = staged(reached.join(smallest, "component").select("key", "component_id", "n_links"), "ngram-shared")
    return found.join(shared, "key", "left").select("doc_id", "key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def ngram_join(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links."""
    return linked(docs, **options).select("doc_id", "n_shingles", "component_id", "n_links")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of every component, that of the smallest id; repeated rows are one.

    A document is its id and text: of an id with several texts, those that are not
    the smallest of their component go.  A component whose documents all have no
    id keeps one row of each text.  Only rows that go, or whose id and text repeat,
    are dealt out (and the few others that a filter of their keys lets pass).
    """
    found = staged(linked(docs, **options), "ngram-found")
    pairs = found.where("doc_id is not null").groupBy("doc_id", F.col("key").alias("__tm_key")).agg(F.count("*").alias("n"), F.min((F.col("doc_id") != F.col("component_id")).cast("int")).alias("goes"))
    touched = staged(pairs.where("goes = 1 or n > 1").select("doc_id", "__tm_key", "goes"), "ngram-touched")
    keyed = docs.withColumn("__tm_key", F.expr("substring(unhex(sha2(coalesce(text, ''), 256)), 1, 16)"))
    named = keyed.where("doc_id is not null")
    sought = membership(touched, "doc_id", "__tm_key")
    marked = named.withColumn("__tm_maybe", F.lit(True) if sought is None else may_belong(named, sought, "doc_id", "__tm_key"))
    others = marked.where("__tm_maybe").join(touched.where("goes = 1").select("doc_id", "__tm_key"), ["doc_id", "__tm_key"], "left_anti").dropDuplicates(["doc_id", "text"])
    names = [f"`{c}`" for c in docs.columns]
    kept = marked.where("not __tm_maybe").select(names).unionByName(others.select(names))
    lone = found.where("doc_id is null and component_id is null").select(F.col("key").alias("__tm_key")).distinct()
    nameless = keyed.where("doc_id is null").join(lone, "__tm_key", "left_semi").dropDuplicates(["text"])
    return kept.unionByName(nameless.select(names))

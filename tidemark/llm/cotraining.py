"""Quality classifier by co-training (operator 7).

A document is good when its label says quality 1 and toxic 0.  It has two views:
*content* (the distinct words of its text, stripped and in lower case, their
attached symbols, and coarse shares of symbols, capitals and repeated words) and
*metadata* (source, language, length and line count, and their pairs), both as
hashed binary features.  Each view has a logistic regression over the features
that differ significantly between good and bad training documents.

*Labelled sample.*  Training starts from at most ``LABELLED`` labelled documents
whose features take at most ``SAMPLE_BYTES``, taken in the order of a hash of
the id.  Their contents are split by hash: three fifths train, a fifth
calibrates the views (Platt scaling), a fifth fits the combination of the views,
so that no row serves two of these ends.  A content is known by the digest of its
content view alone: copies are on the same side, whatever their metadata.

*Rounds.*  In each of ``ROUNDS`` rounds both classifiers score all documents.
Each ranks the distinct contents of the pool by its own score and hands the
``pseudo`` highest and the ``pseudo`` lowest to the other as training data, with
its calibrated probability as the target: a view is never silent, and where it
isn't sure it says so.  The pool has no content of a labelled document (of any,
not only of the sample) and none that was handed on to that view before.  A
content's metadata are those of its document of the least id.  Both classifiers
are then fitted anew.

*Ranking* takes a histogram of the scores in steps of 1/64: all contents above
the step that completes ``pseudo`` are taken, and of the step itself those whose
hash falls below the share that is needed.  So ties are broken by hash, nothing
is sorted, and what reaches the driver is bounded whatever the corpus.

Finally the calibrated log-odds of both views are combined by a logistic
regression without negative weights (a view that would be subtracted is left
out) and score all documents.  ``kept`` is false where the probability of
being good is below ``CUT``.

Feature rows are written once to the shared folder and reread in each round; no
text and no feature is shuffled, only a digest and two scores per distinct
content and task.  Models are arrays of fixed size.

Defined results: a null or empty text has no words, a very long one no more
features than there are hash values; null metadata are values of their own; a
doc_id labelled several times counts as the worst of its labels, one with
several texts trains by the text of the least digest; labels with a null quality
are not used, a null toxic is 0; without labels of both kinds in each part of
the split all scores are 0.5 and all documents are kept; an empty table gives an
empty result; repeated rows give repeated results; other columns play no role.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, whole_text
from tidemark.llm.words import chunks, split_words

LABELLED, SAMPLE_BYTES, ROUNDS, CUT = 20_000, 64 << 20, 2, 0.5
#: Contents that a view hands on, per round and class, as a share of the training rows.
PSEUDO_SHARE = 0.03
STEPS = 64  # of the ranking, per unit of log-odds
CONTENT_BITS, META_BITS = 18, 14
MIN_Z, MIN_DOCS = 4.0, 3
_STRIP = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
_CAPITAL = bytes(c for c in range(256) if not 0x41 <= c <= 0x5A)
_SYMBOL = bytes(c for c in range(256) if c not in b"#*$%&|<>")


def _feature(name: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(name) & ((1 << bits) - 1)


def content_features(text: pa.Array) -> list[np.ndarray]:
    """Ascending feature ids of every text."""
    offsets, index, words = split_words(text)
    core, sign = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    signs: dict[bytes, int] = {}
    for k, w in enumerate(words):
        stem = w.strip(_STRIP)
        core[k] = _feature(stem, CONTENT_BITS)
        if len(stem) != len(w):
            mark = w.replace(stem, b"", 1) if stem else w
            if mark not in signs:
                signs[mark] = _feature(b"\0sign" + mark, CONTENT_BITS)
            sign[k] = signs[mark]
    out = []
    for k, raw in enumerate(x or b"" for x in text.cast(pa.binary()).to_pylist()):
        own = index[offsets[k] : offsets[k + 1]]
        marks = sign[own]
        n = max(1, len(raw))
        distinct = np.unique(own)
        shape = [
            b"\0symbols%d" % (40 * len(raw.translate(None, _SYMBOL)) // n),
            b"\0capitals%d" % (20 * len(raw.translate(None, _CAPITAL)) // n),
            b"\0distinct%d" % (10 * len(distinct) // max(1, len(own))),
            b"\0words%d" % len(own).bit_length(),
        ]
        out.append(np.unique(np.concatenate([core[distinct], np.unique(marks[marks >= 0]), [_feature(x, CONTENT_BITS) for x in shape]])).astype(np.uint32))
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int, n_lines: int) -> np.ndarray:
    values = [f"source={source}", f"lang={lang}", f"chars={int(n_chars).bit_length()}", f"lines={int(n_lines).bit_length()}"]
    values += [f"{a}&{b}" for k, a in enumerate(values) for b in values[k + 1 :]]
    return np.unique([_feature(v.encode(), META_BITS) for v in values]).astype(np.uint32)


_ROW = "doc_id {}, key binary, content binary, meta binary"


def _featurise(batches):
    for batch in batches:
        for start, end in chunks(batch.column(1)):
            part = batch.slice(start, end - start)
            content = content_features(part.column(1))
            texts = part.column(1).to_pylist()
            meta = [meta_features(s, g, len(t), t.count("\n") + 1) for s, g, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), texts, strict=True)]
            rows = [(a.tobytes(), b.tobytes()) for a, b in zip(content, meta, strict=True)]
            keys = [hashlib.blake2b(a, digest_size=16).digest() for a, _ in rows]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), *(pa.array([r[v] for r in rows], pa.binary()) for v in (0, 1))], names=["doc_id", "key", "content", "meta"])


class Bags:
    """Sparse binary rows, as one array of ids and the offsets of the rows."""

    def __init__(self, raw: list[bytes]):
        sizes = np.array([len(x) // 4 for x in raw], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = np.frombuffer(b"".join(raw), np.uint32).astype(np.int64)
        self.row = np.repeat(np.arange(len(raw)), sizes)
        self.n = len(raw)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.ids], self.n) if self.n else np.zeros(0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Logistic:
    """Logistic regression over significant binary features; ``weights`` has a place for every id."""

    def __init__(self, bits: int):
        self.weights, self.bias = np.zeros(1 << bits), 0.0
        self.slope, self.shift = 1.0, 0.0

    def fit(self, bags: Bags, good: np.ndarray, steps: int = 400, rate: float = 0.3, decay: float = 1e-4) -> Logistic:
        """``good`` is each row's target, from 0 to 1; both classes weigh the same."""
        size = len(self.weights)
        ones, zeros = max(1, good.sum()), max(1, (1 - good).sum())
        n1 = np.bincount(bags.ids, good[bags.row], size)
        n0 = np.bincount(bags.ids, (1 - good)[bags.row], size)
        share = (n1 + n0) / (ones + zeros)
        spread = np.sqrt(np.maximum(share * (1 - share) * (1 / ones + 1 / zeros), 1e-12))
        chosen = np.flatnonzero((np.abs(n1 / ones - n0 / zeros) / spread >= MIN_Z) & (n1 + n0 >= MIN_DOCS))
        place = np.full(size, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        used = place[bags.ids] >= 0
        col, row = place[bags.ids][used], bags.row[used]
        w, b = np.zeros(len(chosen)), 0.0
        grad2, bias2 = np.full(len(chosen), 1e-8), 1e-8
        for _ in range(steps):
            p = sigmoid(np.bincount(row, w[col], bags.n) + b)
            error = (1 - good) * p * (0.5 / zeros) - good * (1 - p) * (0.5 / ones)
            grad = np.bincount(col, error[row], len(chosen)) + decay * w
            grad2 += grad * grad
            bias2 += error.sum() ** 2
            w -= rate * grad / np.sqrt(grad2)
            b -= rate * error.sum() / np.sqrt(bias2)
        self.weights[:] = 0
        self.weights[chosen], self.bias = w, b
        return self

    def raw(self, bags: Bags) -> np.ndarray:
        return bags.dot(self.weights) + self.bias

    def calibrate(self, bags: Bags, good: np.ndarray) -> Logistic:
        self.slope, self.shift = platt(self.raw(bags)[:, None], good)
        self.slope = float(self.slope[0])
        return self

    def logit(self, bags: Bags) -> np.ndarray:
        return np.clip(self.slope * self.raw(bags) + self.shift, -12, 12)


def platt(x: np.ndarray, good: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float]:
    """Newton steps for a logistic regression on few inputs, with Platt's smoothed targets."""
    ones, zeros = good.sum(), (~good).sum()
    target = np.where(good, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ w)
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(len(w))
        change = np.linalg.solve(hess, a.T @ (p - target) + 1e-3 * w)
        w -= np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def stack(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """``platt`` with weights of at least 0: inputs of negative weight are left out, and the others fitted again."""
    used = np.arange(x.shape[1])
    while True:
        w, shift = platt(x[:, used], good)
        if not len(used) or (w >= 0).all():
            break
        used = used[w >= 0]
    out = np.zeros(x.shape[1])
    out[used] = w
    return out, shift


def _scored(models):
    """(doc_id, key, steps of each view's log-odds) for the distinct contents of a batch, each by its document of the least id."""

    def run(batches):
        for batch in batches:
            ids, keys, metas = (batch.column(k).to_pylist() for k in (0, 1, 3))
            order = sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] if ids[n] is not None else 0, metas[n]), reverse=True)
            own = batch.take(pa.array(list({keys[n]: n for n in order}.values()), pa.int64()))
            steps = [np.floor(STEPS * m.logit(Bags(own.column(v + 2).to_pylist()))).astype(np.int32) for v, m in enumerate(models.value)]
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), *map(pa.array, steps), own.column(3)], names=["doc_id", "key", "view0", "view1", "meta"])

    return run


def _first() -> Column:
    """By it, the least row stands for a content: that of the least id, null last, ties by the metadata."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "meta")


def _final(models):
    def run(batches):
        content, meta, weights, shift = models.value
        for batch in batches:
            a, b = content.logit(Bags(batch.column(1).to_pylist())), meta.logit(Bags(batch.column(2).to_pylist()))
            score = sigmoid(weights[0] * a + weights[1] * b + shift)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(a)), pa.array(sigmoid(b)), pa.array(score)], names=["doc_id", "content_score", "meta_score", "score"])

    return run


class CoTraining:
    """The fitted views, their combination (None where labels are too few), and what was handed on: (round, from view, good, key, doc_id)."""

    def __init__(self, featured: DataFrame, labels: DataFrame, labelled: int, sample_bytes: int, rounds: int, pseudo: int | None):
        self.spark, self.featured, self.offers, self.combination = featured.sparkSession, featured, [], None
        truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.when((F.col("quality") >= 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good"))
        known = self._sample(truth, labelled, sample_bytes)
        good = np.array([r["good"] == 1 for r in known], bool)
        part = np.array([xxhash.xxh64_intdigest(bytes(r["key"])) % 5 for r in known], np.int64)
        sides = [np.flatnonzero(x) for x in (part > 1, part == 0, part == 1)]  # train, calibrate, combine
        self.sides = [[known[k]["doc_id"] for k in side] for side in sides]
        if not all(good[side].any() and not good[side].all() for side in sides):
            return
        views = [[bytes(r[v]) for r in known] for v in ("content", "meta")]
        bags = lambda view, side: Bags([views[view][k] for k in side])
        self.sets = [([views[v][k] for k in sides[0]], good[sides[0]].astype(float)) for v in (0, 1)]  # each view's own training data
        self._calibration = [bags(v, sides[1]) for v in (0, 1)], good[sides[1]]
        pseudo = pseudo or max(1, round(PSEUDO_SHARE * len(sides[0])))
        self.models = self._fitted()
        pool = self._pool(truth) if rounds else None
        for n in range(rounds):
            self._exchange(pool, pseudo, n)
            self.models = self._fitted()
        self.combination = stack(np.stack([m.logit(bags(v, sides[2])) for v, m in enumerate(self.models)], axis=1), good[sides[2]])

    def _sample(self, truth: DataFrame, labelled: int, sample_bytes: int) -> list:
        """Labelled rows, one for each id, of bounded number and size; by hash of the id."""
        chosen = truth.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
        one = self.featured.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min(F.struct("key", (F.octet_length("content") + F.octet_length("meta")).alias("size"))).alias("x"))
        one = staged(one.select("doc_id", "good", "x.key", "x.size", F.xxhash64("doc_id").alias("place")), "cotraining-sample")
        room, last = sample_bytes, None
        for r in one.select("place", "doc_id", "size").orderBy("place", "doc_id").collect():
            room -= r["size"]
            if room < 0:
                break
            last = r["place"]
        if last is None:
            return []
        kept = one.where(F.col("place") <= last)
        found = self.featured.join(F.broadcast(kept.select("doc_id", "key", "good")), ["doc_id", "key"]).groupBy("doc_id", "key", "good").agg(F.min(F.struct("meta", "content")).alias("x"))
        return found.select("doc_id", "key", "good", "x.content", "x.meta").orderBy("doc_id").collect()

    def _fitted(self) -> list[Logistic]:
        held, good = self._calibration
        models = [Logistic(bits).fit(Bags(raw), y) for (raw, y), bits in zip(self.sets, (CONTENT_BITS, META_BITS), strict=True)]
        return [m.calibrate(h, good) for m, h in zip(models, held, strict=True)]

    def _pool(self, truth: DataFrame) -> DataFrame:
        """(key, doc_id) of the contents of which no document is labelled; the least id of each."""
        marked = self.featured.select("doc_id", "key").join(truth.select("doc_id", F.lit(1).alias("labelled")), "doc_id", "left")
        return staged(marked.groupBy("key").agg(F.max("labelled").alias("labelled"), F.min("doc_id").alias("doc_id")).where("labelled is null").drop("labelled"), "cotraining-pool")

    def _exchange(self, pool: DataFrame, pseudo: int, number: int) -> None:
        sent = self.spark.sparkContext.broadcast(tuple(self.models))
        kind = dict(self.featured.dtypes)["doc_id"]
        steps = self.featured.select("doc_id", "key", "content", "meta").mapInArrow(_scored(sent), f"doc_id {kind}, key binary, view0 int, view1 int, meta binary")
        first = steps.groupBy("key").agg(F.min_by(F.struct("view0", "view1"), _first()).alias("x")).select("key", "x.view0", "x.view1")
        scored = staged(first.join(pool, "key"), "cotraining-scores")
        chosen = []
        for view in (0, 1):
            taught = self.spark.createDataFrame([(x[3],) for x in self.offers if x[1] == view], "key binary")  # bounded: all that was handed on
            left = scored.select("key", "doc_id", F.col(f"view{view}").alias("step")).join(F.broadcast(taught), "key", "left_anti")
            counts = sorted((r["step"], r["count"]) for r in left.groupBy("step").count().collect())
            for good in (True, False):
                chosen.append(left.where(_ranked(counts[::-1] if good else counts, pseudo, good, number)).select("key", "doc_id", F.lit(view).alias("view"), F.lit(good).alias("good")))
        union = chosen[0].unionByName(chosen[1]).unionByName(chosen[2]).unionByName(chosen[3])
        handed = sorted(((r["view"], r["good"], bytes(r["key"]), r["doc_id"]) for r in union.collect()), key=lambda x: x[:3])
        handed = list({(x[0], x[2]): x for x in handed}.values())  # a pool smaller than both ends hands a content on once
        rows = self.spark.createDataFrame([(k,) for k in {x[2] for x in handed}], "key binary")
        one = self.featured.join(F.broadcast(rows), "key").groupBy("key").agg(F.min_by(F.struct("content", "meta"), _first()).alias("x"))
        found = {bytes(r["key"]): r for r in one.select("key", "x.content", "x.meta").collect()}
        for view, model in enumerate(self.models):
            own = [x for x in handed if x[0] == view]
            lesson = [found[x[2]] for x in own]
            targets = sigmoid(model.logit(Bags([bytes(r["meta" if view else "content"]) for r in lesson])))
            raw, y = self.sets[1 - view]
            self.sets[1 - view] = (raw + [bytes(r["content" if view else "meta"]) for r in lesson], np.concatenate([y, targets]))
        self.offers += [(number, *x) for x in handed]
        sent.unpersist()

    def scores(self) -> DataFrame:
        kind = dict(self.featured.dtypes)["doc_id"]
        if self.combination is None:
            half = F.lit(0.5)
            return self.featured.select("doc_id", half.alias("content_score"), half.alias("meta_score"), half.alias("score"))
        sent = self.spark.sparkContext.broadcast((*self.models, *self.combination))
        return self.featured.select("doc_id", "content", "meta").mapInArrow(_final(sent), f"doc_id {kind}, content_score double, meta_score double, score double")


def share_of_key(key: Column, number: int) -> Column:
    """A number from 0 to 1 by the hash of ``key``, another in each round."""
    return F.pmod(F.xxhash64(key, F.lit(number)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _ranked(counts: list[tuple[int, int]], pseudo: int, good: bool, number: int) -> Column:
    """Whether a row is among the first ``pseudo``: ``counts`` has the steps from the best on."""
    room = pseudo
    for step, n in counts:
        if n >= room:
            beyond = F.col("step") > step if good else F.col("step") < step
            return beyond | ((F.col("step") == step) & (share_of_key(F.col("key"), number) < F.lit(room / n)))
        room -= n
    return F.lit(True)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, key, content, meta) of every document, written once."""
    rows = docs.select("doc_id", whole_text().alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    return staged(rows.mapInArrow(_featurise, _ROW.format(dict(docs.dtypes)["doc_id"])), "cotraining-features")


def cotraining(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, sample_bytes: int = SAMPLE_BYTES, rounds: int = ROUNDS, pseudo: int | None = None, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, content_score, meta_score, score, kept."""
    return CoTraining(features(docs), labels, labelled, sample_bytes, rounds, pseudo).scores().withColumn("kept", F.col("score") >= cut)

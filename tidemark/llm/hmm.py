"""Hidden Markov language model (operator 2).

Tokens are lower-cased words and one end per text.  Training texts are those
whose ``crc32`` of the id is not 1 modulo 5.

*Counts.*  Every token of every training text is counted exactly (combined per
batch, then by shuffle).  They give the base score, an additively smoothed
unigram model.

*Model.*  A latent state emits the *class* of a token; the token follows from its
class by the exact counts, smoothed like the base.  The ``own`` most frequent
words are classes of their own; all others share ``suffix`` classes by a hash of
their last three bytes; the end is a class.  So P(token | state) =
B[state, class] * q(token | class) is a proper distribution for any vocabulary,
while what is trained and broadcast has a fixed size: ``states`` * (own + suffix
+ 1) numbers.

*Training.*  Each round of Baum-Welch runs scaled forward-backward over all
training texts, whole; every partition adds up its expected counts and Spark
sums them by class.  Of a long text only every ``CELLS``-th forward vector is
kept, and the others are computed again on the way back, so that a text of any
length takes bounded tables and is never cut.

*Scoring.*  The scaled forward recursion gives the exact likelihood of the whole
class sequence of every text; the words' q factors are added.  Counts of the
``common`` most frequent words (bounded in number and length) travel to the
tasks; those of all other words are joined by shuffle, so nothing that grows
with the vocabulary is broadcast.

Defined results: a null text is empty and has one token, the end; a null id
counts as the empty id; words of equal counts are ranked by their bytes;
repeated rows give repeated results and count twice in training; with no
training text, c, N and V are 0; an empty table gives an empty result; other
columns play no role.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, whole_text
from tidemark.llm.words import chunks, split_words

STATES, ROUNDS, OWN, SUFFIX, COMMON, COMMON_BYTES = 8, 4, 8192, 2048, 65_536, 64
CELLS = 1 << 18
SEED = 11


def _suffix_class(word: bytes, own: int, suffix: int, cache: dict) -> int:
    tail = word[-3:]
    if tail not in cache:
        cache[tail] = own + xxhash.xxh64_intdigest(tail) % suffix
    return cache[tail]


def _count_batches(batches):
    for batch in batches:
        for start, end in chunks(batch.column(0)):
            _, index, words = split_words(batch.column(0).slice(start, end - start))
            count = np.bincount(index, minlength=len(words)).astype(np.int64)
            used = np.flatnonzero(count)
            tokens = [words[k] for k in used]
            yield pa.RecordBatch.from_arrays([pa.array([*tokens, None], pa.binary()), pa.array([*count[used].tolist(), end - start], pa.int64())], names=["token", "n"])


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over all texts; the null token is the end."""
    return texts.mapInArrow(_count_batches, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _most_frequent(words: DataFrame, most: int) -> list:
    """The most frequent words, at most ``most``, by whole steps of an eighth of a power of two of their count.

    A histogram of counts gives the least step that still fits, so only words
    that are kept leave the executors, and nothing is sorted there.
    """
    stepped = words.withColumn("step", F.floor(8 * F.log2("n")))
    least, room = None, most
    for r in sorted(stepped.groupBy("step").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["step"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    kept = stepped.where(F.col("step") >= least).collect() if least is not None else []
    return sorted(kept, key=lambda r: (-r["n"], bytes(r["token"])))


class Vocabulary:
    """What tasks need to know of the counts; of bounded size."""

    def __init__(self, counts: DataFrame, own: int, suffix: int, common: int):
        self.own, self.suffix, self.end = own, suffix, own + suffix
        whole = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("token").isNull(), F.col("n")))).first()
        self.total, self.distinct, self.ends = whole[0] or 0, whole[1], whole[2] or 0
        words = counts.where("token is not null")
        top = _most_frequent(words.where(F.octet_length("token") <= COMMON_BYTES), common)
        self.common = {bytes(r["token"]): (k if k < own else None, r["n"]) for k, r in enumerate(top)}
        alone = {w for w, (k, _) in self.common.items() if k is not None}

        def grouped(batches):
            cache: dict[bytes, int] = {}
            for batch in batches:
                tokens, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows = [(_suffix_class(t, own, suffix, cache), c) for t, c in zip(tokens, n, strict=True) if t not in alone]
                cls, val = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
                number, at = np.unique(cls, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(np.bincount(at, val, len(number)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(number)).astype(np.int64))], names=["class", "n", "v"])

        self.class_tokens = np.zeros(self.end + 1)
        self.class_words = np.zeros(self.end + 1)
        for k, (_, n) in zip(range(own), self.common.values(), strict=False):
            self.class_tokens[k] = n
        for r in words.mapInArrow(grouped, "class long, n long, v long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
            self.class_tokens[r["class"]], self.class_words[r["class"]] = r["n"], r["v"]
        self.class_tokens[self.end] = self.ends

    def prior(self) -> np.ndarray:
        smoothed = self.class_tokens + 0.5
        return smoothed / smoothed.sum()

    def log_norms(self) -> np.ndarray:
        """log10 of the denominator of q(token | class); 0 where the class is one token."""
        out = np.zeros(self.end + 1)
        out[self.own : self.end] = np.log10(self.class_tokens[self.own : self.end] + 0.5 * (self.class_words[self.own : self.end] + 1))
        return out


_CODED = "doc_id {}, held_out boolean, n_tokens long, n_known long, own_log double, shared_log double, classes binary, rare array<binary>, rare_n array<long>"


def _coder(vocabulary):
    def run(batches):
        v = vocabulary.value
        cache: dict[bytes, int] = {}
        for batch in batches:
            for start, end in chunks(batch.column(2)):
                yield code(batch.slice(start, end - start), v, cache)

    def code(batch, v, cache):
        offsets, index, words = split_words(batch.column(2))
        n, size = batch.num_rows, np.diff(offsets)
        known = [v.common.get(w) for w in words]
        cls = np.array([k[0] if k and k[0] is not None else _suffix_class(w, v.own, v.suffix, cache) for w, k in zip(words, known, strict=True)], np.uint16)
        log = np.array([np.log10(k[1] + 0.5) if k else 0.0 for k in known])
        seen, alone = np.array([k is not None for k in known], bool), cls < v.own
        doc = np.repeat(np.arange(n), size)
        of_doc = lambda values: np.bincount(doc, values[index], n) if len(index) else np.zeros(n)
        own_log = of_doc(log * alone) + np.log10(v.ends + 0.5)
        shared_log, n_known = of_doc(log * ~alone), of_doc(seen.astype(np.float64)) + (v.ends > 0)
        sequence = np.insert(cls[index], offsets[1:], np.uint16(v.end)) if len(index) else np.full(n, v.end, np.uint16)
        cuts = (offsets + np.arange(n + 1)) * 2
        raw = sequence.astype(np.uint16).tobytes()
        rare = ~seen[index] if len(index) else np.zeros(0, bool)
        pair, times = np.unique(doc[rare] * max(1, len(words)) + index[rare], return_counts=True)
        owner, word = np.divmod(pair, max(1, len(words)))
        bounds = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(bounds, pa.array([words[k] for k in word], pa.binary())), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64)))]
        columns = [batch.column(0), batch.column(1), pa.array(size + 1, pa.int64()), pa.array(n_known.astype(np.int64)), pa.array(own_log), pa.array(shared_log), pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "own_log", "shared_log", "classes", "rare", "rare_n"])

    return run


class Model:
    """start (K), step (K, K) and emit (C, K) probabilities."""

    def __init__(self, start, step, emit):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, prior: np.ndarray, states: int) -> Model:
        rng = np.random.default_rng(SEED)
        emit = prior[:, None] * np.exp(rng.normal(0, 1, (len(prior), states)))
        step = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def groups(sequences: list[np.ndarray], cells: int = CELLS):
    """Index lists of similar length, longest first, of at most ``cells`` padded cells."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    at = 0
    while at < len(order):
        width = max(1, cells // max(1, len(sequences[order[at]])))
        yield order[at : at + width]
        at += width


def _padded(sequences: list[np.ndarray], own: list[int]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(sequences[k]) for k in own])
    table = np.zeros((sizes[0], len(own)), np.int64)
    for c, k in enumerate(own):
        table[: sizes[c], c] = sequences[k]
    return table, np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")  # texts still running at each step


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 P(sequence) by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    for own in groups(sequences):
        table, active = _padded(sequences, own)
        total = np.zeros(len(own))
        alpha = np.tile(model.start, (len(own), 1))
        for t in range(len(table)):
            a = active[t]
            alpha = (alpha[:a] @ model.step if t else alpha[:a]) * model.emit[table[t, :a]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:a] += np.log10(scale)
        out[own] = total
    return out


def _forward(table, active, model: Model, first: int, alpha: np.ndarray | None, alphas: np.ndarray | None, scales: np.ndarray | None) -> np.ndarray:
    """Scaled forward vectors of the steps of ``table``, from ``alpha`` on (none before the first step); returns the last."""
    for t in range(len(table)):
        a = active[first + t]
        alpha = (np.tile(model.start, (a, 1)) if alpha is None else alpha[:a] @ model.step) * model.emit[table[t, :a]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        if alphas is not None:
            alphas[t, :a], scales[t, :a] = alpha, scale
    return alpha


def expected_counts(sequences: list[np.ndarray], model: Model, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts (K), steps (K, K) and emissions (C, K) by scaled forward-backward, in blocks of at most ``cells`` padded cells."""
    states, classes = len(model.start), len(model.emit)
    start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
    back = np.ascontiguousarray(model.step.T)
    for own in groups(sequences, cells):
        table, active = _padded(sequences, own)
        steps, width = table.shape
        size = max(1, cells // width)
        before: list[np.ndarray | None] = [None]  # the forward vectors before each block
        for lo in range(0, steps - size, size):
            before.append(_forward(table[lo : lo + size], active, model, lo, before[-1], None, None))
        beta = np.ones((width, states))
        for k in range(len(before) - 1, -1, -1):
            lo, hi = k * size, min(steps, (k + 1) * size)
            alphas, scales = np.zeros((hi - lo, width, states)), np.ones((hi - lo, width))
            _forward(table[lo:hi], active, model, lo, before[k], alphas, scales)
            for t in range(hi - 1, lo - 1, -1):
                a = active[t]
                future = model.emit[table[t, :a]] * beta[:a] / scales[t - lo, :a, None]
                alphas[t - lo, :a] *= beta[:a]  # from here on the state posteriors
                if t:
                    previous = alphas[t - 1 - lo, :a] if t > lo else before[k][:a]
                    step += previous.T @ future
                    beta[:a] = future @ back
            if k == 0:
                start += alphas[0].sum(axis=0)
            mask = np.arange(width)[None, :] < active[lo:hi, None]
            flat, weights = table[lo:hi][mask], alphas[mask]
            for s in range(states):
                emit[:, s] += np.bincount(flat, weights[:, s], classes)
    return start, step * model.step, emit


def _expect(model):
    def run(batches):
        sums = None
        for batch in batches:
            sequences = [np.frombuffer(x, np.uint16) for x in batch.column(0).to_pylist()]
            found = expected_counts(sequences, model.value)
            sums = found if sums is None else [a + b for a, b in zip(sums, found, strict=True)]
        if sums is not None:
            start, step, emit = sums
            used = np.flatnonzero(emit.sum(axis=1) > 0)
            table = np.concatenate([emit[used], step, start[None, :]])
            places = [*used.tolist(), *(-1 - k for k in range(len(step))), -1 - len(step)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), *(pa.array(np.ascontiguousarray(table[:, s])) for s in range(table.shape[1]))], names=["place", *(f"s{s}" for s in range(table.shape[1]))])

    return run


def train(coded: DataFrame, prior: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    spark, model = coded.sparkSession, Model.first(prior, states)
    sequences = coded.where("not held_out").select("classes")
    names = [f"s{s}" for s in range(states)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        sums = sequences.mapInArrow(_expect(sent), "place int, " + ", ".join(f"{n} double" for n in names)).groupBy("place").agg(*(F.sum(n).alias(n) for n in names)).collect()
        start, step, emit = np.ones(states), np.ones((states, states)), prior[:, None] * np.full(states, 10.0)
        for r in sums:
            row = np.array([r[n] for n in names])
            if r["place"] >= 0:
                emit[r["place"]] += row
            elif r["place"] >= -states:
                step[-1 - r["place"]] += row
            else:
                start += row
        sent.unpersist()
        model = Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def _score(model, norms):
    def run(batches):
        m, n = model.value, norms.value
        for batch in batches:
            sequences = [np.frombuffer(x, np.uint16) for x in batch.column(batch.num_columns - 1).to_pylist()]
            log = log_likelihoods(sequences, m) - np.array([n[x].sum() for x in sequences])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), pa.array(log)], names=[*batch.schema.names[:-1], "hmm_log"])

    return run


def hmm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS, own: int = OWN, suffix: int = SUFFIX, common: int = COMMON) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held_out = F.pmod(F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "utf-8")), F.lit(5)) == 1
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), whole_text(text).alias("text"))
    counts = staged(count_tokens(rows.where("not held_out").select("text")), "hmm-counts")
    vocabulary = Vocabulary(counts, own, suffix, max(own, common))
    sent = spark.sparkContext.broadcast(vocabulary)
    coded = rows.mapInArrow(_coder(sent), _CODED.format(dict(rows.dtypes)["doc_id"]))
    coded = staged(coded.withColumn("row", F.monotonically_increasing_id()), "hmm-coded")  # row ids are fixed from here on
    model = train(coded, vocabulary.prior(), states, rounds)

    uses = coded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("times"))
    met = uses.join(counts.where("token is not null"), "token", "left")
    rare = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))

    sent_model, norms = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(vocabulary.log_norms())
    narrow = coded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "own_log", "shared_log", "classes")
    kinds = ", ".join(f"{n} {t}" for n, t in narrow.dtypes if n != "classes")
    scored = narrow.mapInArrow(_score(sent_model, norms), f"{kinds}, hmm_log double").join(rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    norm = float(np.log10(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("own_log") + F.col("shared_log") + rare_log - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("hmm_log") + F.col("shared_log") + rare_log).alias("score"),
    )

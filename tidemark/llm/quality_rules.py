"""Quality rules with risk-controlled thresholds (operator 6), DataFrame functions only.

Every document gets base counts and, from them, signals (``RULES``).  A rule
rejects a document whose signal exceeds the cutoff of its stratum (language).
Cutoffs are fitted on the labelled documents, as a holdout for rules that are
not trained on it: for each stratum, rule and grid value, the good documents and
the good and bad ones that the value would reject are counted.  A cutoff is
*certified* when the exact binomial test refutes "it rejects at least
``risk / rules`` of the stratum's good documents": P(Bin(n, risk / rules) <= x)
is at most ``alpha / (strata * rules)``.  Along the grid of one rule, from
lenient to strict, testing stops at the first value that fails (fixed-sequence
testing), so the grid needs no further correction; rules and strata share alpha
by Bonferroni.  With probability 1 - ``alpha``, no stratum loses more than
``risk`` of its good documents to the rules.  Of the certified cutoffs, the one
that rejects most bad documents net of ``price`` times the good ones is used,
the most lenient one on ties; a rule that gains nothing is off in that stratum,
as it is where labels are too few.

Counting repeated windows sorts one document's 64-bit window hashes inside its
row; nothing but labels and narrow signal rows is shuffled.  Fitting is a
map-side combined aggregate per stratum, so a stratum with most rows is no hot
task.  The cutoffs are broadcast when there are at most ``BROADCAST_STRATA``
strata, else joined by shuffle.

Defined results: a null or empty text has no words (all counts 0, base_failed);
very long texts are counted whole; a null language counts as the empty one; a
doc_id labelled several times counts as its lowest quality; labels without a
quality or document are not used; repeated rows give repeated results and count
as often among the labelled documents; of equal net gains the most lenient cutoff
is used; empty tables give empty results or rules that are off; other columns
play no role.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, whole_text

MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
RISK, ALPHA, PRICE = 0.02, 0.05, 10
BROADCAST_STRATA = 10_000
_SPACE, _SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"

#: Signal and grid of every rule; signals are exact ratios of counts.
RULES = {
    "symbols": (lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)), [k / 100 for k in (50, 40, 30, 25, 20, 18, 16, 14, 12, 10, 8, 6, 5, 4, 3, 2)]),
    "dup_lines": (lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), [k / 100 for k in (90, 80, 70, 60, 50, 45, 40, 35, 30, 25, 20, 15, 10)]),
    "repeats": (lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)), [k / 100 for k in (29, 27, 25, 23, 21, 19, 17, 15, 13, 11, 9, 7, 5)]),
    "capitals": (lambda: F.col("n_capitals") / F.greatest("word_chars", F.lit(1)), [k / 100 for k in (90, 80, 70, 60, 50, 45, 40, 35, 30, 25, 20, 15)]),
    "word_length": (lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)), [40, 30, 25, 20, 18, 16, 15, 14, 13, 12, 11, 10]),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more in ``words``."""

    def covered(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

        def repeated(r: Column) -> Column:
            twin = F.filter(r, lambda x, k: F.coalesce(F.get(r, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(r, k + 1)["h"] == x["h"], F.lit(False)))
            starts = F.array_sort(F.transform(twin, lambda x: x["k"]))
            return _let(starts, lambda s: F.aggregate(F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(ranked, repeated))

    distinct = F.size(F.array_distinct(words)) == F.size(words)  # then no window repeats
    return F.when((F.size(words) <= WINDOW) | distinct, F.lit(0)).otherwise(_let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _windows(h, 1, covered)))


def _windows(hashes: Column, width: int, body) -> Column:
    """``body`` of the hashes of all windows of ``WINDOW`` (a power of two) words, from those of ``width`` words; each doubles by one step."""
    if width == WINDOW:
        return body(hashes)
    n = F.size(hashes) - width
    doubled = F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + width), n), lambda a, b: F.xxhash64(a, b))
    return _let(doubled, lambda x: _windows(x, 2 * width, body))


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``COUNTS``."""
    whole = whole_text(text)
    words = F.filter(F.split(whole, _SPACE), lambda w: w != "")
    by_word = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeat_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    own = docs.withColumns({f"{prefix}words": by_word, f"{prefix}lines": by_line, f"{prefix}n_symbols": F.regexp_count(whole, F.lit(_SYMBOLS)).cast("long"), f"{prefix}n_capitals": F.regexp_count(whole, F.lit("[A-Z]")).cast("long")})
    fields = {f"{prefix}{f}": F.col(f"{prefix}words.{f}").cast("long") for f in ("n_words", "word_chars", "n_repeat_words")} | {f"{prefix}{f}": F.col(f"{prefix}lines.{f}").cast("long") for f in ("n_lines", "n_dup_lines")}
    return own.withColumns(fields).drop(f"{prefix}words", f"{prefix}lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= x), 1 where x is at least n * p; terms are carried as logarithms."""
    step = F.lit(p / (1 - p))
    first = F.struct((n * F.log(F.lit(1 - p))).alias("t"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))

    def add(a: Column, k: Column) -> Column:
        t = a["t"] + F.log((n - k + 1) / k * step)
        return F.struct(t.alias("t"), (a["s"] + F.exp(t)).alias("s"))

    ks = F.when(x > 0, F.sequence(F.lit(1).cast("long"), F.greatest(x, F.lit(1)).cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.when(x >= n * p, F.lit(1.0)).otherwise(F.aggregate(ks, first, add)["s"])


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA, price: float = PRICE) -> DataFrame:
    """One row per stratum with the cutoff of every rule, null where it is off."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = counted.where(~base_failed()).join(truth, "doc_id").select("stratum", (F.col("quality") >= 1).alias("good"), *(signal().alias(rule) for rule, (signal, _) in RULES.items()))
    hits = [F.count_if(~F.col("good") & (F.col(rule) > c)).alias(f"b_{rule}_{k}") for rule, (_, grid) in RULES.items() for k, c in enumerate(grid)]
    hits += [F.count_if(F.col("good") & (F.col(rule) > c)).alias(f"g_{rule}_{k}") for rule, (_, grid) in RULES.items() for k, c in enumerate(grid)]
    table = staged(joined.groupBy("stratum").agg(F.count_if("good").alias("n"), *hits), "quality-holdout")
    share, level = risk / len(RULES), alpha / (len(RULES) * max(1, table.count()))
    cuts = []
    for rule, (_, grid) in RULES.items():
        tested = F.array(*(F.struct(F.lit(float(c)).alias("cutoff"), F.col(f"b_{rule}_{k}").alias("bad"), F.col(f"g_{rule}_{k}").alias("lost"), (binomial_cdf(F.col(f"g_{rule}_{k}"), F.col("n"), share) <= level).alias("sure")) for k, c in enumerate(grid)))
        held = F.transform(F.filter(_certified(tested), lambda x: x["bad"] > price * x["lost"]), lambda x: F.struct((x["bad"] - price * x["lost"]).alias("net"), x["cutoff"].alias("cutoff")))
        cuts.append(F.array_max(held)["cutoff"].alias(f"cut_{rule}"))
    return staged(table.select("stratum", *cuts), "quality-cutoffs")


def _certified(tested: Column) -> Column:
    """The values up to the first that fails."""
    return _let(tested, lambda t: F.filter(t, lambda x, k: F.forall(F.slice(t, F.lit(1), k + 1), lambda y: y["sure"])))


def with_verdict(counted: DataFrame, cuts: DataFrame) -> DataFrame:
    """``counted`` with base_failed and kept."""
    few = cuts.count() <= BROADCAST_STRATA
    joined = counted.join(F.broadcast(cuts) if few else cuts, "stratum", "left")
    rejects = reduce(lambda a, b: a | b, (F.coalesce(signal() > F.col(f"cut_{rule}"), F.lit(False)) for rule, (signal, _) in RULES.items()))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejects)


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    narrow = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), "text")
    counted = staged(with_counts(narrow).drop("text"), "quality-counts")
    judged = with_verdict(counted, cutoffs(counted, labels, **options))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    names = docs.columns
    whole = docs.select(F.struct(*(f"`{c}`" for c in names)).alias("doc"), "doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), "text")
    counted = staged(with_counts(whole).drop("text"), "quality-counts")
    judged = with_verdict(counted, cutoffs(counted.drop("doc"), labels, **options))
    return judged.where("kept").select(*(F.col("doc")[c].alias(c) for c in names))


def oracle(risk: float = RISK, alpha: float = ALPHA, price: float = PRICE) -> str:
    """DuckDB SQL for ``quality_rules``; the binomial tail is summed by log-gamma."""
    share = risk / len(RULES)
    value = {"symbols": "n_symbols / greatest(word_chars, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)", "capitals": "n_capitals / greatest(word_chars, 1)", "word_length": "word_chars / greatest(n_words, 1)"}
    grid = ", ".join(f"('{rule}', {k}, CAST({c} AS DOUBLE))" for rule, (_, values) in RULES.items() for k, c in enumerate(values))
    signals = " UNION ALL ".join(f"SELECT rid, doc_id, stratum, base_failed, '{rule}' AS rule, {v} AS value FROM c" for rule, v in value.items())
    term = f"exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({share!r}) + (n - j) * ln(1 - {share!r}))"
    return rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (SELECT rid, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(s)),
twice AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY rid, k) AS times FROM win) WHERE times > 1),
hit AS (SELECT rid, count(DISTINCT s + o) AS hits FROM twice, unnest(range(0, {WINDOW})) AS u(o) GROUP BY rid),
f AS MATERIALIZED (
  SELECT rid, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(hits, 0) AS n_repeat_words, len(l) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
  FROM d LEFT JOIN hit USING (rid)
), c AS MATERIALIZED (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM f),
v AS MATERIALIZED ({signals}),
truth AS (SELECT doc_id, min(quality) >= 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h AS MATERIALIZED (SELECT stratum, rule, value, good FROM v JOIN truth USING (doc_id) WHERE NOT base_failed),
grid(rule, k, cutoff) AS (VALUES {grid}),
counted AS (SELECT stratum, rule, k, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good AND value > cutoff) AS bad, count(*) FILTER (good AND value > cutoff) AS lost FROM h JOIN grid USING (rule) GROUP BY ALL),
tested AS (SELECT *, lost < n * {share!r} AND list_sum(list_transform(range(0, lost + 1), lambda j: {term})) <= {alpha} / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM h)) AS sure FROM counted),
certified AS (SELECT *, bool_and(sure) OVER (PARTITION BY stratum, rule ORDER BY k) AS held FROM tested),
cuts AS (SELECT stratum, rule, arg_max(cutoff, (bad - {price} * lost, cutoff)) AS cut FROM certified WHERE held AND bad > {price} * lost GROUP BY stratum, rule),
rejected AS (SELECT rid FROM v JOIN cuts USING (stratum, rule) WHERE value > cut GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected.rid IS NULL AS kept
FROM c LEFT JOIN rejected USING (rid)"""

"""Mixing sources to target weights by iterative proportional fitting (operator 5), DataFrame functions only.

Token weights of the cells (source, language, topic) are raked, one margin after
the other, to the target shares of sources, languages and topics, starting from
the cells' own tokens so that their interactions stay.  Targets are given as
shares, or follow from the corpus: its share of tokens to the power
``temperature``, normalised, which lifts small sources and languages.  A cell's
calibrated probability is ``rate`` times its fitted over its actual share,
1 at most; where the cap holds, the rest is left as the documents' ``weight``.
A document is sampled when the first 52 bits of the MD5 of its id and the seed,
as a fraction, fall below its cell's probability, so a run repeats exactly.
``sample`` repeats a document by its weight, once more for the weight's fraction
when the same bits fall below it, so that capped cells meet their targets too.

The topic is the form of the text (``topic``); pass another expression to mix by
other topics.  Documents are read once for the cells (aggregated map-side, so a
source with a third of the rows is no hot task) and once to sample; they are not
shuffled.  Each sweep works on the table of cells, which is small and written to
the shared folder.  Fitted cells are broadcast while there are at most
``BROADCAST_CELLS``; beyond that they are joined by shuffle, the hot cells split
by a salt.

Defined results: a null source or language counts as the empty string; a null or blank text has no tokens, and as it
changes no weight it is sampled with its cell's probability, or with ``rate`` in
a cell without tokens; repeated rows are sampled together, since they share an
id; a null id counts as the empty id; an empty table gives an empty result;
other columns play no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

TEMPERATURE, RATE, SWEEPS, SEED = 0.7, 0.6, 12, "mix-1"
BROADCAST_CELLS, SALTS = 50_000, 64
MARGINS = ("source", "lang", "topic")


def tokens(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic(text: str = "text") -> Column:
    """The form of a text: tabular, licensed, listed (many lines) or prose."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.contains(whole, F.lit(" | ")), "tabular").when(F.contains(whole, F.lit("icense")), "licensed").when(F.contains(whole, F.lit("\n")), "listed").otherwise("prose")


def uniform(doc_id: str, seed: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _targets(cells: DataFrame, margin: str, given: dict[str, float] | None, temperature: float) -> DataFrame:
    """(margin, target) with shares that add up to 1 over the values that have tokens."""
    have = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
    if given is None:
        raw = have.select(margin, F.pow("t", F.lit(temperature)).alias("raw"))
    else:
        table = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"{margin} string, raw double")
        raw = have.select(margin).join(table, margin)
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return staged(raw.select(margin, (F.col("raw") / total).alias("target")), "mixing-target")


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens, docs) with ``share``, fitted to the targets of every margin."""
    cells = staged(cells, "mixing-cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    fitted = cells.withColumn("share", F.col("tokens") / F.lit(float(total)))
    for m in MARGINS:
        goal = _targets(cells, m, (targets or {}).get(m), temperature)
        fitted = fitted.join(goal, m, "left").withColumn(f"goal_{m}", F.coalesce("target", F.lit(0.0))).drop("target")
    fitted = staged(fitted, "mixing-raked")
    for _ in range(sweeps):
        for m in MARGINS:  # a table for each step: a plan that reads its own input twice would double at every step
            have = fitted.groupBy(m).agg(F.sum("share").alias("have"))
            scaled = F.when(F.col("have") > 0, F.col("share") * (F.col(f"goal_{m}") / F.col("have"))).otherwise(0.0)
            fitted = staged(fitted.join(have, m).withColumn("share", scaled).drop("have"), "mixing-raked")
    return fitted.drop(*(f"goal_{m}" for m in MARGINS))


def _keyed(docs: DataFrame) -> DataFrame:
    """The whole row as ``doc``, with the values that mixing needs."""
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("doc"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), topic().alias("topic"), tokens().alias("tokens"), F.col("doc_id").alias("id"))


def mixed(docs: DataFrame, rate: float = RATE, seed: str = SEED, **options) -> DataFrame:
    """(doc, source, lang, topic, tokens, probability, weight, sampled, copies) for every document; ``doc`` is its row."""
    keyed = _keyed(docs)
    narrow = staged(keyed.drop("doc", "id").groupBy(*MARGINS).agg(F.sum("tokens").cast("long").alias("tokens"), F.count("*").alias("docs")), "mixing-counts")
    fitted = rake(narrow, **options)
    total = narrow.agg(F.sum("tokens")).first()[0] or 1
    ratio = F.when(F.col("tokens") > 0, F.round(F.lit(rate) * F.col("share") * F.lit(float(total)) / F.col("tokens"), 6)).otherwise(F.lit(rate))
    calibrated = staged(fitted.select(*MARGINS, F.least(ratio, F.lit(1.0)).alias("probability"), F.greatest(ratio, F.lit(1.0)).alias("weight")), "mixing-fitted")
    if calibrated.count() <= BROADCAST_CELLS:
        joined = keyed.join(F.broadcast(calibrated), [*MARGINS])
    else:
        salted = calibrated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, [*MARGINS, "salt"]).drop("salt")
    drawn = uniform("id", seed)
    copies = F.floor("weight") + (drawn < F.col("weight") - F.floor("weight")).cast("long")
    return joined.withColumn("sampled", drawn < F.col("probability")).withColumn("copies", F.when(F.col("sampled"), copies).otherwise(F.lit(0).cast("long")))


def mixing(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, weight, sampled."""
    rows = mixed(docs.select("doc_id", "source", "lang", "text"), **options)
    return rows.select(F.col("id").alias("doc_id"), "source", "lang", "topic", F.col("tokens").alias("n_tokens"), "probability", "weight", "sampled")


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, each as often as its weight says, with the columns of ``docs``."""
    rows = mixed(docs, **options).where("sampled").select("doc", F.explode(F.expr("array_repeat(0, cast(copies as int))")))
    return rows.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def oracle(table: str = "documents", rate: float = RATE, temperature: float = TEMPERATURE, sweeps: int = SWEEPS, seed: str = SEED) -> str:
    """DuckDB SQL for ``mixing`` with targets from the corpus: every raking step is a table of its own."""
    steps = [
        rf"""d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular' WHEN contains(coalesce(text, ''), 'icense') THEN 'licensed' WHEN contains(coalesce(text, ''), chr(10)) THEN 'listed' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM {table})""",
        "c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL)",
        "w0 AS MATERIALIZED (SELECT *, CAST(tokens AS DOUBLE) / (SELECT sum(tokens) FROM c) AS share FROM c)",
    ]
    for m in MARGINS:
        steps.append(f"r_{m} AS MATERIALIZED (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {temperature}) AS raw FROM c GROUP BY {m} HAVING sum(tokens) > 0)")
        steps.append(f"t_{m} AS MATERIALIZED (SELECT {m}, raw / (SELECT sum(raw) FROM r_{m}) AS target FROM r_{m})")
    k = 0
    for _ in range(sweeps):
        for m in MARGINS:
            steps.append(f"w{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN have > 0 THEN share * (coalesce(target, 0) / have) ELSE 0 END AS share FROM (SELECT *, sum(share) OVER (PARTITION BY {m}) AS have FROM w{k}) AS w LEFT JOIN t_{m} USING ({m}))")
            k += 1
    steps.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN round({rate} * share * (SELECT CAST(sum(tokens) AS DOUBLE) FROM c) / tokens, 6) ELSE {rate} END AS ratio FROM w{k})")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, n_tokens, least(ratio, 1.0) AS probability, greatest(ratio, 1.0) AS weight,
  CAST(CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 13)) AS BIGINT) AS DOUBLE) / {1 << 52}.0 < least(ratio, 1.0) AS sampled
FROM d JOIN p USING (source, lang, topic)"""

"""The corpus pipeline: five filters in order, each written and reread before the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame with the columns of ``documents``.  ``run`` applies them.

In every stage an empty table gives an empty one, texts of any length are read
whole, and other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read, staged
from tidemark.llm.decontamination import mark
from tidemark.llm.mixing import sample
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.pii import redact
from tidemark.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; null and empty texts have too few words and go, repeated rows fare alike."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: five words, a similarity of 0.8 or more.

    The smallest id stays, repeated rows are one; null and empty texts are like nothing and stay.
    """
    return one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate; null and empty texts have no hit and stay, repeated rows fare alike."""
    return mark(docs, read(spark, sf_dir, "benchmark")).where("not __tm_contaminated").select(*(f"`{c}`" for c in docs.columns))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; null texts stay null, repeated rows are changed alike."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their calibrated probabilities, repeated by their weights; rows of one id are sampled together, null sources and languages count as empty."""
    return sample(docs)


STAGES = [("quality_rules", quality_rules), ("ngram_join", ngram_join), ("decontamination", decontamination), ("pii", pii), ("mixing", mixing)]

#: The patterns of the fourth stage are learned in rounds, which SQL can't express; a test holds ``run`` against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

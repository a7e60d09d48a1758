"""Connected components by alternating large and small stars, on DataFrames.

Each round links every node's larger neighbours to its smallest one, then every
node and its smaller neighbours to the smallest of them; the edges become stars
around the smallest node of each component in a logarithmic number of rounds.
Minima are combined map-side, every round is written to the shared folder, and
the joins read plain tables, so that the partition of a hub can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _least(pairs: DataFrame, label: str) -> DataFrame:
    """(u, m): the smallest of u and its neighbours."""
    return staged(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{label}-least")


def _starred(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """(a, b) for all pairs (a, v), with what is smallest around v's place as b."""
    return pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b")


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node."""
    current = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), label)
    for _ in range(max_rounds):
        down = current.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = down.unionByName(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = staged(_starred(both, _least(both, label)).distinct(), label)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = _least(down, label)
        current = staged(_starred(down, least).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), label)
        centres = current.select(F.col("b").alias("a"), F.lit(0).alias("n"), F.lit(1).alias("centre"))
        seen = current.select("a", F.lit(1).alias("n"), F.lit(0).alias("centre")).unionByName(centres)
        open_ = seen.groupBy("a").agg(F.sum("n").alias("n"), F.max("centre").alias("centre")).where("n > 1 or n = 1 and centre = 1")
        if open_.isEmpty():  # no node has two centres, and no centre has one
            break
    else:
        raise RuntimeError("components did not converge")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return staged(members.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), label)

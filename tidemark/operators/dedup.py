"""Deduplication, upsert and ordered union.

First and last wins are aggregates (``min_by`` / ``max_by``) over explicit
positions, not windows: rows of one key are combined map-side, nothing is
sorted, and the result does not depend on arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
    return chosen.select(*(F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns))


def last_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """For each key the row of the greatest position."""
    return _pick(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """D3: for each key the row of the smallest position; validate rows before, not after."""
    return _pick(df, keys, order, F.min_by)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = (), order: list | None = None) -> DataFrame:
    """Union in which new rows replace existing ones whole, except that columns in ``keep`` fall back to the old value when the new one is null."""
    order = order or []
    both = existing.withColumn("__origin", F.lit(0)).unionByName(new.withColumn("__origin", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    rank = F.struct("__origin", *order)
    picks = [F.max_by(F.struct(*rest), rank).alias("__row")]
    picks += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"__kept_{c}") for c in keep]
    picked = both.groupBy(*keys).agg(*picks)
    columns = [F.col(c) if c in keys else (F.coalesce(f"__row.{c}", f"__kept_{c}") if c in keep else F.col(f"__row.{c}")).alias(c) for c in both.columns if c != "__origin"]
    return picked.select(*columns)


def ordered_union(preferred: DataFrame, other: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of ``preferred``, then those of ``other`` with unseen keys."""
    both = preferred.withColumn("source_rank", F.lit(0)).unionByName(other.withColumn("source_rank", F.lit(1)))
    return first_wins(both, keys, ["source_rank", *order])


def with_main_image(main: Column, images: Column) -> Column:
    """``images`` headed by ``main`` unless it is empty or already there; normalise both first."""
    missing = (F.coalesce(main, F.lit("")) != "") & ~F.array_contains(images, F.coalesce(main, F.lit("")))
    return F.when(missing, F.concat(F.array(main), images)).otherwise(images)

"""Cursors, stopping rules and integrity.

Instants are compared as timestamps, since texts of mixed precision misorder;
the raw text stays for export.  The state table has a row for each member that
was ever synced; Spark broadcasts it while it is small by its own threshold and
shuffles it on the key otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["group_id", "member_id"]


def instant(text: Column) -> Column:
    return F.try_to_timestamp(text)


def after_cursor(messages: DataFrame, state: DataFrame, keys: list[str] | None = None, ts: str = "published_at") -> DataFrame:
    """P3 with J4: rows at or after their key's cursor; all rows of a key without one.  A row without instant passes only then."""
    keys = keys or KEYS
    cursors = state.select(*keys, F.col("last_sync_ts").alias("__cursor"))
    at, cursor = (instant(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c) for df, c in ((messages, ts), (cursors, "__cursor")))
    return messages.join(cursors, keys, "left").where(cursor.isNull() | F.coalesce(at >= cursor, F.lit(False))).drop("__cursor")


def after_id(messages: DataFrame, since_id: int, ts: str = "published_at") -> DataFrame:
    """If ``since_id`` is among the rows, those from its instant on (itself included), else those of greater id."""
    cursor = messages.where(F.col("id") == since_id).agg(F.max(ts)).scalar()  # a subquery: no job runs while the plan is built
    return messages.where(F.when(cursor.isNotNull(), F.col(ts) >= cursor).otherwise(F.col("id") > since_id))


def take_while(df: DataFrame, keys: list[str], order: list, stop: Column) -> DataFrame:
    """The rows of each key before the first, in order, for which ``stop`` holds (null does not stop).

    The stopping position is an aggregate and is joined back, so no key's rows
    are gathered and sorted in one task.
    """
    at = F.struct(*order)
    stops = df.where(F.coalesce(stop, F.lit(False))).groupBy(*keys).agg(F.min(at).alias("__stop"))
    return df.join(stops, keys, "left").where(F.col("__stop").isNull() | (at < F.col("__stop"))).drop("__stop")


def older_than(published: Column, since: Column, day_only: Column | None = None) -> Column:
    """The stopping rule of a scan: before ``since``; dates without time compare by day."""
    if day_only is None:
        return published < since
    return F.when(day_only, F.date_trunc("day", published) < F.date_trunc("day", since)).otherwise(published < since)


def clamp(newest: Column, earliest_failed: Column) -> Column:
    """The cursor may not pass the earliest failed row; without either it is what is known of the newest."""
    return F.when(newest.isNotNull() & earliest_failed.isNotNull(), F.least(newest, earliest_failed)).otherwise(newest)


def earliest_failed(rejects: DataFrame, keys: list[str] | None = None, ts: str = "timestamp") -> DataFrame:
    """A5: the earliest instant of the failed rows of each key."""
    return rejects.groupBy(*(keys or KEYS)).agg(F.min(ts).alias("earliest_failed"))


def lost_rows(state: DataFrame, stored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """State with actual_messages and needs_full_refetch, true where fewer rows are stored than the state says."""
    keys = keys or KEYS
    counts = stored.groupBy(*keys).agg(F.count("*").alias("actual_messages"))
    joined = state.join(counts, keys, "left").withColumn("actual_messages", F.coalesce("actual_messages", F.lit(0)))
    return joined.withColumn("needs_full_refetch", (F.col("total_messages") > 0) & (F.col("actual_messages") < F.col("total_messages")))

"""Lookups between messages, members, lists and media."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.membership import unseen


def media_queue(messages: DataFrame, present: DataFrame, member_dir, filtered: bool = False) -> DataFrame:
    """The media of messages whose file is not among ``present`` (path).

    With ``filtered`` a membership filter of the present paths goes first, so that
    new media, most of a run's, are not dealt out to be joined.
    """
    wanted = messages.where(F.coalesce("media_url", F.lit("")) != "")
    extension = S.media_extension("media_url", "raw_type")
    paths = wanted.withColumn("path", S.media_path(member_dir, "raw_type", "id", extension))
    if filtered:
        return unseen(paths, present.select("path"), ["path"]).select("path", *(c for c in paths.columns if c != "path"))
    return paths.join(present.select("path"), "path", "left_anti")


def list_to_detail(listed: DataFrame, details: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(listed posts with their detail, listed posts without one or with a failed one, with the reason).

    Both results read the same join, so the lookup shuffles once when it is
    cached or written.
    """
    taken = [c for c in details.columns if c != key]
    joined = listed.join(details.select(key, F.struct(*taken).alias("detail")), key, "left")
    ok = F.coalesce(F.col("detail.outcome") == "ok", F.lit(False)) if "outcome" in taken else F.col("detail").isNotNull()
    reason = F.coalesce(F.col("detail.outcome"), F.lit("missing")) if "outcome" in taken else F.lit("missing")
    return joined.where(ok), joined.where(~ok).withColumn("reason", reason).drop("detail")


def merge_metadata(messages: DataFrame, metadata: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Every value of ``columns`` that is known in ``metadata`` replaces the stored one."""
    fresh = metadata.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = messages.join(fresh, keys, "left")
    have = set(messages.columns)
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in messages.columns), *(F.col(f"__{c}").alias(c) for c in columns if c not in have))


def member_header(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with the attributes of their group; a member of an unknown group stays."""
    header = groups.select(F.col("id").alias("group_id"), F.col("name").alias("group_name"), F.col("thumbnail").alias("group_thumbnail"))
    return members.join(header, "group_id", "left")


def latest_name(members: DataFrame, ts: str = "seen_at") -> DataFrame:
    """K7: identity is the id; the name is the latest one seen."""
    return members.groupBy("group_id", "member_id").agg(F.max_by("name", ts).alias("name"))

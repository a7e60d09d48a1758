"""Filters and projections on groups, members, messages and posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def group_visible(state: Column, subscription: Column, include_inactive: bool = False) -> Column:
    """Closed groups always; else active subscriptions, or any at all."""
    wanted = subscription.isNotNull() if include_inactive else F.coalesce(subscription == "active", F.lit(False))
    return F.coalesce(state == "closed", F.lit(False)) | wanted


def of_member(messages: DataFrame, member_id: int) -> DataFrame:
    """The messages of one member."""
    return messages.where(F.col("member_id") == member_id)


def active_member(code: Column, name: Column, graduation: Column, excluded: tuple[str, ...] = ("46", "10001")) -> Column:
    """P5: current members of the JSONP list, group accounts aside."""
    filled = (F.coalesce(code, F.lit("")) != "") & (F.coalesce(name, F.lit("")) != "")
    return filled & F.coalesce(graduation == "NO", F.lit(False)) & ~code.isin(*excluded)


def same_author(author: Column, expected: Column) -> Column:
    """Names equal without ASCII and ideographic spaces; an empty name matches any."""
    a, b = (F.translate(F.coalesce(x, F.lit("")), " 　", "") for x in (author, expected))
    empty = (F.coalesce(author, F.lit("")) == "") | (F.coalesce(expected, F.lit("")) == "")
    return empty | (a == b)


def no_group_account(name: Column, accounts: tuple[str, ...]) -> Column:
    """Not one of the accounts that stand for a whole group."""
    return ~name.isin(*accounts) if accounts else F.lit(True)


def not_empty(kind: Column, content: Column, media_url: Column) -> Column:
    """A text message needs content or media; white space is content."""
    return ~((kind == "text") & (F.coalesce(content, F.lit("")) == "") & (F.coalesce(media_url, F.lit("")) == ""))


def filled(*columns: Column) -> Column:
    """None of the values is null or empty."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.coalesce(c, F.lit("")) != "")
    return out


def normalize(messages: DataFrame) -> DataFrame:
    """P10: raw messages as stored ones; rows without id keep a null id for ``split_rejects``.

    Where the message's JSON text is there (``raw``), a missing flag and one that is null are told apart (F18).
    """
    media = S.first_filled("file", "thumbnail")
    passed = [c for c in ("group_id", "member_id", "page", "pos") if c in messages.columns]
    return messages.select(
        *passed,
        "id",
        F.col("published_at").alias("timestamp"),
        S.message_type("type").alias("type"),
        (S.favorite_in(F.try_parse_json("raw")) if "raw" in messages.columns else S.favorite("is_favorite")).alias("is_favorite"),
        F.col("text").alias("content"),
        F.col("type").alias("raw_type"),
        media.alias("media_url"),
    )


def split_rejects(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T4: (good rows, rows without id with their reason)."""
    return messages.where("id is not null"), messages.where("id is null").withColumn("reason", F.lit("missing id"))


def route(status: Column) -> Column:
    """Ok, gone or error by HTTP status."""
    return F.when(status.isin(404, 410), "gone").when(status == 200, "ok").otherwise("error")

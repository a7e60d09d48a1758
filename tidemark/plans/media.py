"""The media pass: what is missing, and measures merged back (3 steps of J1, U1, J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import media_queue, merge_metadata
from tidemark.sources import media


def outstanding(messages: DataFrame, spark: SparkSession, root: str, member_dir: Column) -> DataFrame:
    """Media that no file below ``root`` holds yet; planned anew from the stored messages each time."""
    present = media.listing(spark, root).where("length > 0")
    relative = F.regexp_replace("path", r"^.*?/(messages/.*)$", "$1")
    return media_queue(messages, present.select(relative.alias("path")), member_dir)


def measured(messages: DataFrame, spark: SparkSession, root: str, member_dir: Column) -> DataFrame:
    """``messages`` with the sizes that the files' headers state."""
    found = media.probe(spark, root).withColumn("path", F.regexp_replace("path", r"^.*?/(messages/.*)$", "$1"))
    keyed = media_queue(messages, found.limit(0), member_dir).select("group_id", "member_id", "id", "path")  # the files' own kinds say what they have
    sizes = keyed.join(found, "path").select("group_id", "member_id", "id", "width", "height", "media_duration", "is_muted")
    return merge_metadata(messages, sizes, ["group_id", "member_id", "id"], ["width", "height", "media_duration", "is_muted"])

"""JSONP responses of site B (S18-S21, H5), parsed natively.

Input rows are (page, value) with the whole response in ``value``.  Responses
that are no call of the callback, or hold no JSON, are rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.dedup import first_wins, with_main_image
from tidemark.operators.filters import active_member
from tidemark.operators.order import reading_order
from tidemark.sinks.shared import whole_files
from tidemark.sources import schemas


def responses(spark: SparkSession, path: str) -> DataFrame:
    """(page, value) of landed response files."""
    return whole_files(spark, path).select(F.col("_metadata.file_path").alias("page"), "value")


def parse(rows: DataFrame, item: T.StructType, callback: str = "res") -> tuple[DataFrame, DataFrame]:
    """(items with page and pos, rejected responses with their reason)."""
    envelope = T.StructType([T.StructField("data", T.ArrayType(item)), T.StructField("_corrupt", T.StringType())])
    body = S.jsonp_body("value", callback)
    parsed = rows.withColumn("body", body).withColumn("parsed", F.from_json("body", envelope, {"columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull()
    good = parsed.where(~broken).select("page", F.posexplode("parsed.data").alias("pos", "item")).select("item.*", "page", "pos")
    reason = F.when(F.col("body").isNull(), "not a callback").otherwise("not JSON")
    return good, parsed.where(broken).select("page", "value", reason.alias("reason"))


def members(rows: DataFrame, base: str) -> DataFrame:
    """Active members (id, name, thumbnail_url), group accounts aside."""
    found, _ = parse(rows, schemas.JSONP_MEMBER)
    kept = found.where(active_member(F.col("code"), F.col("name"), F.col("graduation")))
    return kept.select(F.col("code").alias("id"), "name", S.normalize_url("img", base).alias("thumbnail_url"), "page", "pos")


def blogs(rows: DataFrame, base: str, content: bool = True) -> DataFrame:
    """Posts in page order, each id once, first wins; without ``content`` only the main image is read."""
    found, _ = parse(rows, schemas.JSONP_BLOG)
    main = S.normalize_url("img", base)
    inner = S.image_sources("text", base) if content else F.array().cast("array<string>")
    posts = found.where(F.coalesce("code", F.lit("")) != "").select(
        F.col("code").alias("id"),
        F.coalesce("title", F.lit("")).alias("title"),
        (S.normalize_html_urls(F.coalesce("text", F.lit("")), base) if content else F.lit("")).alias("content"),
        S.site_datetime("date").alias("published_at"),
        F.col("date").alias("date_text"),
        F.coalesce("link", F.lit("")).alias("url"),
        with_main_image(main, inner).alias("images"),
        F.coalesce("arti_code", F.lit("")).alias("member_id"),
        F.coalesce("name", F.lit("")).alias("member_name"),
        "page",
        "pos",
    )
    return first_wins(posts, ["id"], reading_order())


def detail(rows: DataFrame, base: str, blog_id: str) -> DataFrame:
    """The post of one id, no row if there is none; the id is filtered before anything is extracted."""
    return blogs(rows.where(F.contains("value", F.lit(blog_id))), base).where(F.col("id") == blog_id).limit(1)

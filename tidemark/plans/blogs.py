"""Post archives: list pages, their details, and the stopping rule."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.cursor import older_than, take_while
from tidemark.operators.joins import list_to_detail
from tidemark.operators.order import reading_order
from tidemark.sinks.shared import new_folder
from tidemark.sources import html, jsonp
from tidemark.sources.html import Site


def _until(posts: DataFrame, since: datetime.datetime | None) -> DataFrame:
    if since is None:
        return posts
    stop = older_than(F.col("published_at"), F.lit(since), S.date_only("date_text"))
    return take_while(posts.withColumn("__all", F.lit(0)), ["__all"], reading_order(), stop).drop("__all")


def _staged(posts: DataFrame) -> DataFrame:
    path = new_folder(posts.sparkSession, "listed")
    posts.write.parquet(path)
    return posts.sparkSession.read.schema(posts.schema).parquet(path)


def metadata(lists: DataFrame, where: Site, since: datetime.datetime | None = None, author: str | None = None, max_pages: int | None = None) -> DataFrame:
    """Posts of list pages without content, up to the first that is older than ``since``."""
    return _until(html.blog_list(lists, where, author, max_pages), since)


def full(lists: DataFrame, details: DataFrame | None, where: Site, since: datetime.datetime | None = None, author: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(posts with content, rejected posts with their reason).

    Site B's lists have the content.  For the others, ``details`` are landed
    detail pages (id, status, html): removed and failed ones are rejects and stop
    nothing, and the stopping rule is applied to the list's dates and then to the
    details' exact ones.  The listed posts are written to the shared folder first,
    so that both results take the list pages apart once; rejects need no detail page.
    """
    if where.name == "B":
        posts = _until(jsonp.blogs(lists.withColumnRenamed("html", "value"), where.base), since)
        return posts, posts.limit(0).select("id", F.lit("").alias("reason"))
    listed = _staged(metadata(lists, where, since, author))
    found, _ = list_to_detail(listed, html.blog_details(details, where))
    _, rejects = list_to_detail(listed.select("id"), html.outcomes(details))
    exact = found.withColumns({c: F.coalesce(f"detail.{c}", c) for c in ("published_at", "date_text")})
    text = lambda c: F.coalesce(F.nullif(F.col(f"detail.{c}"), F.lit("")), F.col(c))
    shaped = exact.withColumns({"title": text("title"), "content": F.col("detail.content"), "images": F.when(F.size("detail.images") > 0, F.col("detail.images")).otherwise(F.col("images")), "member_id": text("member_id"), "member_name": text("member_name")})
    return _until(shaped.drop("detail"), since), rejects.select("id", "reason")

"""The order in which landed pages were answered (O1, O3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.shared import new_folder

_DIGITS = 20


def natural(path: str = "page") -> Column:
    """``path`` with every number filled up with zeros, so that page-2 comes before page-10; longer numbers stay as they are."""
    filled = F.regexp_replace(F.col(path), r"(\d+)", "0" * _DIGITS + "$1")
    return F.regexp_replace(filled, rf"0+(\d{{{_DIGITS}}})(?!\d)", "$1")


def reading_order(page: str = "page", pos: str = "pos") -> list[Column]:
    """By the numbers in the page's name, pages of equal ones by name, and by place in the page."""
    return [natural(page).alias("__page_number"), F.col(page), F.col(pos)]


def places(rows: DataFrame) -> DataFrame:
    """(page, __place): the pages of ``rows``, numbered in reading order.

    A name is taken apart once a page, not once a row, and rows that are joined with
    this carry a number in its place.  It is written, so that Spark knows its size.
    """
    path = new_folder(rows.sparkSession, "places")
    pages = rows.select("page").where("page is not null").distinct().orderBy(*reading_order()[:2])
    pages.select("page", F.monotonically_increasing_id().alias("__place")).write.parquet(path)  # tasks of a sort are in its order
    return rows.sparkSession.read.schema("page string, __place long").parquet(path)

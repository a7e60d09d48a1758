"""Member statistics (A1-A4, A7-A9) and the stored order of messages (O2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.operators.order import reading_order
from tidemark.sinks.shared import new_folder

# The counted types, in the order of the stored document.
COUNTED = ("text", "video", "picture", "voice")


def type_counts(kind: Column) -> list[Column]:
    """A1: one count for each type; a missing type counts as text, unknown ones nowhere."""
    known = F.coalesce(kind, F.lit("text"))
    return [F.count_if(known == t).alias(f"n_{t}") for t in COUNTED]


def member_report(messages: DataFrame, keys: list[str], kind: str = "type", ts: str = "timestamp", message_id: str = "id") -> DataFrame:
    """A1-A4 in one pass: counts by type, total, greatest id (0 if none) and newest instant."""
    return messages.groupBy(*keys).agg(*type_counts(F.col(kind)), F.count("*").alias("total_messages"), F.coalesce(F.max(message_id), F.lit(0)).alias("last_message_id"), F.max(ts).alias("last_sync_ts"))


def observed(messages: DataFrame, name: str, ok: Column | None = None) -> tuple[DataFrame, Observation]:
    """Counts of rows and of successes, gathered while ``messages`` is written."""
    seen = Observation(name)
    return messages.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(F.lit(True) if ok is None else ok).alias("completed")), seen


def page_progress(messages: DataFrame, page: str = "page", message_id: str = "id", ts: str = "timestamp", pos: str = "pos") -> DataFrame:
    """(page, seen, oldest): how many messages were met by the end of each page, and the instant of its last one.

    Messages are combined to one row a page first.  Pages count in the order of
    the numbers in their names.  Their sums are added up in two steps: within
    ranges of pages, each in a task of its own, and over the totals of the ranges,
    of which there are as many as shuffle partitions.  The ranges are written to
    the shared folder, so that a repeated task finds the same ones.
    """
    place = F.struct(*reading_order(page, page)[:2])
    first = messages.groupBy(message_id).agg(F.min(place).alias("__first")).groupBy(F.col(f"__first.{page}").alias(page)).agg(F.count("*").alias("new"))
    pages = messages.groupBy(page).agg(F.max_by(ts, pos).alias("oldest")).join(first, page, "left").withColumn("new", F.coalesce("new", F.lit(0)))
    order = [c.alias(n) for c, n in zip(reading_order(page, page)[:2], ("__number", "__name"), strict=True)]
    ranged = pages.select("*", *order).repartitionByRange("__number", "__name").withColumn("__range", F.spark_partition_id())
    path = new_folder(messages.sparkSession, "page-progress")
    ranged.write.parquet(path)
    ranged = messages.sparkSession.read.schema(ranged.schema).parquet(path)
    totals = ranged.groupBy("__range").agg(F.sum("new").alias("n")).agg(F.collect_list(F.struct("__range", "n")).alias("all"))
    earlier = lambda x: F.aggregate(F.filter("all", lambda y: y["__range"] < x["__range"]), F.lit(0).cast("long"), lambda n, y: n + y["n"])
    before = totals.select(F.explode(F.transform("all", lambda x: F.struct(x["__range"].alias("__range"), earlier(x).alias("__before")))).alias("x")).select("x.*")
    within = F.sum("new").over(Window.partitionBy("__range").orderBy("__number", "__name").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("__within", within).join(before, "__range").select(page, (F.col("__within") + F.col("__before")).alias("seen"), "oldest")


def first_image(images: Column) -> Column:
    """The first image or null."""
    return F.get(images, F.lit(0))


def stored_order(ts: Column, origin: Column, position: Column) -> list[Column]:
    """O2: by instant, missing ones first; ties by where the id was first seen, existing rows before new ones."""
    return [ts.asc_nulls_first(), origin.asc(), position.asc()]

"""The export of one JSON document for each member (K2, K5, K7).

A document has the member's header, counts by type and the messages in stored
order.  Its folder is ``group=<id>/member=<id>``: identity is the id, names are
content, so a renamed group keeps its place; ``folder`` gives the readable path.

``documents`` gives them as rows.  ``export`` writes them without holding any: the
messages are dealt by ranges of (member, instant, id), so one member's may fill
many tasks, and written as fragments, of which documents are stitched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.stats import COUNTED, type_counts
from tidemark.sinks import fragments
from tidemark.sinks.shared import new_folder
from tidemark.sources import schemas
from tidemark.sources.files import filesystem


def folder(group_id: Column, group_name: Column, member_id: Column, member_name: Column) -> Column:
    """``messages/<group id> <group name>/<member id> <member name>`` with safe names."""
    part = lambda number, name: S.strip(F.concat_ws(" ", number.cast("string"), S.sanitize_name(F.coalesce(name, F.lit("")))))
    return F.concat_ws("/", F.lit("messages"), part(group_id, group_name), part(member_id, member_name))


_SHOWN = [f.name for f in schemas.NORMALIZED.fields] + [f.name for f in schemas.MEDIA.fields]
_MEMBER = ("id", "name", "group_id", "group_name", "portrait", "thumbnail", "phone_image", "group_thumbnail")


def _headed(counted: DataFrame, headers: DataFrame, now: Column, *more: str) -> DataFrame:
    """Counts of members as the head of their documents, and the columns ``more``."""
    named = headers.select("group_id", F.col("id").alias("member_id"), F.struct(*_MEMBER).alias("member"))
    joined = counted.join(named, ["group_id", "member_id"], "left")
    return joined.select("group_id", "member_id", S.export_clock(now).alias("exported_at"), "member", "total_messages", F.struct(*(F.col(f"n_{t}").alias(t) for t in COUNTED)).alias("message_type_counts"), *more)


def documents(messages: DataFrame, headers: DataFrame, now: Column) -> DataFrame:
    """K2: one row per member with the nested document; ``headers`` comes from ``member_header``."""
    item = F.struct(F.coalesce("timestamp", F.lit("")).alias("__ts"), F.col("id").alias("__id"), F.struct(*_SHOWN).alias("m"))
    counts = type_counts(F.col("type"))
    grouped = messages.groupBy("group_id", "member_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["m"]).alias("messages"), F.count("*").alias("total_messages"), *counts)
    return _headed(grouped, headers, now, "messages")


def export(messages: DataFrame, headers: DataFrame, path: str, now: Column) -> None:
    """Write the documents as JSON, one folder for each member, in place of what ``path`` holds."""
    spark, root = messages.sparkSession, new_folder(messages.sparkSession, "fragments")
    spark.dataSource.register(fragments.Fragments)
    rows = messages.where("group_id is not null and member_id is not null").select("group_id", "member_id", F.coalesce("timestamp", F.lit("")).alias("ts"), "id", F.to_json(F.struct(*_SHOWN)).alias("json"))
    order = ["group_id", "member_id", "ts", "id", "json"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("group_id", "member_id", "json").write.format("fragments").mode("append").option("path", root).save()
    counted = messages.groupBy("group_id", "member_id").agg(F.count("*").alias("total_messages"), *type_counts(F.col("type")))
    head = F.to_json(F.struct("exported_at", "member", "total_messages", "message_type_counts"))
    heads = _headed(counted, headers, now).select("group_id", "member_id", F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"messages":[')).alias("head"))
    system, target = filesystem(path)
    system.create_dir(target, recursive=True)
    system.delete_dir_contents(target)
    fragments.stitch(heads, root, path, "]}\n").write.format("noop").mode("overwrite").save()

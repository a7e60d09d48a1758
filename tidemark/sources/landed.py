"""Landed API responses.

A response is one JSON file: an envelope whose key holds a list, a bare list, or
one object.  Items are kept as their JSON text in ``raw`` beside the declared
fields, so no field is lost and nothing is inferred; ``variants`` gives items as
VARIANT instead.  Files that are no JSON, or
lack the envelope, give no rows; ``corrupt`` lists the former.  Rows carry
(page, pos); pages are read in the order of the numbers in their names
(``reading_order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import last_wins
from tidemark.operators.filters import group_visible
from tidemark.operators.order import reading_order
from tidemark.sinks.shared import tasks_for, whole_files
from tidemark.sources import schemas


TASK_BYTES = 8 << 20  # of page files, for a task that compares their items


def _bytes(spark: SparkSession, path: str) -> int:
    """The length of all files below ``path``, or of those that it matches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(system.getContentSummary(x.getPath()).getLength() for x in system.globStatus(target) or ())


def _files(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = whole_files(spark, path)
    parsed = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return rows.select(F.col("_metadata.file_path").alias("page"), parsed.alias("file")).select("file.*", "page")


def corrupt(spark: SparkSession, path: str) -> DataFrame:
    """(page) of the files that are not JSON."""
    return _files(spark, path, T.StructType([T.StructField("none", T.StringType())])).where("_corrupt is not null").select("page").distinct()


def items(spark: SparkSession, path: str | list[str], key: str, item: T.StructType) -> DataFrame:
    """The items of the envelope ``key``, one row each: fields of ``item``, raw, page, pos."""
    envelope = T.StructType([T.StructField(key, T.ArrayType(T.StringType()))])
    rows = _files(spark, path, envelope).select("page", F.posexplode(key).alias("pos", "raw"))
    return _parsed(rows, item)


def bare_list(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """The items of files that hold a list, or one object."""
    rows = whole_files(spark, path).withColumn("page", F.col("_metadata.file_path"))
    whole = F.trim("value")
    parsed = F.from_json(F.when(F.startswith(whole, F.lit("[")), whole).otherwise(F.concat(F.lit("["), whole, F.lit("]"))), T.ArrayType(T.StringType()))
    return _parsed(rows.select("page", F.posexplode(parsed).alias("pos", "raw")), item)


def _parsed(rows: DataFrame, item: T.StructType) -> DataFrame:
    if not item.fields:
        return rows.select("raw", "page", "pos")
    return rows.withColumn("item", F.from_json("raw", item)).select("item.*", "raw", "page", "pos")


def variants(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(item, page, pos): the items of an envelope as VARIANT.

    Every field keeps the type that the response gave it, also those no schema
    names, and one that is missing differs from one that is null
    (``try_variant_get`` gives null for the former, a variant null for the latter).
    """
    return items(spark, path, key, schemas.EMPTY).select(F.try_parse_json("raw").alias("item"), "page", "pos")


def timeline(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a folder of page files, each id once, the page read last winning.

    Ids are dealt out to a number of tasks that grows with the files, so that what one task sorts does not.
    """
    rows = items(spark, path, "messages", schemas.MESSAGE)
    return last_wins(rows.repartition(tasks_for(spark, _bytes(spark, path), TASK_BYTES), "id"), ["id"], reading_order())


def past_messages(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return items(spark, path, "messages", schemas.MESSAGE)


def groups(spark: SparkSession, path: str, include_inactive: bool = False) -> DataFrame:
    """Visible groups."""
    return bare_list(spark, path, schemas.GROUP).where(group_visible(F.col("state"), F.col("subscription.state"), include_inactive))


def members(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return bare_list(spark, path, schemas.MEMBER)


def _field(name: str) -> Column:
    return F.get_json_object("raw", f"$.{name}")


def letters(spark: SparkSession, path: str, updated_from: str | None = None, count: int = 200) -> DataFrame:
    """The first ``count`` letters, updated at ``updated_from`` or later where that is given."""
    rows = items(spark, path, "letters", schemas.EMPTY)
    if updated_from is not None:
        rows = rows.where(F.try_to_timestamp(_field("updated_at")) >= F.try_to_timestamp(F.lit(updated_from)))
    return rows.orderBy(*reading_order()).limit(count)


def news(spark: SparkSession, path: str, count: int = 20) -> DataFrame:
    """S7."""
    return items(spark, path, "announcements", schemas.EMPTY).orderBy(*reading_order()).limit(count)


def tags(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return items(spark, path, "tags", schemas.EMPTY)


def fc_contents(spark: SparkSession, path: str, organization_id: int = 1) -> DataFrame:
    """Contents of one organization."""
    return items(spark, path, "contents", schemas.EMPTY).where(_field("organization_id").try_cast("long") == organization_id)


def organizations(spark: SparkSession, path: str) -> DataFrame:
    """S10."""
    return items(spark, path, "organizations", schemas.EMPTY)


def products(spark: SparkSession, path: str, product_type: str | None = None) -> DataFrame:
    """Products, of one type where that is given."""
    rows = items(spark, path, "products", schemas.EMPTY)
    return rows if product_type is None else rows.where(_field("type") == product_type)


def single(spark: SparkSession, path: str) -> DataFrame:
    """Profile, account, member or subscription streak: no row or one, the first in page order."""
    return bare_list(spark, path, schemas.EMPTY).orderBy(*reading_order()).limit(1)


def documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(stored member documents, pages of those that are corrupt)."""
    rows = _files(spark, path, schemas.DOCUMENT)
    return rows.where("_corrupt is null and member is not null").drop("_corrupt"), rows.where("_corrupt is not null").select("page").distinct()


def sync_state(spark: SparkSession, path: str) -> DataFrame:
    """The state file ``{"<group>_<member>": {...}}`` as rows; a missing or corrupt file gives none."""
    entry = "struct<last_message_id:bigint,last_sync_ts:string,total_messages:bigint,last_sync:string>"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schemas.STATE)
    rows = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("key", "state"))
    ids = F.split("key", "_")
    return rows.select(F.get(ids, F.lit(0)).try_cast("long").alias("group_id"), F.get(ids, F.lit(1)).try_cast("long").alias("member_id"), "state.*")

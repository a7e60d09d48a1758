"""Resumable scans of landed timelines, newest page first.

A timeline lies in files ``group=<id>/page=<n>/...``, page 0 the newest, as its
requests were answered.  Beside the pages lies their *zone map* (``_zones``): for
each page the newest and the oldest instant in it.  It is written once, when pages
land, and decides which pages have to be opened at all.

``stream`` reads a scan by a data source with offsets of its own.  The offset of a
group is the number of the next page (``page``) and the file it lies in
(``continuation``), or that it is ``done``.  A batch takes up to ``pages_per_batch``
pages a group and ends a group's scan behind the first page whose oldest instant
is at or before the group's cursor; pages behind that are never opened.  The end of
every planned batch is kept in a small ``position`` file, from which a stopped scan
goes on: Spark logs a batch's offsets before it plans it, so no page is skipped, and
a page is read again only if its batch failed.

``pages_until`` is the same decision for batch readers: the pages of each key up to
the stop, and at most ``max_pages`` of them.

The driver holds the list of page files and the zone map (a row a page), as it
does for Spark's own file sources, and no content.
"""

from __future__ import annotations

import datetime
import json
import re

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.order import natural
from tidemark.sources import landed, schemas
from tidemark.sources.files import files_below, filesystem, read_text, shown, write_bytes

ZONES, FILES = "_zones", 20  # files of one task
SCHEMA = "group_id long, page string, pos int, raw string"
_PLACE = re.compile(r"group=(-?\d+)/page=(\d+)/")


def write_zones(messages: DataFrame, path: str, ts: str = "published_at") -> None:
    """The zone map of landed pages, from (group_id, page number, ``ts``) of their messages: one row a page."""
    at = F.col(ts) if dict(messages.dtypes)[ts].startswith("timestamp") else F.try_to_timestamp(ts)
    zones = messages.groupBy("group_id", F.col("page").cast("long").alias("page")).agg(F.unix_micros(F.max(at)).alias("newest"), F.unix_micros(F.min(at)).alias("oldest"), F.count("*").alias("rows"))
    zones.write.mode("overwrite").parquet(f"{path}/{ZONES}")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """(group_id, page, newest, oldest, rows), instants as timestamps."""
    rows = spark.read.schema("group_id long, page long, newest long, oldest long, rows long").parquet(f"{path}/{ZONES}")
    return rows.withColumns({c: F.timestamp_micros(c) for c in ("newest", "oldest")})


def pages_until(pages: DataFrame, keys: list[str], stop: Column, max_pages: int | None = None, page: str = "page") -> DataFrame:
    """Of one row a page, those of each key up to and with the first, in page order, for which ``stop`` holds, and no more than ``max_pages``.

    The first stop of a key is an aggregate; only a page cap ranks a key's pages, which are as many as its files.
    """
    number = F.col(page) if dict(pages.dtypes)[page] in ("int", "bigint") else natural(page)
    placed = pages.withColumn("__number", number)
    stops = placed.where(F.coalesce(stop, F.lit(False))).groupBy(*keys).agg(F.min("__number").alias("__stop"))
    read = (placed.join(stops, keys, "left") if keys else placed.join(stops)).where(F.col("__stop").isNull() | (F.col("__number") <= F.col("__stop")))
    if max_pages is not None:
        first = read.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_set("__number")), 1, max_pages).alias("__first"))
        read = (read.join(first, keys) if keys else read.join(first)).where(F.array_contains("__first", F.col("__number")))
    return read.select(pages.columns)


def read_pages(spark: SparkSession, path: str, pages: DataFrame) -> DataFrame:
    """(group_id, message fields, raw, page, pos) of the pages (group_id, page) alone; no other file is opened."""
    folders = sorted(f"{path}/group={r['group_id']}/page={r['page']}" for r in pages.select("group_id", "page").distinct().collect())
    if not folders:
        return spark.createDataFrame([], schemas.MESSAGE).selectExpr("cast(null as long) as group_id", "*", "'' as raw", "'' as page", "0 as pos")
    group = F.regexp_extract("page", r"/group=(-?\d+)/", 1).cast("long")
    return landed.items(spark, folders, "messages", schemas.MESSAGE).select(group.alias("group_id"), "*")


class _Pages(InputPartition):
    def __init__(self, group: int, files: list[str]):
        self.group, self.files = group, files


class TimelineScan(DataSource):
    """``SCHEMA`` of a landed timeline as a stream; options ``path``, ``position``, ``pagesPerBatch`` and ``cursors`` (JSON: instant by group)."""

    @classmethod
    def name(cls) -> str:
        return "timeline_scan"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Scan(self.options)


class _Scan(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.position = options["path"], options["position"]
        self.per_batch = int(options.get("pagesPerBatch", 100))
        self.cursors = {int(g): _micros(t) for g, t in json.loads(options.get("cursors", "{}")).items()}

    def _files(self) -> dict[int, list[list[str]]]:
        """The page files of each group, newest page first, up to the page behind which its scan ends."""
        found: dict[int, dict[int, list[str]]] = {}
        for path, _ in files_below(self.path):
            place = _PLACE.search(path)
            if place:
                found.setdefault(int(place[1]), {}).setdefault(int(place[2]), []).append(path)
        oldest = self._oldest() if self.cursors else {}
        out = {}
        for group, pages in found.items():
            kept = []
            for number in sorted(pages):
                kept.append(pages[number])
                at = oldest.get((group, number))
                if at is not None and group in self.cursors and at <= self.cursors[group]:
                    break
            out[group] = kept
        return out

    def _oldest(self) -> dict[tuple[int, int], int]:
        system, path = filesystem(f"{self.path}/{ZONES}")
        rows = pq.read_table(path, filesystem=system, columns=["group_id", "page", "oldest"])
        return {(g, p): at for g, p, at in zip(*(c.to_pylist() for c in rows.columns), strict=True)}

    def _offset(self, taken: dict[int, int], files: dict[int, list[list[str]]]) -> dict:
        """Offsets by group: the next page, and where it lies."""
        out = {}
        for group, pages in files.items():
            n = min(taken.get(group, 0), len(pages))
            out[str(group)] = {"page": n, "continuation": shown(self.path, pages[n][0]) if n < len(pages) else "", "done": n == len(pages)}
        return out

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files = self._files()
        taken = {int(g): x["page"] for g, x in json.loads(read_text(self.position) or "{}").items()}
        return self._offset({g: taken.get(g, 0) + self.per_batch for g in files}, files)

    def partitions(self, start: dict, end: dict) -> list[_Pages]:
        write_bytes(self.position, json.dumps(end).encode())
        files = self._files()
        out = []
        for group, to in end.items():
            since = start.get(group, {}).get("page", 0)
            taken = [f for page in files.get(int(group), [])[since : to["page"]] for f in page]
            out += [_Pages(int(group), taken[k : k + FILES]) for k in range(0, len(taken), FILES)]
        return out

    def read(self, partition: _Pages):
        system = filesystem(self.path)[0]
        for path in partition.files:
            with system.open_input_file(path) as f:
                items = _messages(f.read())
            columns = [[partition.group] * len(items), [shown(self.path, path)] * len(items), list(range(len(items))), items]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["group_id", "page", "pos", "raw"])

    def commit(self, end: dict) -> None:
        """Nothing: the position is kept when a batch is planned."""


def _messages(raw: bytes) -> list[str]:
    """The messages of a page as JSON texts; none of a page that is no envelope."""
    try:
        items = json.loads(raw).get("messages")
    except (ValueError, AttributeError):
        return []
    return [json.dumps(x, ensure_ascii=False) for x in items] if isinstance(items, list) else []


def _micros(text: str) -> int:
    at = datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))
    at = at if at.tzinfo else at.replace(tzinfo=datetime.UTC)
    return (at - datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC)) // datetime.timedelta(microseconds=1)


def stream(spark: SparkSession, path: str, position: str, cursors: dict[int, str] | None = None, pages_per_batch: int = 100) -> DataFrame:
    """(group_id, message fields, raw, page, pos) of a landed timeline, ``pages_per_batch`` pages a group at a time.

    With ``availableNow`` a run takes one batch; a query that stays up takes all.
    ``position`` is a file that all runs of one scan name, a new one starts anew.
    """
    spark.dataSource.register(TimelineScan)
    wanted = {"path": path, "position": position, "pagesPerBatch": str(pages_per_batch), "cursors": json.dumps({str(g): t for g, t in (cursors or {}).items()})}
    rows = spark.readStream.format("timeline_scan").options(**wanted).load()
    return rows.withColumn("item", F.from_json("raw", schemas.MESSAGE)).select("group_id", "item.*", "raw", "page", "pos")

"""Sync as a stream of landed page files.

The file source's checkpoint stands for the continuation token: a page file is
read once, a restart goes on where the last commit ended, and a batch that is
replayed changes nothing, since the merge is idempotent.  There is no watermark:
a cursor may be held back by a reject, and rows at the cursor's own instant must
come through, which a watermark forbids.

A run may take several micro-batches, but merges once: a merge reads and writes the
whole buckets of its members, so one for each micro-batch would cost the square of
the files.  The micro-batches only write their rows to ``<checkpoint>/staged``.  When
the stream has ended, all that is staged is merged as one batch; then the number of
the last one is kept in ``<checkpoint>/merged``, and the staged rows are removed.
What a run that failed has staged, the next one merges with its own.

Rows are held against the cursors that stood when their run began, also where a
later run merges them.  ``start`` keeps these cursors in ``<checkpoint>/runs``, with
a mark whose time is the run's; a file belongs to the first run that began after it
was landed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cursor import KEYS
from tidemark.plans.sync import sync
from tidemark.sinks.store import Store
from tidemark.sources import schemas


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(group_id, message fields, page, pos) from files ``<path>/group=<id>/*.json``."""
    return _page_stream(spark, path, files_per_batch).drop("__landed_at")


def _page_stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """``page_stream`` with the time at which the page was landed, in milliseconds."""
    envelope = T.StructType([T.StructField("messages", T.ArrayType(schemas.MESSAGE)), T.StructField("continuation", T.StringType())])
    files = spark.readStream.schema(envelope).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).json(path)
    group = F.regexp_extract("_metadata.file_path", r"/group=(\d+)/", 1).try_cast("long")
    landed_at = F.unix_millis("_metadata.file_modification_time").alias("__landed_at")
    return files.select(group.alias("group_id"), F.col("_metadata.file_path").alias("page"), landed_at, F.posexplode("messages").alias("pos", "message")).select("group_id", "message.*", "page", "pos", "__landed_at")


class _Folder:
    """What a checkpoint holds beside what Spark keeps there."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.path = checkpoint.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def mark(self, place: str) -> None:
        self._fs.create(self._hadoop(f"{self.path}/{place}"), True).close()

    def found(self, place: str) -> list[tuple[int, str]]:
        """(time, name) of what lies there."""
        path = self._hadoop(f"{self.path}/{place}")
        return [(x.getModificationTime(), x.getPath().getName()) for x in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def remove(self, place: str) -> None:
        self._fs.delete(self._hadoop(f"{self.path}/{place}"), True)


def _begin(store: Store, folder: _Folder) -> list[tuple[int, str]]:
    """Keep the cursors that stand now as those of a new run; (time, folder) of this and all earlier runs."""
    name = uuid.uuid4().hex
    store.state().select(*KEYS, "last_sync_ts").write.parquet(f"{folder.path}/runs/{name}/cursors")
    folder.mark(f"runs/{name}.mark")
    return sorted((at, f"{folder.path}/runs/{mark.removesuffix('.mark')}/cursors") for at, mark in folder.found("runs") if mark.endswith(".mark"))


def _cursors(runs: list[tuple[int, str]]) -> Callable[[DataFrame], DataFrame]:
    """The cursors of the runs that a batch has files of."""

    def of(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        wanted = {r["__run"] for r in batch.select("__run").distinct().collect()}
        out = spark.createDataFrame([], "group_id long, member_id long, last_sync_ts string, __run long")
        for at, path in runs:
            if at in wanted:
                out = out.unionByName(spark.read.schema("group_id long, member_id long, last_sync_ts string").parquet(path).withColumn("__run", F.lit(at).cast("long")))
        return out

    return of


def _merge(store: Store, folder: _Folder, runs: list[tuple[int, str]], schema: T.StructType) -> None:
    """One sync of all batches that are staged and not merged yet."""
    done = max((int(name) for _, name in folder.found("merged")), default=-1)
    waiting = sorted(n for n in (int(name.removeprefix("batch=")) for _, name in folder.found("staged")) if n > done)
    if waiting:
        rows = store.spark.read.schema(schema).parquet(*(f"{folder.path}/staged/batch={n}" for n in waiting))
        times = F.lit([at for at, _ in runs]).cast("array<long>")
        run = F.coalesce(F.array_min(F.filter(times, lambda at: at >= F.col("__landed_at"))), F.lit(runs[-1][0]))
        sync(store, rows.withColumn("__run", run.cast("long")).drop("__landed_at"), cursors=_cursors(runs), staged=True)
        folder.mark(f"merged/{waiting[-1]}")
    folder.remove("staged")


def start(spark: SparkSession, path: str, store_path: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Sync all files that are there, and return the stream that read them, ended; run it again for later ones."""
    store, folder = Store(spark, store_path), _Folder(spark, checkpoint)
    runs, pages = _begin(store, folder), _page_stream(spark, path, files_per_batch)

    def stage(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder.path}/staged/batch={number}")  # a replay replaces its own

    query = pages.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    _merge(store, folder, runs, pages.schema)
    return query

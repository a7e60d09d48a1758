"""The folder that all executors share, for files that one job writes and another reads."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import filesystem

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset and driver and executors are one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tidemark-landed/{name}-{uuid.uuid4().hex}"


ROWS = 250_000  # that one task deals with


def tasks_for(spark: SparkSession, rows: int, per_task: int = ROWS) -> int:
    """A number of tasks that grows with the rows, so that what one task holds does not."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / per_task))


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@contextlib.contextmanager
def many_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run in here read small splits, and shuffle into ``tasks_for`` partitions, which are not put together by their compressed size."""
    if rows <= ROWS:
        yield
        return
    settings = {"spark.sql.shuffle.partitions": str(tasks_for(spark, rows)), "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "8m"}
    with _settings(spark, settings):
        yield


def few_listings(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Files are listed in here by four tasks a core; Spark starts one for each folder or file, up to 10,000, and starting them takes longer than the listing."""
    return _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)})


def whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value): the text of every file below ``path``; they are listed here, once."""
    with few_listings(spark):
        return spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)


def by_page(rows: DataFrame, per_task: int = 100_000) -> DataFrame:
    """``rows`` (page, ...) dealt out by page to a number of tasks that grows with them; grouping by page shuffles nothing more."""
    return rows.repartition(tasks_for(rows.sparkSession, rows.count(), per_task), "page")


def land(pages: DataFrame, name: str, *folders: str, path: str | None = None) -> str:
    """Write (page, value), one row a page, as one text file each, below ``folders`` (columns) and ``page=<page>``, into a new folder or beside what ``path`` has; the path.

    Each task writes its files itself and moves them to names that depend on the
    page alone: a repeated task replaces its own, and no commit goes over all files.
    """
    path = path or new_folder(pages.sparkSession, name)
    names = [*folders, "page"]

    def write(batches):
        system, root = filesystem(path)
        for batch in batches:
            *keys, values = (c.to_pylist() for c in batch.columns)
            for *key, value in zip(*keys, values, strict=True):
                folder = "/".join([root, *(f"{n}={quote(k, safe='')}" for n, k in zip(names, key, strict=True))])
                system.create_dir(folder, recursive=True)
                partial = f"{folder}/_{uuid.uuid4().hex}"
                with system.open_output_stream(partial) as f:
                    f.write(f"{value or ''}\n".encode())
                system.move(partial, f"{folder}/part-00000.txt")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], names=["none"])

    pages.select(*(F.col(c).cast("string") for c in names), "value").mapInArrow(write, "none long").write.format("noop").mode("overwrite").save()
    filesystem(path)[0].create_dir(filesystem(path)[1], recursive=True)  # also where there are no pages
    return path

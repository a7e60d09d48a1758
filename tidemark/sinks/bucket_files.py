"""A data source that writes bucket files and commits by what its tasks report.

``df.write.format("bucket_files")`` takes rows clustered by ``__bucket`` and
``__part``.  A task writes one Parquet file for each run of both and reports, in its
commit message, the file, its rows, the sum of their hashes (``__hash``) and how
many rows are true in ``__inserted`` and in ``__updated``.  Only when all tasks
have reported does the commit write ``FILES``, a list of exactly these files: no
folder is listed, so files of killed or repeated tasks are in no version.  A task
that fails removes the file it was at, an abort those of the tasks that ended.

Columns whose names start with ``__`` steer the writing and are not written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.sources.files import filesystem, write_bytes

FILES = "FILES"
_BUFFERED = 1 << 17  # rows of one row group


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: (bucket, path below the version, rows, sum of hashes, inserted, updated) a file."""

    files: list[tuple[str, str, int, int, int, int]]


class BucketFiles(DataSource):
    """Options: ``path``, the folder of the version, and ``fail`` (tests): ``task`` or ``commit``."""

    @classmethod
    def name(cls) -> str:
        return "bucket_files"

    def schema(self) -> str:
        return "__bucket string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("fail", ""))


class _Open:
    """The file of the bucket that a task is at."""

    def __init__(self, root: str, bucket: str, part: int, schema: pa.Schema):
        self.bucket, self.part = bucket, part
        self.place = f"messages/{bucket}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        self.system, path = filesystem(f"{root}/{self.place}")
        self.path = path
        self.system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.writer = pq.ParquetWriter(path, schema, filesystem=self.system, compression="zstd")
        self.held: list[pa.RecordBatch] = []
        self.waiting, self.counts = 0, [0, 0, 0, 0]

    def add(self, rows: pa.RecordBatch, steering: dict[str, pa.Array]) -> None:
        self.held.append(rows)
        self.waiting += rows.num_rows
        hashes = steering["__hash"].to_numpy(zero_copy_only=False).tolist()
        for k, x in enumerate((rows.num_rows, sum(hashes), *(int(steering[c].fill_null(False).to_numpy(zero_copy_only=False).sum()) for c in ("__inserted", "__updated")))):
            self.counts[k] += x
        if self.waiting >= _BUFFERED:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.Table.from_batches(self.held))
        self.held, self.waiting = [], 0

    def close(self) -> tuple:
        self.flush()
        self.writer.close()
        return (self.bucket, self.place, *self.counts)

    def drop(self) -> None:
        self.writer.close()
        self.system.delete_file(self.path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, fail: str):
        self.root, self.fail = root, fail

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, at = [], None
        try:
            for batch in iterator:
                steering = {n: batch.column(n) for n in batch.schema.names if n.startswith("__")}
                rows = batch.select([n for n in batch.schema.names if n not in steering])
                names, parts = (steering[c].to_numpy(zero_copy_only=False) for c in ("__bucket", "__part"))
                starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (parts[1:] != parts[:-1])])) if len(names) else []
                for s, e in zip(starts, [*starts[1:], len(names)], strict=True):
                    if at is None or (at.bucket, at.part) != (names[s], parts[s]):
                        if at is not None:
                            files.append(at.close())
                        at = _Open(self.root, names[s], parts[s], rows.schema)
                    at.add(rows.slice(s, e - s), {n: c.slice(s, e - s) for n, c in steering.items()})
                    if self.fail == "task":
                        raise RuntimeError("a task that fails")
            if at is not None:
                files.append(at.close())
                at = None
        except BaseException:
            if at is not None:
                at.drop()
            _delete(self.root, files)
            raise
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        if self.fail == "commit":
            raise RuntimeError("a commit that fails")
        write_bytes(f"{self.root}/{FILES}", json.dumps(sorted(f for m in messages if m is not None for f in m.files)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        _delete(self.root, [f for m in messages if m is not None for f in m.files])


def _delete(root: str, files: list[tuple]) -> None:
    for _, place, *_ in files:
        system, path = filesystem(f"{root}/{place}")
        try:
            system.delete_file(path)
        except FileNotFoundError:
            pass

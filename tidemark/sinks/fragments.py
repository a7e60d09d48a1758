"""A data source that writes sorted items as fragments, and the job that stitches documents of them (K1, K2).

``df.write.format("fragments")`` takes rows (group_id, member_id, json) sorted by
member.  A task writes its items, joined by commas, to one file and an index of
the byte range that each member has in it; the commit writes ``FILES``, the list
of the indexes that tasks reported.  So a member's items may lie in the files of
many tasks, and no item list is ever a value of a row.

``stitch`` writes one document a member: a head, the member's ranges in the order
of the tasks, copied in blocks, and a tail.  A document appears under its name
only when it is whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.sources.files import filesystem, read_text, write_bytes

FILES, BLOCK = "FILES", 4 << 20
_INDEX = pa.schema([("group_id", pa.int64()), ("member_id", pa.int64()), ("task", pa.int32()), ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64())])


@dataclass
class Indexed(WriterCommitMessage):
    name: str | None


class Fragments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fragments"

    def schema(self) -> str:
        return "group_id long, member_id long, json string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"])


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Indexed:
        task, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        system, path = filesystem(f"{self.root}/{name}.items")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        ranges: list[list] = []
        with system.open_output_stream(path) as out:
            at = 0
            for batch in iterator:
                for group, member, item in zip(*(c.to_pylist() for c in batch.select(["group_id", "member_id", "json"]).columns), strict=True):
                    raw = item.encode()
                    if ranges and ranges[-1][:2] == [group, member]:
                        raw = b"," + raw
                    else:
                        ranges.append([group, member, task, f"{name}.items", at, 0])
                    out.write(raw)
                    ranges[-1][5] += len(raw)
                    at += len(raw)
        if not ranges:
            system.delete_file(path)
            return Indexed(None)
        columns = [pa.array(c, f.type) for c, f in zip(zip(*ranges, strict=True), _INDEX, strict=True)]
        pq.write_table(pa.Table.from_arrays(columns, schema=_INDEX), path.replace(".items", ".parquet"), filesystem=system)
        return Indexed(name)

    def commit(self, messages: list[Indexed | None]) -> None:
        write_bytes(f"{self.root}/{FILES}", json.dumps(sorted(m.name for m in messages if m is not None and m.name)).encode())

    def abort(self, messages: list[Indexed | None]) -> None:
        """Nothing reads files that ``FILES`` does not name."""


def written(spark: SparkSession, root: str) -> DataFrame:
    """The index of all fragments: (group_id, member_id, task, file, start, length)."""
    names = json.loads(read_text(f"{root}/{FILES}") or "[]")
    schema = "group_id long, member_id long, task int, file string, start long, length long"
    return spark.read.schema(schema).parquet(*(f"{root}/{n}.parquet" for n in names)) if names else spark.createDataFrame([], schema)


def stitch(heads: DataFrame, root: str, target: str, tail: str) -> DataFrame:
    """Write ``target``/group=<g>/member_id=<m>/part-00000.json for each of ``heads`` (group_id, member_id, head); (group_id, member_id, bytes), lazily.

    A member's ranges are at most as many as the tasks that wrote fragments.
    """
    index = written(heads.sparkSession, root)
    parts = index.groupBy("group_id", "member_id").agg(F.array_sort(F.collect_list(F.struct("task", "file", "start", "length"))).alias("parts"))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                system, folder = filesystem(f"{target}/group={row['group_id']}/member_id={row['member_id']}")
                system.create_dir(folder, recursive=True)
                partial, size = f"{folder}/_{uuid.uuid4().hex}", 0
                with system.open_output_stream(partial) as f:
                    size += f.write(row["head"].encode())
                    for k, part in enumerate(row["parts"] or ()):
                        if k:
                            size += f.write(b",")
                        size += _copy(f"{root}/{part['file']}", part["start"], part["length"], f)
                    size += f.write(tail.encode())
                system.move(partial, f"{folder}/part-00000.json")
                out.append((row["group_id"], row["member_id"], size))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["group_id", "member_id", "bytes"])

    return heads.join(parts, ["group_id", "member_id"], "left").select("group_id", "member_id", "head", "parts").mapInArrow(run, "group_id long, member_id long, bytes long")


def _copy(source: str, start: int, length: int, out) -> int:
    system, path = filesystem(source)
    with system.open_input_file(path) as f:
        f.seek(start)
        left = length
        while left:
            block = f.read(min(BLOCK, left))
            if not block:
                raise EOFError(source)
            out.write(block)
            left -= len(block)
    return length

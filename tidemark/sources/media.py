"""Media files: listing, and measures from the header.

Images are read by their own headers (PNG, GIF, JPEG), video and audio by the
boxes of their ISO container (MP4, M4V, M4A, MOV): picture size, duration, and
whether a video lacks sound.  Of other kinds, and of files that can't be read,
the measures are null.  Only files whose name ends in one of ``SUFFIXES`` are
opened; the others are listed, with null measures.  Files without bytes are left
out: they are not there yet.

``MediaHeaders`` is a data source whose partitions are lists of files.  Its
reader opens a file and goes from header to header: it skips the payload of every
box or segment that holds no measure, so of a video of any size a few windows of
``WINDOW`` bytes are read, and no content is ever a value of a row.  It reads
through Arrow's file systems (local, S3, GCS, HDFS); of a store that only Spark
can read, ``probe`` takes whole files instead, which Spark limits to 2 GB.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.files import files_below, filesystem, shown

# The endings of files that hold pictures, video and audio.
PICTURES, ISO = ("png", "gif", "jpg", "jpeg"), ("mp4", "m4v", "m4a", "mov")
SUFFIXES = PICTURES + ISO

WINDOW, FILES = 4096, 500
SCHEMA = "path string, length long, width int, height int, media_duration double, is_muted boolean, bytes_read long"
_OPENED = re.compile(rf"\.(?:{'|'.join(SUFFIXES)})$", re.IGNORECASE)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below ``path``; their bytes are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


class Ranges:
    """Parts of a file, of which only windows around the asked ones are fetched."""

    def __init__(self, fetch: Callable[[int, int], bytes], length: int):
        self.fetch, self.length, self.fetched = fetch, length, 0
        self.start, self.held = 0, b""

    def at(self, offset: int, size: int) -> bytes:
        """``size`` bytes from ``offset`` on, fewer where the file ends."""
        size = max(0, min(size, self.length - offset))
        if offset < self.start or offset + size > self.start + len(self.held):
            self.start, self.held = offset, self.fetch(offset, min(max(size, WINDOW), self.length - offset)) if size else b""
            self.fetched += len(self.held)
        return self.held[offset - self.start : offset - self.start + size]


def image_size(file: Ranges) -> tuple[int, int] | None:
    """(width, height) by the header of a PNG, GIF or JPEG."""
    head = file.at(0, 24)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) == 24:
        return struct.unpack(">II", head[16:24])
    if head[:6] in (b"GIF87a", b"GIF89a") and len(head) >= 10:
        return struct.unpack("<HH", head[6:10])
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= file.length:
            mark = file.at(at, 9)
            if mark[0] != 0xFF:
                return None
            kind = mark[1]
            if kind == 0xFF or kind == 0x01 or 0xD0 <= kind <= 0xD8:
                at += 1 if kind == 0xFF else 2
                continue
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", mark[5:9])
                return width, height
            at += 2 + struct.unpack(">H", mark[2:4])[0]
    return None


#: A box: where its payload starts and ends.
Span = tuple[int, int]


def boxes(file: Ranges, within: Span) -> Iterator[tuple[bytes, Span]]:
    """(type, payload) of the boxes of an ISO container, as far as they are whole; payloads are passed over."""
    at, stop = within
    while at + 8 <= stop:
        header = file.at(at, 16)
        size, kind, head = struct.unpack(">I", header[:4])[0], header[4:8], 8
        if size == 1 and at + 16 <= stop:
            size, head = struct.unpack(">Q", header[8:16])[0], 16
        end = stop if size == 0 else at + size
        if size and size < head or end > stop:
            return
        yield kind, (at + head, end)
        at = end


def _box(file: Ranges, within: Span, *path: bytes) -> Span | None:
    span: Span | None = within
    for kind in path:
        span = next((x for k, x in boxes(file, span) if k == kind), None) if span is not None else None
    return span


def iso_measures(file: Ranges) -> tuple[int | None, int | None, float | None, bool | None]:
    """(width, height, seconds, whether there is a picture but no sound) by the movie header and the tracks."""
    movie = _box(file, (0, file.length), b"moov")
    if movie is None:
        return None, None, None, None
    part = lambda span, size: file.at(span[0], min(size, span[1] - span[0])) if span is not None else b""
    width = height = seconds = None
    head = part(_box(file, movie, b"mvhd"), 32)
    if head and len(head) >= (32 if head[0] else 20):
        scale, length = struct.unpack(">IQ", head[20:32]) if head[0] else struct.unpack(">II", head[12:20])
        seconds = round(1000 * length / scale) / 1000 if scale and length else None
    kinds = set()
    for kind, track in boxes(file, movie):
        if kind != b"trak":
            continue
        role = part(_box(file, track, b"mdia", b"hdlr"), 12)[8:12]
        kinds.add(role)
        if role == b"vide" and width is None:
            entry = part(_box(file, track, b"mdia", b"minf", b"stbl", b"stsd"), 44)
            if len(entry) == 44:
                width, height = struct.unpack(">HH", entry[40:44])
            else:
                box = _box(file, track, b"tkhd")
                if box is not None and box[1] - box[0] >= 84:
                    width, height = (x >> 16 for x in struct.unpack(">II", file.at(box[1] - 8, 8)))
    return width, height, seconds, b"soun" not in kinds if b"vide" in kinds else None


def measures(file: Ranges) -> tuple[int | None, int | None, float | None, bool | None]:
    try:
        if file.at(4, 4) == b"ftyp":
            return iso_measures(file)
        return *(image_size(file) or (None, None)), None, None
    except struct.error:  # cut off in a header
        return None, None, None, None


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class MediaHeaders(DataSource):
    """``spark.read.format("media_headers").load(path)``: a row a file below ``path``, as ``SCHEMA``; ``filesPerPartition`` is an option."""

    @classmethod
    def name(cls) -> str:
        return "media_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("filesPerPartition", FILES)))


class _Reader(DataSourceReader):
    def __init__(self, uri: str, per_partition: int):
        self.uri, self.per_partition = uri, per_partition

    def partitions(self) -> list[_Files]:
        """Lists of (path, length), in the order of the paths; as with Spark's own files, the driver holds the list."""
        found = [(path, size) for path, size in files_below(self.uri) if size]
        n = self.per_partition
        return [_Files(found[k : k + n]) for k in range(0, len(found), n)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system = filesystem(self.uri)[0]
        rows = [(shown(self.uri, path), length, *_measured(system, path, length)) for path, length in partition.files]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.bool_(), pa.int64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _measured(system: fs.FileSystem, path: str, length: int) -> tuple:
    if not _OPENED.search(path):
        return None, None, None, None, 0
    try:
        with system.open_input_file(path) as f:

            def fetch(offset: int, size: int) -> bytes:
                f.seek(offset)
                return f.read(size)

            file = Ranges(fetch, length)
            return *measures(file), file.fetched
    except OSError:  # gone since it was listed, or unreadable
        return None, None, None, None, 0


def headers(spark: SparkSession, path: str, files_per_partition: int = FILES) -> DataFrame:
    """``SCHEMA`` for all files below ``path``, by ranged reads."""
    spark.dataSource.register(MediaHeaders)
    return spark.read.format("media_headers").option("filesPerPartition", files_per_partition).load(path)


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """The same by whole files, for stores that only Spark reads."""
    glob = "*.{" + ",".join(x for s in SUFFIXES for x in (s, s.upper())) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).where("length > 0").select("path", "content")

    def run(batches):
        for batch in batches:
            found = [measures(Ranges(lambda at, size, x=x: x[at : at + size], len(x))) for x in batch.column(1).to_pylist()]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[k] for x in found], t) for k, t in enumerate(kinds))], names=["path", "width", "height", "media_duration", "is_muted"])

    found = files.mapInArrow(run, "path string, width int, height int, media_duration double, is_muted boolean")
    other = listing(spark, path).where("length > 0").select("path").where(~F.lower("path").rlike(_OPENED.pattern))
    return found.unionByName(other, allowMissingColumns=True)


def probe(spark: SparkSession, path: str, types: DataFrame | None = None) -> DataFrame:
    """(path, width, height, media_duration, is_muted).

    With ``types`` (path, type) only their files are returned, and only what a
    type has: pictures a size, videos all measures, voices a duration.
    """
    try:
        filesystem(path)
        sized = headers(spark, path).drop("length", "bytes_read")
    except (pa.ArrowException, OSError):  # no file system of Arrow's
        sized = _whole(spark, path)
    if types is None:
        return sized
    kind = F.when(F.col("type") == "image", "picture").otherwise(F.col("type"))
    typed = sized.join(types.select("path", kind.alias("type")), "path")
    only = lambda c, *of: F.when(F.col("type").isin(*of), F.col(c)).alias(c)
    return typed.select("path", only("width", "picture", "video"), only("height", "picture", "video"), only("media_duration", "video", "voice"), only("is_muted", "video"))

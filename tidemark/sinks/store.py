"""A versioned store of messages and sync state.

Messages lie in buckets by group and hash of the member.  A commit writes only
the buckets of its batch, ``v=<version>/messages/group=<g>/bucket=<b>``, then
``v=<version>/state``, then a manifest that names the files of every bucket,
those of older versions included, and last moves a pointer file over the old one
by an atomic rename.  A reader follows the pointer, so it sees a version whole or
not at all: state never runs ahead of data, and a run that fails leaves the old
version current.  What the current manifest does not name is left over;
``prune`` removes it.

Files are written and reported by ``bucket_files``: a manifest is made of what the
tasks of the write say they wrote, never of a listing.  A bucket is one file, or
one for every ``FILE_ROWS`` rows it is expected to have.  The manifest keeps each
file's rows and the sum of their hashes, which do not depend on the order of the
rows, so ``altered`` finds lost and changed rows of the buckets it is asked about.

The number of buckets a group is fixed (``BUCKETS``), so the manifest grows with
the groups and by one entry for each ``FILE_ROWS`` messages.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.bucket_files import FILES, BucketFiles
from tidemark.sources import schemas

RETRIES, PAUSE_S, BUCKETS, FILE_ROWS = 5, 0.05, 64, 1_000_000


def bucket(member_id: str = "member_id") -> Column:
    return F.pmod(F.xxhash64(member_id), F.lit(BUCKETS)).cast("int")


def bucket_name() -> Column:
    """``group=<g>/bucket=<b>`` of a row's group and member."""
    return F.concat(F.lit("group="), F.col("group_id").cast("string"), F.lit("/bucket="), bucket().cast("string"))


def row_hash() -> Column:
    """A hash of a stored row, nulls and their places included."""
    return F.xxhash64(*(F.coalesce(F.col(f.name).cast("string"), F.lit("\0")) for f in schemas.STORED.fields))


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _read_text(self, path: str) -> str | None:
        if not self._fs.exists(self._path(path)):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> str | None:
        """The committed version."""
        return self._read_text(f"{self.path}/CURRENT")

    def _replace(self, target: str, text: str) -> bool:
        """K1: write beside the target and rename over it; tries again, and leaves no partial file."""
        partial = f"{target}.{uuid.uuid4().hex}"
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri())
        overwrite = getattr(self.spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(getattr(self.spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = overwrite
        try:
            for k in range(RETRIES):
                try:
                    stream = self._fs.create(self._path(partial), True)
                    stream.write(text.encode())
                    stream.close()
                    context.rename(self._path(partial), self._path(target), options)
                    return True
                except Exception:  # a store may refuse for a moment
                    time.sleep(PAUSE_S * (k + 1))
            return False
        finally:
            if self._fs.exists(self._path(partial)):
                self._fs.delete(self._path(partial), False)

    def _entries(self) -> dict[str, dict]:
        """Folder and files (path, rows, sum of hashes) of every bucket, by ``group=<g>/bucket=<b>``."""
        version = self.current()
        return json.loads(self._read_text(f"{self.path}/{version}/MANIFEST") or "{}") if version is not None else {}

    def _manifest(self) -> dict[str, str]:
        """The folder of every bucket."""
        return {name: x["folder"] for name, x in self._entries().items()}

    def _read(self, entries: list[dict]) -> DataFrame:
        files = sorted(f"{self.path}/{f[0]}" for x in entries for f in x["files"])
        if not files:
            return self.spark.createDataFrame([], schemas.STORED)
        return self.spark.read.schema(schemas.STORED).parquet(*files)

    def messages(self, touched: set[str] | None = None) -> DataFrame:
        """The stored messages, of the buckets ``touched`` where they are given."""
        return self._read([x for name, x in self._entries().items() if touched is None or name in touched])

    def _sums(self, entries: list[dict]) -> dict[str, tuple[int, int]]:
        """Rows and sum of hashes of the buckets, as their files have them."""
        found = self._read(entries).groupBy(bucket_name().alias("name")).agg(F.count("*").alias("n"), F.sum(row_hash().cast("decimal(20,0)")).alias("sum"))
        return {r["name"]: (r["n"], int(r["sum"])) for r in found.collect()}  # a row a bucket

    def altered(self, touched: set[str] | None = None) -> set[str]:
        """Buckets whose rows are not those that were committed, or can't be read; only those ``touched`` are looked at."""
        entries = {name: x for name, x in self._entries().items() if touched is None or name in touched}
        there: dict[str, tuple[int, int]] = {}
        try:
            there = self._sums(list(entries.values()))
        except PySparkException:  # a file is gone or broken: one by one
            for x in entries.values():
                try:
                    there |= self._sums([x])
                except PySparkException:
                    pass
        said = {name: (sum(f[1] for f in x["files"]), sum(f[2] for f in x["files"])) for name, x in entries.items()}
        return {name for name in said if there.get(name) != said[name]}

    def state(self) -> DataFrame:
        version = self.current()
        if version is None:
            return self.spark.createDataFrame([], schemas.STATE)
        return self.spark.read.schema(schemas.STATE).parquet(f"{self.path}/{version}/state")

    def touched(self, keys: DataFrame) -> set[str]:
        """The buckets of (group_id, member_id); at most ``BUCKETS`` a group."""
        return set(self.expected(keys))

    def expected(self, keys: DataFrame) -> dict[str, int]:
        """The buckets of rows (group_id, member_id) and how many rows each may have with them; at most ``BUCKETS`` a group."""
        rows = keys.where("group_id is not null").groupBy(bucket_name().alias("name")).count().collect()
        stored = self._entries()
        return {r["name"]: r["count"] + sum(f[1] for f in stored.get(r["name"], {"files": []})["files"]) for r in rows}

    def stage(self, messages: DataFrame, expected: dict[str, int] | None = None, fail: str = "") -> str:
        """Write the buckets of a new version; nothing reads them before ``commit``.

        A bucket's rows go to one task, or, by hash of the id, to as many as its
        ``expected`` rows need.  Where rows have the flags ``__inserted`` and
        ``__updated``, ``counted`` sums them up.
        """
        version = f"v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.spark.dataSource.register(BucketFiles)
        flags = [F.col(c) if c in messages.columns else F.lit(False).alias(c) for c in ("__inserted", "__updated")]
        named = messages.where("group_id is not null").select(*(f.name for f in schemas.STORED.fields), *flags, bucket_name().alias("__bucket"), row_hash().alias("__hash"))
        large = {name: math.ceil(n / FILE_ROWS) for name, n in (expected or {}).items() if n > FILE_ROWS}
        salt = F.lit(0)
        if large:  # an entry for each FILE_ROWS rows at most
            parts = F.create_map(*(F.lit(x) for name, n in large.items() for x in (name, n)))
            salt = F.pmod(F.xxhash64("id"), F.coalesce(F.try_element_at(parts, F.col("__bucket")), F.lit(1)))
        dealt = named.withColumn("__part", salt).repartition("__bucket", "__part").sortWithinPartitions("__bucket", "__part")
        dealt.write.format("bucket_files").mode("append").option("path", f"{self.path}/{version}").option("fail", fail).save()
        return version

    def _written(self, version: str) -> dict[str, dict]:
        """The entries of the files that the tasks of a staged version reported."""
        found: dict[str, dict] = {}
        for name, place, rows, hashes, *_ in json.loads(self._read_text(f"{self.path}/{version}/{FILES}") or "[]"):
            entry = found.setdefault(name, {"folder": f"{version}/messages/{name}", "files": []})
            entry["files"].append([f"{version}/{place}", rows, hashes])
        return found

    def counted(self, version: str) -> tuple[int, int]:
        """(inserted, updated) rows of a staged version, as its tasks counted them."""
        files = json.loads(self._read_text(f"{self.path}/{version}/{FILES}") or "[]")
        return sum(f[4] for f in files), sum(f[5] for f in files)

    def staged(self, version: str) -> DataFrame:
        return self._read(list(self._written(version).values()))

    def commit(self, version: str, state: DataFrame, touched: set[str] | None = None) -> None:
        """K3: the state after its data, the manifest after both, and the pointer last.

        Buckets ``touched`` are replaced, all others stay; without ``touched`` the
        version replaces the whole store.
        """
        state.select([f.name for f in schemas.STATE.fields]).write.parquet(f"{self.path}/{version}/state")
        kept = {} if touched is None else {name: x for name, x in self._entries().items() if name not in touched}
        if not self._replace(f"{self.path}/{version}/MANIFEST", json.dumps(kept | self._written(version))) or not self._replace(f"{self.path}/CURRENT", version):
            raise OSError(f"could not move the pointer of {self.path}")

    def prune(self) -> int:
        """Remove what the current manifest does not name; the number of versions of which nothing is left."""
        current, gone = self.current(), 0
        named = {f[0] for x in self._entries().values() for f in x["files"]}
        for status in self._fs.listStatus(self._path(self.path)):
            version = status.getPath().getName()
            if not version.startswith("v=") or version == current:
                continue
            if not any(x.startswith(f"{version}/") for x in named):
                self._fs.delete(status.getPath(), True)
                gone += 1
                continue
            for entry in self._written(version).values():
                if not any(f[0] in named for f in entry["files"]):
                    self._fs.delete(self._path(f"{self.path}/{entry['folder']}"), True)
        return gone

"""Helpers shared by the corpus operators: staging, hashing and Arrow access."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``); where it is unset, a temporary one if all runs in one process, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _fallback[app]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage is cut and no executor is needed again.

    The tables lie in ``<shared folder>/tidemark`` until the owner of the folder
    removes them (see ``clear``), because lazy results still read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove every staged table; call it once the results that read them are written."""
    jvm, path = spark.sparkContext._jvm, f"{shared_dir(spark)}/tidemark"
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def binary(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 of a string column, nulls as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


FILTER_BITS = 24


def bitmap(table: DataFrame, column: str) -> bytes:
    """A filter of fixed size, 2 ** FILTER_BITS bits, on the 64-bit hashes of a column; it lets through all of them, and others by chance."""
    bits = table.select((F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 32, np.uint32)
    for r in words.collect():
        out[r["word"]] = r["bits"]
    return out.tobytes()


def may_have(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter lets through."""
    words = np.frombuffer(bits, np.uint32)
    place = (hashes.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return (words[place >> 5] >> (place & 31).astype(np.uint32) & np.uint32(1)).astype(bool)

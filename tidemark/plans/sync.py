"""Incremental sync of all members in one plan.

landed messages, after each member's cursor, good rows apart from rejects,
merged with what is stored, written, counted, and only then the new cursors.

- A row without id is a reject; its member's cursor stays at or before its
  instant, so the next run reads it again, with its siblings (idempotent).
- A member whose batch is ``incomplete`` keeps its cursor.
- A member with fewer stored rows than its state says, or whose store is
  ``corrupt``, is read from the start, and has no cursor until a run finds it
  whole, so the next fetch is a full one.
- A replaced row keeps its known media measures.
- The result counts inserted and updated rows apart.

A run reads and writes only the store's buckets that its batch touches: those of
the members that it has rows of, or that are said to be corrupt.  The batch is
written to the shared folder first, unless it is read from files that stay, so
that its source is read once; its pages are numbered in reading order there; and the
merge says of each row whether it is new, so that nothing is read again to count.
Tasks grow in number with the rows of batch and buckets, not in what one sorts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.cursor import KEYS, after_cursor, clamp, earliest_failed, instant, lost_rows
from tidemark.operators.dedup import last_wins, upsert
from tidemark.operators.filters import normalize, not_empty, split_rejects
from tidemark.operators.order import places
from tidemark.sinks.shared import ROWS, many_tasks, new_folder
from tidemark.sinks.store import Store, bucket_name
from tidemark.sources import schemas

MEDIA = tuple(f.name for f in schemas.MEDIA.fields)


@dataclass
class Outcome:
    version: str
    inserted: int
    updated: int
    rejects: DataFrame
    refetch: DataFrame


def _keys(store: Store, rows: DataFrame | None) -> DataFrame:
    return rows.select(*KEYS).distinct() if rows is not None else store.spark.createDataFrame([], "group_id long, member_id long")


IDENTITY = ["group_id", "member_id", "id"]


def _counted(stored: DataFrame, new: DataFrame, landed: DataFrame) -> DataFrame:
    """The merge of stored and new rows, with the flags ``__inserted`` and ``__updated`` (landed, and stored before)."""
    marks = landed.where("id is not null").select(*IDENTITY).distinct().withColumns({"__rank": F.lit(0), "__landed": F.lit(True)})
    known = stored.withColumns({"__rank": F.lit(1), "__had": F.lit(True), "__whole": F.lit(True)}).unionByName(marks, allowMissingColumns=True)
    merged = upsert(known, new.withColumns({"__rank": F.lit(2), "__whole": F.lit(True)}), IDENTITY, keep=(*MEDIA, "__had", "__landed"), order=["__rank"])
    flags = {"__inserted": F.col("__had").isNull(), "__updated": F.col("__had").isNotNull() & F.col("__landed").isNotNull()}
    return merged.where("__whole").withColumns(flags).drop("__rank", "__had", "__landed", "__whole")


def plan(store: Store, landed: DataFrame, corrupt: DataFrame | None = None, touched: set[str] | None = None, cursors: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged messages, rejects, keys that need a full fetch) for ``landed`` raw messages with group_id, page and pos, over the buckets ``touched``.

    ``cursors`` (KEYS, last_sync_ts, and ``__run`` as the rows have it) stand in for those of the state.
    """
    stored, state = store.messages(touched), _within(store.state(), touched)
    refetch = lost_rows(state, stored).where("needs_full_refetch").select(*KEYS).unionByName(_keys(store, corrupt)).distinct()
    trusted = (state if cursors is None else cursors).join(refetch, KEYS, "left_anti")
    fresh = after_cursor(landed, trusted) if cursors is None else after_cursor(landed, trusted, [*KEYS, "__run"]).drop("__run")
    good, rejects = split_rejects(normalize(fresh))
    kept = good.where(not_empty(F.col("type"), F.col("content"), F.col("media_url")))
    placed = kept.join(places(landed), "page", "left").drop("page")
    unique = last_wins(placed, IDENTITY, ["__place", "pos"]).drop("__place", "pos")
    sized = unique.withColumn("media_file", F.when(F.col("media_url").isNotNull(), S.media_path(F.lit(""), "raw_type", "id", S.media_extension("media_url", "raw_type"))))
    new = sized.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schemas.MEDIA.fields if f.name != "media_file"})
    return _counted(stored, new, landed), rejects, refetch


def _within(rows: DataFrame, touched: set[str] | None, inside: bool = True) -> DataFrame:
    """Rows of members in the buckets, or those of all others."""
    if touched is None:
        return rows if inside else rows.limit(0)
    names = rows.sparkSession.createDataFrame([(x,) for x in sorted(touched)], "name string")
    return rows.join(F.broadcast(names), bucket_name() == F.col("name"), "left_semi" if inside else "left_anti")


def new_state(messages: DataFrame, rejects: DataFrame, now: Column) -> DataFrame:
    """Greatest id, newest instant clamped to the earliest reject, and count of every key."""
    report = messages.groupBy(*KEYS).agg(F.coalesce(F.max("id"), F.lit(0)).alias("last_message_id"), F.max(instant(F.col("timestamp"))).alias("newest"), F.count("*").alias("total_messages"))
    failed = earliest_failed(rejects.withColumn("timestamp", instant(F.col("timestamp"))))
    clamped = report.join(failed, KEYS, "left").withColumn("at", clamp(F.col("newest"), F.col("earliest_failed")))
    return clamped.select(*KEYS, "last_message_id", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("last_sync_ts"), "total_messages", S.export_clock(now).alias("last_sync"))


def sync(store: Store, landed: DataFrame, now: Column | None = None, incomplete: DataFrame | None = None, corrupt: DataFrame | None = None, verify: bool = False, cursors: Callable[[DataFrame], DataFrame] | None = None, staged: bool = False) -> Outcome:
    """One run over ``landed``; the store's version changes only if everything was written.

    Files that several runs landed get their ``cursors`` from the staged batch.  With
    ``staged``, ``landed`` is read from files that stay as they are, and not written again.

    With ``verify`` the touched buckets are held against the manifest's sums first
    (T6): the members of one that differs are corrupt.
    """
    batch = landed
    if not staged:
        path = new_folder(store.spark, "sync-batch")
        landed.write.option("maxRecordsPerFile", ROWS).parquet(path)
        batch = store.spark.read.schema(landed.schema).parquet(path)
    named = batch.select(*KEYS).unionByName(_keys(store, corrupt))
    expected = store.expected(named)
    touched = set(expected)
    if verify:
        damaged = store.altered(touched)
        corrupt = _keys(store, corrupt).unionByName(_within(store.state(), damaged).select(*KEYS)).distinct() if damaged else corrupt
    with many_tasks(store.spark, sum(expected.values())):
        merged, rejects, refetch = plan(store, batch, corrupt, touched, cursors(batch) if cursors is not None else None)
        version = store.stage(merged, expected)
        written = store.staged(version)
        held = _keys(store, incomplete)
        state = new_state(written, rejects, now if now is not None else F.current_timestamp()).join(refetch, KEYS, "left_anti").join(held, KEYS, "left_anti")
        known = store.state()
        old = _within(known, touched).join(held, KEYS, "left_semi").join(refetch, KEYS, "left_anti").unionByName(_within(known, touched, False))
        store.commit(version, state.unionByName(old), touched)
    return Outcome(version, *store.counted(version), rejects, refetch)

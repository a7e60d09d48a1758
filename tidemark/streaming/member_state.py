"""Sync with one keyed state a member.

Every micro-batch of landed pages is one run.  The state of a (group, member) is
its cursor, the newest instant, the greatest id, the number of its messages, the
instants of rows that failed, and the ids at or after the cursor.  It lies in
RocksDB, so stored messages are never read again to take in new ones:

- rows before the cursor are known and dropped; those at its instant come again
  and count once, because their ids are in the state;
- a row without id is a reject: the cursor stays at or before its instant, and
  what comes at or after it is taken again, counted once, until a later run
  brings a good row of that instant and no reject of it.  Then the cursor moves on;
- a row without an instant passes only where its member has no cursor.

A batch's changes are written to a folder of its own (``batch=<n>``), which a
replay of the batch overwrites, as the state store goes back with it: nothing is
lost or counted twice.  ``messages`` and ``state`` read what all batches left.

A member's batch is bounded by the files of a trigger; its ids are held while it
is taken in (8 bytes and a set entry each), afterwards only those from the
cursor on.  Of its rows one Arrow batch is held.  Rows without group or member
belong to no state and are left out.

Where pages are many, start and finish a run in ``sinks.shared.few_listings``:
a file stream lists by the settings that its session has while the query runs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.cursor import KEYS, instant
from tidemark.operators.dedup import last_wins
from tidemark.operators.filters import normalize, not_empty
from tidemark.operators.order import reading_order

#: No instant.
NONE = -(1 << 62)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROW = "id long, at long, timestamp string, type string, is_favorite boolean, content string, raw_type string, media_url string, page string, pos int"
_STATE = "cursor long, newest long, held long, last_message_id long, total_messages long"
_UNPACKED = f"group_id long, member_id long, {_ROW}, {_STATE}"
CHANGES = f"kind string, {_UNPACKED}"
_ROW_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_SUMMARY = "cursor long, newest long, last_message_id long, total_messages long, open array<long>, open_at array<long>, failed array<long>"


class MemberState(StatefulProcessor):
    """New and repeated messages, rejects, and the state that a run leaves, for one member.

    Calls, frames and their columns, not rows, are what many small members cost: so
    a member's state is read once and written once, the state row goes out with the
    last messages, and a row passes as one JSON text.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summary = handle.getValueState("summary", _SUMMARY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cursor, newest, last, total, ids, ats, failed_before = self.summary.get() or (NONE, NONE, 0, 0, [], [], [])
        known, waiting = dict(zip(ids, ats, strict=True)), set(failed_before)
        failed, mended = set(), set()
        kinds, texts = [], []
        for batch in rows:
            if kinds:
                yield pd.DataFrame({"kind": kinds, "packed": texts})
                kinds, texts = [], []
            for *_, message, at, broken, text in batch.to_numpy(object).tolist():
                if cursor != NONE and at < cursor:
                    continue
                texts.append(text)
                if broken:
                    failed.add(at)
                    kinds.append("reject")
                    continue
                mended.add(at)
                kinds.append("again" if message in known else "new")
                total += message not in known
                known[message] = max(at, known.get(message, NONE))
                newest, last = max(newest, at), max(last, message)
        waiting = sorted(x for x in (waiting - mended) | failed if x != NONE)
        held = waiting[0] if waiting else NONE
        cursor = min(newest, held) if NONE not in (newest, held) else newest
        still = {k: at for k, at in known.items() if cursor == NONE or at >= cursor}
        self.summary.update((cursor, newest, last, total, list(still), list(still.values()), waiting))
        state = {"group_id": key[0], "member_id": key[1], "cursor": cursor, "newest": newest, "held": held, "last_message_id": last, "total_messages": total}
        yield pd.DataFrame({"kind": [*kinds, "state"], "packed": [*texts, json.dumps(state)]})

    def close(self) -> None:
        pass


def changes(pages: DataFrame) -> DataFrame:
    """``CHANGES`` of a stream of raw messages with group_id, page and pos."""
    rows = normalize(pages).where("group_id is not null and member_id is not null")
    kept = rows.where(F.col("id").isNull() | not_empty(F.col("type"), F.col("content"), F.col("media_url")))
    at = F.coalesce(F.unix_micros(instant(F.col("timestamp"))), F.lit(NONE).cast("long")).alias("at")
    shaped = kept.withColumn("at", at).select(
        *KEYS,
        F.coalesce("id", F.lit(0).cast("long")).alias("id"),
        "at",
        F.col("id").isNull().alias("bad"),
        F.to_json(F.struct(*KEYS, *_ROW_NAMES)).alias("packed"),
    )
    found = shaped.groupBy(*KEYS).transformWithStateInPandas(MemberState(), outputStructType="kind string, packed string", outputMode="Update", timeMode="None")
    return found.select("kind", F.from_json("packed", _UNPACKED).alias("x")).select("kind", "x.*")


def start(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all pages that are there, then stop; run it again, with the same checkpoint, for later ones."""
    spark, key = pages.sparkSession, "spark.sql.streaming.stateStore.providerClass"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch={number}")

    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)  # a started query keeps the settings it was started with
    try:
        return changes(pages).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{CHANGES}, batch long").option("basePath", path).parquet(path)


def messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages, of those of one id the one read last."""
    rows = _read(spark, path).where("kind in ('new', 'again')")
    page = [F.col("batch"), *reading_order()]
    return last_wins(rows.select(*KEYS, *_ROW_NAMES, "batch"), [*KEYS, "id"], page).drop("at", "page", "pos", "batch")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows without id, each time they were read."""
    return _read(spark, path).where("kind = 'reject'").select(*KEYS, *_ROW_NAMES, "batch")


def state(spark: SparkSession, path: str) -> DataFrame:
    """group_id, member_id, last_message_id, total_messages, and the instants cursor, newest and held (null: none)."""
    rows = _read(spark, path).where("kind = 'state'")
    names = [c.split()[0] for c in _STATE.split(", ")]
    last = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*names), "batch").alias("s")).select(*KEYS, "s.*")
    at = {c: F.timestamp_micros(F.nullif(F.col(c), F.lit(NONE))) for c in ("cursor", "newest", "held")}
    return last.withColumns(at)

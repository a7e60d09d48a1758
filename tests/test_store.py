"""The store's commit protocol: what tasks report is committed, what fails leaves the old version; sums find changed rows."""

from __future__ import annotations

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_sync import FIELDS, message, run, state, stored
from tidemark.sinks import store as module
from tidemark.sinks.store import Store


def files(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*.parquet") if "state" not in p.parts)


def test_one_file_a_bucket(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    landed = spark.createDataFrame([message(k, member=k % 40) for k in range(3000)], FIELDS).repartition(16)
    version = store.stage(landed.selectExpr("group_id", "member_id", "id", "published_at as timestamp", "type", "is_favorite", "text as content", "type as raw_type", "file as media_url", "file as media_file", "cast(null as int) as width", "cast(null as int) as height", "cast(null as double) as media_duration", "cast(null as boolean) as is_muted"))
    found = files(tmp_path)
    assert len(found) == len({os.path.dirname(f) for f in found}) == len({f"{r['b']}" for r in landed.select(module.bucket().alias("b")).distinct().collect()})
    assert store.staged(version).count() == 3000 and store.messages().count() == 0


def test_a_large_bucket_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "FILE_ROWS", 100)
    store = Store(spark, str(tmp_path))
    out = run(store, *(message(k) for k in range(450)))
    assert (out.inserted, out.updated) == (450, 0) and len(files(tmp_path)) == 5
    run(store, *(message(k) for k in range(300, 600)))
    assert store.messages().count() == 600 and len(files(tmp_path / store.current())) == 8  # what 450 stored and 300 landed rows may need


@pytest.mark.parametrize("where", ["task", "commit"])
def test_a_failed_write_leaves_nothing(spark, tmp_path, where):
    store = Store(spark, str(tmp_path))
    run(store, message(1), message(2, member=2))
    before, kept = store.current(), files(tmp_path)
    with pytest.raises(Exception, match="fails"):
        store.stage(store.messages(), fail=where)
    assert store.current() == before and files(tmp_path) == kept
    assert stored(store) == [(1, 1, "hello"), (2, 2, "hello")]


def test_files_that_no_task_reported_are_not_read(spark, tmp_path):
    """A killed task leaves a file behind; it is in no manifest."""
    store = Store(spark, str(tmp_path))
    run(store, message(1))
    first = tmp_path / files(tmp_path)[0]
    (first.parent / "part-00000-killed.parquet").write_bytes(first.read_bytes())
    assert stored(store) == [(1, 1, "hello")]
    out = run(store, message(2, at="2024-02-01T00:00:00Z"))
    assert (out.inserted, out.updated) == (1, 0) and len(stored(store)) == 2
    assert store.prune() == 1 and len(files(tmp_path)) == 1


def test_one_changed_row_is_found(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, *(message(k, member=k % 9, at=f"2024-01-0{1 + k % 5}T00:00:00Z") for k in range(60)))
    assert store.altered() == set()
    path = tmp_path / files(tmp_path)[2]
    rows = pq.read_table(path)
    texts = rows["content"].to_pylist()
    column = rows.schema.get_field_index("content")
    pq.write_table(rows.set_column(column, "content", [["changed", *texts[1:]]]), path)
    crc = path.parent / f".{path.name}.crc"
    assert not crc.exists()
    name = "/".join(path.parts[-3:-1])
    assert store.altered() == {name} and store.altered({"group=1/bucket=none"}) == set()
    members = {r[0] for r in store.state().where(module.bucket_name() == F.lit(name)).select("member_id").collect()}
    out = run(store, *(message(100 + m, member=m, at="2024-03-01T00:00:00Z") for m in range(9)), verify=True)
    assert {r["member_id"] for r in out.refetch.collect()} == members and set(state(store)) == set(range(9)) - members
    path = tmp_path / store.current() / files(tmp_path / store.current())[0]
    path.unlink()
    assert store.altered() == {"/".join(path.parts[-3:-1])}


def test_rows_are_read_once(spark, tmp_path):
    """The source of a batch is read once, also in later runs."""
    store, seen = Store(spark, str(tmp_path / "s")), spark.sparkContext.accumulator(0)
    source = spark.createDataFrame([message(k, member=k % 3) for k in range(40)], FIELDS)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    from tidemark.plans.sync import sync

    for total in (40, 80):
        sync(store, source.mapInArrow(counted, FIELDS))
        assert seen.value == total


def test_manifest_is_what_was_reported(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    out = run(store, message(1), message(2))
    entries = json.loads((tmp_path / out.version / "MANIFEST").read_text())
    assert [[f[1] for f in x["files"]] for x in entries.values()] == [[2]]
    assert json.loads((tmp_path / out.version / "FILES").read_text())[0][4:] == [2, 0]

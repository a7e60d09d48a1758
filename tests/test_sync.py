"""Several runs of the sync plan over one store, as batch and as stream."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators.order import places
from tidemark.plans import media as media_plan
from tidemark.plans.sync import plan, sync
from tidemark.sinks import export
from tidemark.sinks.store import Store
from tidemark.streaming.sync_stream import start

FIELDS = "group_id long, id long, member_id long, published_at string, type string, text string, is_favorite boolean, file string, thumbnail string, page string, pos int"
NOW = 1700000000


def message(id_, member=1, at="2024-01-01T00:00:00Z", kind="text", text="hello", file=None, page="p0", pos=0):
    return (1, id_, member, at, kind, text, None, file, None, page, pos)


def run(store, *messages, **options):
    return sync(store, store.spark.createDataFrame(list(messages), FIELDS), F.timestamp_seconds(F.lit(NOW)), **options)


def stored(store):
    return sorted((r["member_id"], r["id"], r["content"]) for r in store.messages().collect())


def state(store):
    return {r["member_id"]: (r["last_message_id"], r["last_sync_ts"][:19], r["total_messages"]) for r in store.state().collect()}


def test_runs_are_idempotent_and_incremental(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = [message(1), message(2, at="2024-01-02T00:00:00Z", kind="image", text="", file="https://h/x.png"), message(5, member=2)]
    out = run(store, *first)
    assert (out.inserted, out.updated) == (3, 0)
    before = stored(store), state(store)
    out = run(store, *first)
    assert (out.inserted, out.updated) == (0, 3) and (stored(store), state(store)) == before
    out = run(store, message(3, at="2024-01-01T12:00:00Z"), message(2, at="2024-01-02T00:00:00Z", text="edited"), message(4, at="2024-01-03T00:00:00Z"))
    assert stored(store) == [(1, 1, "hello"), (1, 2, "edited"), (1, 4, "hello"), (2, 5, "hello")]
    assert state(store)[1] == (4, "2024-01-03T00:00:00", 3)


def test_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    run(store, message(1))
    version, before = store.current(), state(store)
    monkeypatch.setattr(Store, "_replace", lambda *_: False)
    with pytest.raises(OSError):
        run(store, message(2, at="2024-02-01T00:00:00Z"))
    assert store.current() == version and state(store) == before and stored(store) == [(1, 1, "hello")]
    monkeypatch.undo()
    assert store.prune() == 1


def test_poison_row_holds_the_cursor(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    out = run(store, message(None, at="2024-01-01T00:00:00Z"), message(2, at="2024-01-05T00:00:00Z"))
    assert out.rejects.count() == 1 and state(store)[1] == (2, "2024-01-01T00:00:00", 1)
    run(store, message(1, at="2024-01-01T00:00:00Z"), message(2, at="2024-01-05T00:00:00Z"))
    assert state(store)[1] == (2, "2024-01-05T00:00:00", 2)


def test_incomplete_batch_keeps_the_cursor(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, message(1))
    held = spark.createDataFrame([(1, 1)], "group_id long, member_id long")
    run(store, message(9, at="2024-06-01T00:00:00Z"), incomplete=held)
    assert state(store)[1] == (1, "2024-01-01T00:00:00", 1) and len(stored(store)) == 2


def test_lost_rows_ask_for_a_full_fetch(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, message(1), message(2, at="2024-01-02T00:00:00Z"), message(3, member=2))
    broken = store.messages().where("id <> 1")
    store.commit(store.stage(broken), store.state())
    out = run(store, message(1, text="back"), message(2, at="2024-01-02T00:00:00Z"))
    assert [tuple(r) for r in out.refetch.collect()] == [(1, 1)] and 1 not in state(store)
    assert stored(store)[0] == (1, 1, "back")
    run(store, message(1, text="back"), message(2, at="2024-01-02T00:00:00Z"))
    assert state(store)[1] == (2, "2024-01-02T00:00:00", 2)


def test_corrupt_member_is_read_anew(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, message(1, at="2024-01-05T00:00:00Z"))
    run(store, message(2, at="2024-01-02T00:00:00Z"), corrupt=spark.createDataFrame([(1, 1)], "group_id long, member_id long"))
    assert len(stored(store)) == 2 and state(store) == {}


def test_empty_messages_and_media(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    run(store, message(1, text=""), message(2, kind="image", text=None, file="https://h/x.png"), message(3, kind="odd", text="", file="https://h/y"))
    assert [r[1] for r in stored(store)] == [2, 3]
    root = tmp_path / "messages" / "1 g" / "1 n" / "picture"
    root.mkdir(parents=True)
    (root / "2.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + b"\0\0\0\x07\0\0\0\x09" + b"\0" * 9)
    where = F.lit("messages/1 g/1 n")
    assert [r["path"] for r in media_plan.outstanding(store.messages(), spark, str(tmp_path / "messages"), where).collect()] == ["messages/1 g/1 n/other/3.bin"]
    sized = {r["id"]: (r["width"], r["height"]) for r in media_plan.measured(store.messages(), spark, str(tmp_path / "messages"), where).collect()}
    assert sized == {2: (7, 9), 3: (None, None)}


def test_export(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    run(store, message(2, at=None), message(1, at="2024-01-02T00:00:00Z"), message(3, at="2024-01-01T00:00:00Z", kind="voice", file="f"))
    header = spark.createDataFrame([(1, 1, "n", "g", None, None, None, None)], "group_id long, id long, name string, group_name string, portrait string, thumbnail string, phone_image string, group_thumbnail string")
    export.export(store.messages(), header, str(tmp_path / "out"), F.timestamp_seconds(F.lit(NOW)))
    doc = json.loads(next((tmp_path / "out/group=1/member_id=1").glob("*.json")).read_text())
    assert [m["id"] for m in doc["messages"]] == [2, 3, 1]
    assert doc["message_type_counts"] == {"text": 2, "video": 0, "picture": 0, "voice": 1} and doc["member"]["group_name"] == "g"
    assert spark.range(1).select(export.folder(F.lit(1), F.lit("a/b"), F.lit(2), F.lit(None).cast("string"))).first()[0] == "messages/1 a_b/2"


def test_stream_equals_batch(spark, tmp_path):
    pages = tmp_path / "pages" / "group=1"
    pages.mkdir(parents=True)
    raw = lambda id_, at, text: {"id": id_, "member_id": 1, "published_at": at, "type": "text", "text": text}
    (pages / "p0.json").write_text(json.dumps({"messages": [raw(2, "2024-01-02T00:00:00Z", "b"), raw(1, "2024-01-01T00:00:00Z", "a")]}))
    go = lambda: start(spark, str(tmp_path / "pages"), str(tmp_path / "store"), str(tmp_path / "checkpoint")).awaitTermination()
    go()
    store = Store(spark, str(tmp_path / "store"))
    assert stored(store) == [(1, 1, "a"), (1, 2, "b")]
    (pages / "p1.json").write_text(json.dumps({"messages": [raw(3, "2024-01-03T00:00:00Z", "c"), raw(2, "2024-01-02T00:00:00Z", "b2")]}))
    go()
    assert stored(store) == [(1, 1, "a"), (1, 2, "b2"), (1, 3, "c")]
    batch = Store(spark, str(tmp_path / "batch"))
    run(batch, message(2, at="2024-01-02T00:00:00Z", text="b"), message(1, text="a"))
    run(batch, message(3, at="2024-01-03T00:00:00Z", text="c"), message(2, at="2024-01-02T00:00:00Z", text="b2"))
    assert stored(batch) == stored(store) and state(batch) == state(store)


def test_a_run_of_several_batches_loses_no_older_page(spark, tmp_path):
    pages = tmp_path / "pages" / "group=1"
    pages.mkdir(parents=True)

    def page(name, *days, at=None):
        rows = [{"id": d, "member_id": 1, "published_at": f"2024-01-{d:02d}T00:00:00Z", "type": "text", "text": "x"} for d in days]
        (pages / name).write_text(json.dumps({"messages": rows}))
        if at is not None:
            os.utime(pages / name, (at, at))

    go = lambda: start(spark, str(tmp_path / "pages"), str(tmp_path / "store"), str(tmp_path / "checkpoint"), 1).awaitTermination()
    page("p0.json", 9, 8, at=NOW)  # newest first, a batch a file
    page("p1.json", 7, 6, at=NOW + 10)
    page("p2.json", 5, at=NOW + 20)
    go()
    store = Store(spark, str(tmp_path / "store"))
    assert [r[1] for r in stored(store)] == [5, 6, 7, 8, 9] and state(store)[1] == (9, "2024-01-09T00:00:00", 5)
    time.sleep(0.05)
    page("p3.json", 10, 9)
    page("p4.json", 4)  # before the cursor at which the second run begins
    go()
    assert [r[1] for r in stored(store)] == [5, 6, 7, 8, 9, 10]


def test_a_run_of_several_batches_merges_once(spark, tmp_path, monkeypatch):
    pages = tmp_path / "pages" / "group=1"
    pages.mkdir(parents=True)

    def page(name, *rows, at):
        texts = [{"id": id_, "member_id": 1, "published_at": f"2024-01-{day:02d}T00:00:00Z", "type": "text", "text": "x"} for id_, day in rows]
        (pages / name).write_text(json.dumps({"messages": texts}))
        os.utime(pages / name, (at, at))

    go = lambda: start(spark, str(tmp_path / "pages"), str(tmp_path / "a store"), str(tmp_path / "a checkpoint+%41"), 1).awaitTermination()
    store = Store(spark, str(tmp_path / "a store"))
    page("p0.json", (None, 5), (9, 9), at=NOW)  # a reject, in a batch of its own
    page("p1.json", (7, 7), at=NOW + 10)
    monkeypatch.setattr(Store, "_replace", lambda *_: False)
    with pytest.raises(OSError):
        go()
    monkeypatch.undo()
    assert store.current() is None
    page("p2.json", (4, 4), at=NOW + 20)
    go()  # what the failed run has staged, and the later page
    assert [r[1] for r in stored(store)] == [4, 7, 9] and state(store)[1] == (9, "2024-01-05T00:00:00", 3)
    merges = len(list((tmp_path / "a store").glob("v=*/MANIFEST")))
    page("p3.json", (10, 10), at=NOW + 30)
    page("p4.json", (11, 11), at=NOW + 40)
    page("p5.json", (12, 12), at=NOW + 50)
    go()
    assert len(stored(store)) == 6 and len(list((tmp_path / "a store").glob("v=*/MANIFEST"))) == merges + 1
    assert not (tmp_path / "a checkpoint+%41" / "staged").exists()


def test_page_names_are_taken_apart_once_a_page(spark, tmp_path):
    names = ["q/page-10", "q/page-2", "q/page-02", None, "q/page-1", "q/page-2"]
    found = places(spark.createDataFrame([(x,) for x in names], "page string"))
    assert [r["page"] for r in found.orderBy("__place").collect()] == ["q/page-1", "q/page-02", "q/page-2", "q/page-10"]
    store = Store(spark, str(tmp_path))
    landed = spark.createDataFrame([message(1, text=str(k), page=x) for k, x in enumerate(names[:2])], FIELDS)
    assert "0+(" not in plan(store, landed)[0]._jdf.queryExecution().toString()
    run(store, *(message(1, text=str(k), page=x) for k, x in enumerate(names)), message(2, text="a", page="q/page-1", pos=3), message(2, text="b", page="q/page-1", pos=2))
    assert stored(store) == [(1, 1, "0"), (1, 2, "a")]


def test_a_batch_writes_only_its_members_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, *(message(k, member=k) for k in range(1, 30)))
    first = store.current()
    out = run(store, message(100, member=3, at="2024-02-01T00:00:00Z"))
    assert out.version != first and (out.inserted, out.updated) == (1, 0)
    written = [p for p in (tmp_path / out.version / "messages").glob("group=*/bucket=*") if p.is_dir()]
    assert len(written) == 1 and len(stored(store)) == 30
    assert {k: v[2] for k, v in state(store).items()} == {k: 2 if k == 3 else 1 for k in range(1, 30)}
    place = f"group=1/{written[0].name}"
    folders = store._manifest()
    assert folders[place].startswith(out.version) and all(f.startswith(first) for name, f in folders.items() if name != place)
    assert (tmp_path / first / "messages" / place).is_dir()
    assert store.prune() == 0 and not (tmp_path / first / "messages" / place).exists() and len(stored(store)) == 30


def test_members_of_other_buckets_keep_their_state(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, message(1), message(2, member=2))
    before = state(store)
    run(store)
    assert state(store) == before and stored(store) == [(1, 1, "hello"), (2, 2, "hello")]

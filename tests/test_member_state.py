"""Keyed sync: cursors, counts, rejects that hold and are released, restarts and replays."""

from __future__ import annotations

import json
import shutil
from types import SimpleNamespace

import pandas as pd
import pytest

from tidemark.operators.cursor import KEYS
from tidemark.streaming import member_state as M
from tidemark.streaming.sync_stream import page_stream


@pytest.fixture
def run(spark, tmp_path):
    """Land one page, named by number, and take in what is there."""
    pages, store, checkpoint = tmp_path / "pages", str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def go(number=None, *messages, group=1):
        if number is not None:
            folder = pages / f"group={group}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"page-{number}.json").write_text(json.dumps({"messages": list(messages)}))
        M.start(page_stream(spark, str(pages)), store, checkpoint).awaitTermination()
        return {(r["group_id"], r["member_id"]): r for r in M.state(spark, store).collect()}

    go.store, go.checkpoint = store, checkpoint
    return go


def message(k, second, member=7, **rest):
    return {"id": k, "member_id": member, "published_at": f"2026-01-01T00:00:{second:02d}Z", "type": "text", "text": f"text {k}"} | rest


def second(instant):
    return None if instant is None else instant.second


def test_cursor_and_count(spark, run):
    found = run(1, message(1, 10), message(2, 20), message(3, 5, member=8))
    assert (found[1, 7]["total_messages"], found[1, 7]["last_message_id"], second(found[1, 7]["cursor"])) == (2, 2, 20)
    assert (found[1, 8]["total_messages"], second(found[1, 8]["cursor"])) == (1, 5)
    # a row at the cursor comes again, one before it is known, one at its instant is new
    found = run(2, message(2, 20, text="changed"), message(9, 19), message(4, 20), message(5, 30))
    assert (found[1, 7]["total_messages"], found[1, 7]["last_message_id"], second(found[1, 7]["cursor"])) == (4, 5, 30)
    texts = {r["id"]: r["content"] for r in M.messages(spark, run.store).where("member_id = 7").collect()}
    assert texts == {1: "text 1", 2: "changed", 4: "text 4", 5: "text 5"}
    assert found[1, 8]["total_messages"] == 1
    again = run()  # nothing is there
    assert again == found


def test_a_reject_holds_the_cursor_until_it_is_mended(spark, run):
    poison = {"member_id": 7, "published_at": "2026-01-01T00:00:15Z", "type": "text", "text": "no id"}
    found = run(1, message(1, 10), poison, message(2, 20))
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"]), second(found[1, 7]["held"]), second(found[1, 7]["newest"])) == (2, 15, 15, 20)
    found = run(2, message(2, 20), message(3, 25), message(4, 12))  # 4 is before the cursor
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"]), second(found[1, 7]["newest"])) == (3, 15, 25)
    found = run(3, poison, message(3, 25))  # it fails again
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"])) == (3, 15)
    found = run(4, message(5, 15), message(2, 20), message(3, 25))
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"]), found[1, 7]["held"]) == (4, 25, None)
    found = run(5, message(6, 24))
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"])) == (4, 25)
    assert M.rejects(spark, run.store).count() == 2
    assert sorted(r["id"] for r in M.messages(spark, run.store).collect()) == [1, 2, 3, 5]


def test_rows_without_instant_text_or_member(spark, run):
    nothing = message(3, 12, text="")
    found = run(1, {"id": 1, "member_id": 7, "type": "text", "text": "a"}, nothing, {"id": 2, "published_at": "2026-01-01T00:00:01Z"})
    assert set(found) == {(1, 7)} and found[1, 7]["cursor"] is None and found[1, 7]["total_messages"] == 1
    found = run(2, {"id": 1, "member_id": 7, "type": "text", "text": "a"}, message(4, 9))
    assert (found[1, 7]["total_messages"], second(found[1, 7]["cursor"])) == (2, 9)
    found = run(3, {"id": 5, "member_id": 7, "type": "text", "text": "late"})
    assert found[1, 7]["total_messages"] == 2


def test_within_a_run_the_last_page_wins(spark, run, tmp_path):
    folder = tmp_path / "pages" / "group=1"
    folder.mkdir(parents=True)
    for k in (2, 10, 9):
        (folder / f"page-{k}.json").write_text(json.dumps({"messages": [message(1, 10, text=f"from {k}"), message(1, 10, text="earlier")][:: -1 if k == 10 else 1]}))
    assert run()[1, 7]["total_messages"] == 1
    assert M.messages(spark, run.store).first()["content"] == "from 10"


def test_a_replayed_batch_changes_nothing(spark, run):
    run(1, message(1, 10))
    found = run(2, message(2, 20), message(3, 30))
    # the last batch was written, but its commit was lost
    last = max(int(p.name) for p in (run_path(run) / "commits").iterdir() if p.name.isdigit())
    for p in (run_path(run) / "commits").glob(f"*{last}*"):
        p.unlink()
    assert run() == found
    assert M.messages(spark, run.store).count() == 3


def run_path(run):
    from pathlib import Path

    return Path(run.checkpoint)


def test_a_lost_folder_of_a_failed_batch_is_written_anew(spark, run):
    run(1, message(1, 10))
    found = run(2, message(2, 20))
    last = max(int(p.name) for p in (run_path(run) / "commits").iterdir() if p.name.isdigit())
    for p in (run_path(run) / "commits").glob(f"*{last}*"):
        p.unlink()
    shutil.rmtree(f"{run.store}/batch={last}")
    assert run() == found


def test_a_member_costs_one_read_one_write_and_one_frame_a_batch():
    calls, kept = [], {}
    value = SimpleNamespace(get=lambda: calls.append("get") or kept.get(0), update=lambda x: calls.append("update") or kept.update({0: x}))
    member = M.MemberState()
    member.init(SimpleNamespace(getValueState=lambda name, schema: value))  # no other state

    def take(*batches):
        frames = [pd.DataFrame([(1, 7, k, at, bad, f"text {k}") for k, at, bad in rows], columns=[*KEYS, "id", "at", "bad", "packed"]) for rows in batches]
        calls.clear()
        return list(member.handleInputRows((1, 7), iter(frames), None))

    (only,) = take([(1, 10, False), (0, 15, True), (2, 20, False), (2, 20, False)])
    assert calls == ["get", "update"] and only["kind"].tolist() == ["new", "reject", "new", "again", "state"] and only["packed"][2] == "text 2"
    assert json.loads(only["packed"][4]) == {"group_id": 1, "member_id": 7, "cursor": 15, "newest": 20, "held": 15, "last_message_id": 2, "total_messages": 2}
    assert kept[0] == (15, 20, 2, 2, [2], [20], [15])
    first, second_, third = take([(3, 12, False), (4, 25, False)], [(5, 15, False)], [(2, 20, False)])
    assert calls == ["get", "update"] and [x["kind"].tolist() for x in (first, second_, third)] == [["new"], ["new"], ["again", "state"]]
    assert kept[0] == (25, 25, 5, 4, [4], [25], [])


def test_rows_come_back_as_they_were(spark, run):
    texts = {1: 'a "b" \\ c', 2: "line\nline\r\t", 3: "\u0000\u2028\U0001f600 {}", 4: "null", 5: " "}
    poison = {"member_id": 7, "published_at": "2026-01-01T00:00:15Z", "type": "text", "text": texts[1]}
    run(1, *(message(k, 10 + k, text=t) for k, t in texts.items()), message(6, 16, type="image", text=None, file="x.png"), poison)
    rows = {r["id"]: r for r in M.messages(spark, run.store).collect()}
    assert {k: rows[k]["content"] for k in texts} == texts
    assert (rows[6]["content"], rows[6]["media_url"], rows[6]["type"], rows[6]["raw_type"]) == (None, "x.png", "picture", "image")
    assert rows[1]["timestamp"] == "2026-01-01T00:00:11Z"
    (bad,) = M.rejects(spark, run.store).collect()
    assert (bad["id"], bad["content"], bad["pos"], bad["batch"]) == (None, texts[1], 6, 0) and bad["page"].endswith("page-1.json")

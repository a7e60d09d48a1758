"""Scans that stop between pages and go on, and zone maps that keep pages closed."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, scan


@pytest.fixture
def timeline(spark, tmp_path):
    """Groups of pages, newest first: page p of group g has messages 10 * p and 10 * p + 1, each a minute older than the one before."""

    def land(**pages):
        rows = []
        for group, n in pages.items():
            for p in range(n):
                folder = tmp_path / "scan" / f"group={group[1:]}" / f"page={p}"
                folder.mkdir(parents=True, exist_ok=True)
                items = [{"id": 10 * p + k, "member_id": 1, "published_at": f"2026-01-01T00:{58 - 2 * p - k:02d}:00Z", "text": f"é {p}"} for k in (0, 1)]
                (folder / "part.json").write_text(json.dumps({"messages": items, "continuation": f"page={p + 1}"}))
                rows += [(int(group[1:]), p, x["published_at"]) for x in items]
        scan.write_zones(spark.createDataFrame(rows, "group_id long, page long, published_at string"), str(tmp_path / "scan"))
        return str(tmp_path / "scan")

    return land


@pytest.fixture
def run(spark, tmp_path):
    out, checkpoint, position = str(tmp_path / "out"), str(tmp_path / "checkpoint"), str(tmp_path / "position")

    def go(path, once=True, **options):
        def write(batch, number):
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        query = scan.stream(spark, path, position, **options).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        if once:
            query.trigger(availableNow=True).start().awaitTermination()
        else:
            rest = query.trigger(processingTime="0 seconds").start()
            rest.processAllAvailable()
            rest.stop()
        rows = spark.read.parquet(out)
        assert rows.groupBy("group_id", "id").count().where("count > 1").count() == 0  # no page is read twice
        return {r["group_id"]: sorted(r["pages"]) for r in rows.groupBy("group_id").agg(F.collect_set(F.regexp_extract("page", r"page=(\d+)", 1).cast("int")).alias("pages")).collect()}

    go.position, go.out = position, out
    return go


def test_a_scan_stops_between_pages_and_goes_on(timeline, run):
    path = timeline(g1=7, g2=2)
    assert run(path, pages_per_batch=2) == {1: [0, 1], 2: [0, 1]}
    place = json.loads(files.read_text(run.position))
    assert place["1"]["page"] == 2 and place["1"]["continuation"].endswith("group=1/page=2/part.json") and not place["1"]["done"]
    assert place["2"] == {"page": 2, "continuation": "", "done": True}
    assert run(path, pages_per_batch=3) == {1: [0, 1, 2, 3, 4], 2: [0, 1]}
    assert run(path, once=False, pages_per_batch=1) == {1: list(range(7)), 2: [0, 1]}
    assert run(path, pages_per_batch=5) == {1: list(range(7)), 2: [0, 1]}  # nothing is left


def test_a_scan_ends_behind_the_cursors_page(spark, timeline, run, tmp_path):
    path = timeline(g1=9, g2=9, g3=3)
    for p in range(4, 9):  # pages past the stop are not opened
        for f in (tmp_path / "scan/group=1" / f"page={p}").iterdir():
            f.write_text("{broken")
    found = run(path, once=False, cursors={1: "2026-01-01T00:52:00Z", 2: "2026-01-01T00:58:00+00:00"}, pages_per_batch=2)
    assert found == {1: [0, 1, 2, 3], 2: [0], 3: [0, 1, 2]}
    texts = spark.read.parquet(run.out).where("group_id = 1 and id = 31").collect()
    assert [(r["text"], r["pos"], json.loads(r["raw"])["id"]) for r in texts] == [("é 3", 1, 31)]


def test_a_failed_batch_is_read_again(spark, timeline, tmp_path):
    path, out = timeline(g1=4), str(tmp_path / "o")
    state = {"fail": True}

    def write(batch, number):
        if number == 1 and state["fail"]:
            raise RuntimeError("a sink that fails")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def go(**trigger):
        rows = scan.stream(spark, path, str(tmp_path / "p"), pages_per_batch=1)
        return rows.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(**trigger).start()

    query = go(processingTime="0 seconds")
    with pytest.raises(Exception, match="fails"):
        query.processAllAvailable()
        query.awaitTermination()
    state["fail"] = False
    query = go(processingTime="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 10, 11, 20, 21, 30, 31]


def test_pages_until(spark):
    rows = [("a", f"x/page-{p}", p) for p in range(1, 13)] + [("b", "x/page-1", 1), ("c", "x/page-9", None)]
    pages = spark.createDataFrame(rows, "k string, page string, v int")
    take = lambda cap=None: sorted((r["k"], int(r["page"][7:])) for r in scan.pages_until(pages, ["k"], F.col("v") >= 10, cap).collect())
    assert take() == sorted([("a", p) for p in range(1, 11)] + [("b", 1), ("c", 9)])
    assert take(3) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 9)]
    assert scan.pages_until(pages.limit(0), ["k"], F.col("v") >= 10).count() == 0


def test_only_wanted_pages_are_opened(spark, timeline, tmp_path):
    path = timeline(g1=6, g2=6)
    wanted = scan.pages_until(scan.zones(spark, path), ["group_id"], F.col("oldest") <= F.to_timestamp(F.lit("2026-01-01T00:55:00Z")), 3)
    rows = scan.read_pages(spark, path, wanted)
    opened = {f.split("/scan/")[1].rsplit("/", 1)[0] for f in rows.inputFiles()}
    assert opened == {f"group={g}/page={p}" for g in (1, 2) for p in (0, 1)}
    assert sorted((r["group_id"], r["id"]) for r in rows.collect()) == [(g, k) for g in (1, 2) for k in (0, 1, 10, 11)]
    assert scan.read_pages(spark, path, wanted.limit(0)).count() == 0
    zone = scan.zones(spark, path).where("group_id = 1 and page = 2").first()
    assert (zone["newest"].minute, zone["oldest"].minute, zone["rows"]) == (54, 53, 2)


def test_live_counts(spark, timeline, tmp_path):
    """A listener counts the rows of each batch while a scan runs."""
    import time

    from tidemark.streaming.progress import listen

    path, told = timeline(g1=5), []
    seen = listen(spark, lambda query, batch, rows: told.append((batch, rows)))
    try:
        rows = scan.stream(spark, path, str(tmp_path / "p"), pages_per_batch=2)
        query = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        name = str(query.id)
        query.stop()
        for _ in range(100):
            if name in seen.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    assert told == [(0, 4), (1, 8), (2, 10)] and seen.rows(name) == 10 and seen.batches(name) == 3 and seen.ended[name] is None

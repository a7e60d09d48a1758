"""Landing, archives and syncs whose work is dealt out by the size of their input."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tidemark import landed_queries as Q
from tidemark.plans import blogs
from tidemark.plans import sync as plan
from tidemark.sinks import shared
from tidemark.sinks.store import Store
from tidemark.sources import html, jsonp, landed, markup, schemas
from tidemark.streaming import member_state
from tidemark.streaming.sync_stream import page_stream


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_pages_are_landed_by_many_tasks_and_once(spark):
    rows = spark.range(2000).select((F.col("id") % 50).alias("page"), F.col("id").alias("item"))
    assert shared.by_page(rows, 100).rdd.getNumPartitions() == 20
    pages = shared.by_page(rows, 100).groupBy("page").agg(F.to_json(F.array_sort(F.collect_list("item"))).alias("value")).withColumn("group", F.lit(1))
    path = shared.land(pages, "pages", "group")
    assert shared.land(pages, "pages", "group", path=path) == path  # as a task that is repeated
    files = sorted(Path(path).rglob("*.*"))
    assert len(files) == 50 and files[0].parts[-3:-1] == ("group=1", "page=0") and files[0].read_text().startswith("[0,50,")
    assert spark.read.text(shared.land(pages.limit(0).select("page", "value"), "none")).count() == 0


def test_a_timeline_is_dealt_out_by_its_bytes(spark, sf, monkeypatch):
    rows = Q._twice(Q._messages(spark, sf).select("id", "member_id"), 50)
    path = shared.land(Q._envelopes(rows.select("page", F.struct("id", "member_id").alias("item")), "messages"), "timeline")
    monkeypatch.setattr(landed, "TASK_BYTES", 2000)
    found = landed.timeline(spark, path)
    assert found.rdd.getNumPartitions() > 10 and found.count() == rows.select("id").distinct().count()


def test_details_are_taken_apart_once(spark, sf):
    assert plan_of(Q.html_details(spark, sf)).count("MapInArrow") == 2  # one a site


def test_rejects_of_an_archive_need_no_page(spark, sf):
    posts, rejects = blogs.full(Q._lists(spark, sf, Q._A_ITEM, "a"), Q._details(spark, sf, "A"), html.site("A", Q.BASE))
    assert plan_of(posts).count("MapInArrow") == 1 and plan_of(rejects).count("MapInArrow") == 0
    assert {r["reason"] for r in rejects.collect()} == {"gone", "error"}


def test_selectors_are_read_once():
    page = markup.parse('<DIV class="a b"><p class="ab">x</p><P Class="b">y</P></DIV>')
    before = markup._options.cache_info().misses
    for _ in range(3):
        assert [x.text() for x in page.select("div P.b")] == ["y"] and page.first(".a").name == "div"
    assert markup._options.cache_info().misses <= before + 2


def test_a_sync_shuffles_by_the_rows_it_has(spark, monkeypatch, tmp_path):
    key = "spark.sql.shuffle.partitions"
    monkeypatch.setattr(shared, "ROWS", 10)
    seen, stage = [], Store.stage
    monkeypatch.setattr(Store, "stage", lambda self, *a, **k: seen.append(int(spark.conf.get(key))) or stage(self, *a, **k))
    monkeypatch.setattr(shared, "tasks_for", lambda spark, rows: -(-rows // 10))
    rows = spark.range(95).selectExpr("1L as group_id", "id", "id % 7 as member_id", "'2024-01-01T00:00:00Z' as published_at", "'text' as type", "'x' as text", "null as is_favorite", "cast(null as string) as file", "cast(null as string) as thumbnail", "'p' as page", "0 as pos")
    before, store = spark.conf.get(key), Store(spark, str(tmp_path))
    assert plan.sync(store, rows).inserted == 95 and store.messages().count() == 95
    assert seen == [10] and spark.conf.get(key) == before


def test_landed_files_are_listed_by_few_tasks(spark):
    pages = spark.range(100).select(F.col("id").alias("page"), F.lit('{"messages": [{"id": 1}]}').alias("value"))
    path, sc = shared.land(pages, "pages"), spark.sparkContext
    sc.setJobGroup("listed", "listed")
    try:
        found = landed.items(spark, path, "messages", schemas.MESSAGE), html.pages(spark, path), jsonp.responses(spark, path)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("listed") for s in status.getJobInfo(j).stageIds]
    assert len(stages) >= 3 and max(x.numTasks for x in stages) <= 4 * sc.defaultParallelism
    assert [x.count() for x in found] == [100, 100, 100]


def test_page_files_are_listed_by_few_tasks(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    pages = spark.range(100).select(F.lit(1).alias("group"), F.col("id").alias("page"), F.concat(F.lit('{"messages": [{"id": '), "id", F.lit(', "member_id": 7, "type": "text", "text": "x"}]}')).alias("value"))
    path, before = shared.land(pages, "pages", "group"), spark.conf.get(key)
    with shared.few_listings(spark):
        query = member_state.start(page_stream(spark, path), str(tmp_path / "store"), str(tmp_path / "checkpoint"))
        query.awaitTermination()
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(str(query.runId)) for s in status.getJobInfo(j).stageIds]
    assert stages and max(x.numTasks for x in stages if x) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before and member_state.state(spark, str(tmp_path / "store")).first()["total_messages"] == 100

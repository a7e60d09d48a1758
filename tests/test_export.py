"""Documents stitched of fragments: the same JSON as documents in rows, however many tasks a member fills."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.test_sync import NOW, message, run
from tidemark.sinks import export
from tidemark.sinks.store import Store

HEADER = "group_id long, id long, name string, group_name string, portrait string, thumbnail string, phone_image string, group_thumbnail string"


@pytest.fixture
def exported(spark, tmp_path):
    def go(messages, headers):
        out, now = tmp_path / "out", F.timestamp_seconds(F.lit(NOW))
        export.export(messages, headers, str(out), now)
        found = {f"{p.parent.parent.name}/{p.parent.name}": json.loads(p.read_text()) for p in out.rglob("*.json")}
        rows = export.documents(messages, headers, now)
        shown = rows.select(F.concat(F.lit("group="), F.col("group_id").cast("string"), F.lit("/member_id="), F.col("member_id").cast("string")).alias("k"), F.to_json(F.struct(*(c for c in rows.columns if c not in ("group_id", "member_id")))).alias("v"))
        assert found == {r["k"]: json.loads(r["v"]) for r in shown.collect()}
        return found

    return go


def test_one_member_over_many_tasks(spark, tmp_path, exported):
    store = Store(spark, str(tmp_path / "s"))
    rows = [message(k, member=1 if k % 10 else 2 + k % 3, at=f"2024-01-{1 + k % 28:02d}T00:00:00Z", text=f'say "{k}"\nあ,]') for k in range(800)]
    run(store, *rows)
    headers = spark.createDataFrame([(1, 1, "n", "g", None, None, None, None)], HEADER)
    found = exported(store.messages().repartition(7), headers)
    assert set(found) == {f"group=1/member_id={m}" for m in (1, 2, 3, 4)}
    own = found["group=1/member_id=1"]
    assert own["total_messages"] == len(own["messages"]) == 720 and own["member"]["name"] == "n" and "member" not in found["group=1/member_id=2"]
    assert [(m["timestamp"], m["id"]) for m in own["messages"]] == sorted((m["timestamp"], m["id"]) for m in own["messages"])
    parts = [p for p in (tmp_path / "out").rglob("*") if p.is_file() and p.suffix != ".crc"]
    assert len(parts) == 4


def test_fragments_of_one_member_lie_in_several_files(spark, tmp_path):
    from tidemark.sinks import fragments

    spark.dataSource.register(fragments.Fragments)
    rows = spark.range(1000).selectExpr("1L as group_id", "5L as member_id", "concat('{\"id\":', id, '}') as json", "id")
    rows.repartitionByRange(4, "id").sortWithinPartitions("id").select("group_id", "member_id", "json").write.format("fragments").mode("append").option("path", f"file:{tmp_path}/f").save()
    index = fragments.written(spark, f"file:{tmp_path}/f").collect()
    assert len({r["file"] for r in index}) == 4 and sum(r["length"] for r in index) > 5000
    heads = spark.createDataFrame([(1, 5, '{"messages":['), (1, 6, '{"messages":[')], "group_id long, member_id long, head string")
    sizes = {r["member_id"]: r["bytes"] for r in fragments.stitch(heads, f"file:{tmp_path}/f", f"file:{tmp_path}/d", "]}").collect()}
    for member, expected in ((5, list(range(1000))), (6, [])):
        path = tmp_path / f"d/group=1/member_id={member}/part-00000.json"
        assert [x["id"] for x in json.loads(path.read_text())["messages"]] == expected and path.stat().st_size == sizes[member]


def test_nothing_to_export(spark, tmp_path, exported):
    empty = Store(spark, str(tmp_path / "s")).messages()
    assert exported(empty, spark.createDataFrame([], HEADER)) == {}

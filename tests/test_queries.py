"""Every library query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

from tidemark import landed_queries, queries  # noqa: F401
from tidemark.operators import filters

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def compare(spark, connection, run, sql, sf):
    import duckdb  # noqa: F401

    df = run(spark, sf)
    names = sorted(df.columns)
    found = sorted([same(r[n]) for n in names] for r in df.collect())
    relation = connection.sql(sql)
    at = [relation.columns.index(n) for n in names]
    expected = sorted([same(r[k]) for k in at] for r in relation.fetchall())
    assert sorted(relation.columns) == names
    assert found == expected


@pytest.fixture(scope="module")
def connection():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"/root/testdata/sf0.001/{t}.parquet"):
            c.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, connection, sf, name):
    compare(spark, connection, queries.QUERIES[name], queries.ORACLES[name], sf)


def test_entry(spark, sf):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scans_read_only_what_they_need(spark, sf):
    plan = queries.message_type_counts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan
    events = spark.read.parquet(f"{sf}/events.parquet").withColumnRenamed("user_id", "member_id")
    plan = filters.of_member(events, 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,7)" in plan

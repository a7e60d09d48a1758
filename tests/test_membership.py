"""Membership filters: none of their own keys is missed, few others pass, and results are the exact join's."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, membership as m


def mixed(n, start=0):
    """Different 64-bit numbers that look like hashes."""
    x = np.arange(start, start + n, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


@pytest.mark.parametrize("keys", [1, 1000, 1_000_000, 100_000_000])
def test_false_positives_at_any_size(keys):
    """The rate stays below one of 150; at 100 million keys the filter has 200 MB."""
    found = m.Membership.empty(keys)
    for s in range(0, keys, 1 << 20):
        found.add(mixed(min(1 << 20, keys - s), s))
    assert found.words.nbytes <= keys * m.BITS / 8 + 32
    own = mixed(min(keys, 200_000), max(0, keys - 200_000))
    assert found.may_have(own).all()
    assert found.may_have(mixed(500_000, 1 << 40)).mean() < 1 / 150


def test_spark_builds_the_same_filter(spark):
    keys = spark.range(20_000).selectExpr("if(id % 7 = 0, null, concat('k', id)) as k", "id").repartition(5)
    found = m.membership(keys, "k")
    hashes = np.array([r["h"] for r in keys.select(m.hashed("k").alias("h")).where("h is not null").collect()], np.int64)
    plain = m.Membership.empty(20_000)
    plain.add(hashes)
    assert (found.words == plain.words).all() and found.may_have(hashes).all()


@pytest.mark.parametrize("max_bytes", [m.MAX_BYTES, 100])
def test_joins_are_exact(spark, max_bytes):
    df = spark.createDataFrame([(k % 50 if k % 10 else None, f"v{k}") for k in range(300)], "k long, v string")
    seen = spark.createDataFrame([(k,) for k in (1, 2, 3, 3, 44, 1000, None)], "k long")
    rows = lambda x: sorted(map(str, x.collect()))
    assert rows(m.unseen(df, seen, ["k"], max_bytes=max_bytes)) == rows(df.join(seen, "k", "left_anti"))
    assert rows(m.within(df, seen, ["k"], max_bytes=max_bytes)) == rows(df.join(seen, "k", "left_semi"))
    for empty in (df.limit(0), df):
        assert rows(m.unseen(empty, seen.limit(0), ["k"])) == rows(empty)
        assert rows(m.within(empty, seen.limit(0), ["k"])) == []


def test_few_rows_reach_the_join(spark):
    """Of 20,000 unseen rows at most one of a hundred is dealt out."""
    df, seen = spark.range(20_000).withColumnRenamed("id", "k"), spark.range(1_000_000, 1_050_000).withColumnRenamed("id", "k")
    passed = df.where(m.may_belong(df, m.membership(seen, "k"), "k")).count()
    assert passed < 200 and m.unseen(df, seen, ["k"]).count() == 20_000


def test_media_queue_filtered(spark):
    messages = spark.createDataFrame([(1, 1, k, "image", f"https://h/{k}.png") for k in range(40)] + [(1, 1, 99, "text", None)], "group_id long, member_id long, id long, raw_type string, media_url string")
    present = spark.createDataFrame([(f"m/picture/{k}.png",) for k in range(0, 40, 4)], "path string")
    one, two = (sorted(map(str, joins.media_queue(messages, present, F.lit("m"), filtered=x).collect())) for x in (False, True))
    assert one == two and len(one) == 30

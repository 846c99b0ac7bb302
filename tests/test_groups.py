"""Medians and lists of groups, in the plain and in the spread-out way."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from docgraph.plans.groups import collect_pages, exact_median
from docgraph.plans.skew import find_hot_keys, join_skewed


def test_exact_median(spark):
    rng = random.Random(3)
    rows = [("hot", float(rng.randint(0, 40))) for _ in range(501)] + [("same", 7.0)] * 100 + [("even", x) for x in (1.0, 9.0, 2.0, 4.0)]
    rows += [("one", 3.5), ("none", None), (None, 1.0), (None, 2.0)]
    rows += [(f"k{i}", rng.random()) for i in range(40) for _ in range(rng.randint(1, 6))]
    got = exact_median(spark.createDataFrame(rows, "k string, x double"), ["k"], "x").collect()
    expected = {k: statistics.median(x for key, x in rows if key == k and x is not None) for k in {k for k, _ in rows} - {"none"}}
    assert {r.k: pytest.approx(r.median) for r in got} == expected


def test_median_of_large_groups(spark):
    """Groups far larger than a sketch, in an order that is hard on it, with many ties and with few."""
    rows = spark.range(0, 300_001, 1, 7).selectExpr("IF(id % 3 = 0, 'a', IF(id % 3 = 1, 'b', 'c')) AS k", "id")
    rows = rows.selectExpr("k", "CASE k WHEN 'a' THEN (id * 7919) % 300007 WHEN 'b' THEN id % 5 ELSE -id END + 0.25D AS x")
    got = {r.k: r.median for r in exact_median(rows, ["k"], "x").collect()}
    own: dict = {}
    for r in rows.collect():
        own.setdefault(r.k, []).append(r.x)
    assert got == {k: statistics.median(x) for k, x in own.items()}
    nan = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0), (2, float("inf")), (2, float("-inf")), (2, 0.0)], "k int, x double")
    assert {r.k: r.median for r in exact_median(nan, ["k"], "x").collect()} == {1: 3.0, 2: 0.0}


def test_median_of_large_values(spark):
    df = spark.createDataFrame([(1, 2**63 - 1), (1, 2**63 - 3), (2, -(2**63))], "k int, x long")
    got = {r.k: r.median for r in exact_median(df, ["k"], "x").collect()}
    assert got == {1: float(2**63), 2: -float(2**63)}


def test_pages_are_whole_and_in_order(spark):
    df = spark.range(0, 9000, 1, 3).selectExpr("IF(id % 10 = 3, 'a', IF(id % 10 = 4, 'b', 'c')) AS k", "id")
    pages = collect_pages(df, ["k"], F.col("id"), "ids", 100).collect()
    assert sorted(i for p in pages for i in p.ids) == list(range(9000))
    for k in "abc":
        own = sorted((p.page, p.ids) for p in pages if p.k == k)
        assert [n for n, _ in own] == list(range(len(own))) and [len(ids) for _, ids in own[:-1]] == [100] * (len(own) - 1)
        assert [i for _, ids in own for i in ids] == sorted(i for _, ids in own for i in ids)
    small = collect_pages(df.filter("id < 50"), ["k"], F.col("id"), "ids", 100).collect()
    assert [p.page for p in small] == [0, 0, 0]


def test_hot_keys_are_few_and_split(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 1L ELSE id + 10 END AS key", "id")
    assert not find_hot_keys(rows, "key").salted
    hot = find_hot_keys(rows, "key", 10)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = 3000 // partitions
    assert hot.rows == 3000 and hot.splits == [(1, -(-1000 // share))]
    spread = hot.scatter(rows, "key", "id").filter("key = 1").groupBy("_salt").count().collect()
    assert len(spread) == hot.splits[0][1] and max(r["count"] for r in spread) < 1000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_with_hot_keys_equals_plain_join(spark, how):
    large = spark.range(600).selectExpr("CASE WHEN id % 2 = 0 THEN 1L WHEN id % 7 = 0 THEN NULL ELSE id END AS key", "id")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "key long, name string")
    hot = find_hot_keys(large, "key", 10)
    assert hot.salted
    got = join_skewed(large, small, "key", hot, "id", how)
    expected = large.join(small, "key", how)
    assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))

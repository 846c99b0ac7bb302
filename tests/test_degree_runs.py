"""Degree statistics and run summaries on small hand-made tables."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from docgraph.operators import degree, profile, relational, runs


def test_degrees(spark):
    edges = spark.createDataFrame([(1, 1), (1, 2), (3, 1), (None, 3), (4, None)], "source long, target long")
    got = [tuple(r) for r in degree.degree_distribution(edges).collect()]
    assert got == [(1, 4), (3, 2), (2, 1), (4, 1)]
    frequencies = degree.degree_frequencies(degree.degree_distribution(edges))
    assert tuple(degree.degree_summary(frequencies).first()) == (4, 1, 4, 2.0, 1.5)
    assert {r.degree: r.p for r in degree.degree_ccdf(frequencies).collect()} == {4: 0.25, 2: 0.5, 1: 1.0}
    bins = degree.degree_log_histogram(frequencies).orderBy("bin").collect()
    assert len(bins) == 49 and sum(b.vertices for b in bins) == 4
    assert bins[0].lo == 1.0 and bins[0].vertices == 2 and bins[-1].hi == pytest.approx(5.0)
    assert all(a.hi == b.lo for a, b in zip(bins, bins[1:]))


def test_degrees_json(spark, tmp_path):
    degrees = spark.createDataFrame([("a", 3), ("b", 9), ("c", 3)], "source string, cnt long")
    degree.degrees_json(degrees, str(tmp_path / "d"))
    texts = [line for f in sorted((tmp_path / "d").glob("part-*")) for line in f.read_text().splitlines()]
    assert texts == ['{"cnt":9}', '{"cnt":3}', '{"cnt":3}']


RUNS = [
    # start, depth, direction, run, latency, edges, nodes, error
    (1, 0, "uni", 1, 5.0, 10, 4, None),
    (1, 0, "uni", 2, None, None, None, "late"),
    (1, 0, "uni", 3, 7.0, 11, 5, None),
    (2, 0, "uni", 1, None, None, None, "gone"),
    (2, 0, "uni", 2, None, None, None, "lost"),
    (3, 0, "uni", 1, 2.0, 1, 1, None),
    (1, 3, "bi", 1, 4.0, 2, 2, None),
]
LAYOUT = "start_value long, max_depth int, direction string, run_no long, latency_ms double, edge_count long, node_count long, error string"


def test_run_summaries(spark, tmp_path):
    table = spark.createDataFrame(RUNS, LAYOUT)
    medians = runs.run_config_median(table)
    got = {r.start_value: r for r in medians.filter("max_depth = 0").collect()}
    assert (got[1].median_latency_ms, got[1].edge_count, got[1].node_count, got[1].error) == (6.0, 11, 5, "late")
    assert (got[2].median_latency_ms, got[2].edge_count, got[2].error) == (0.0, 0, "lost")
    row = runs.run_summary(medians).filter("max_depth = 0").first()
    assert (row.avg_latency_ms, row.median_latency_ms, row.min_latency_ms, row.max_latency_ms) == (
        statistics.mean([6, 0, 2]),
        2.0,
        0.0,
        6.0,
    )
    assert (row.avg_edge_count, row.num_tests) == (4.0, 3)
    assert runs.run_summary(medians, exclude_failed=True).filter("max_depth = 0").first().num_tests == 2
    shown = runs.summary_table(runs.run_summary(medians), ["bi", "uni"], [3, 0]).collect()
    assert [(r.direction, r.max_depth, r.avg_latency_ms) for r in shown] == [("bi", 3, 4.0), ("uni", 0, 2.67)]
    assert runs.summary_table(runs.run_summary(medians), ["uni"], [3]).count() == 0
    lists = {(r.start_value, r.max_depth): r.all_latencies_ms for r in runs.run_latencies(table).collect()}
    assert lists == {(1, 0): [5.0, 7.0], (3, 0): [2.0], (1, 3): [4.0]}
    runs.json_report(runs.run_summary(medians), runs.run_details(medians), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "details")).count() == 4


def test_multi_summary_takes_the_first_record(spark):
    medians = spark.createDataFrame(
        [("uni", 1, 5.0, 1, 1, 7), ("uni", 1, 3.0, 2, 2, 4), ("uni", 2, 1.0, 3, 3, 1)],
        "direction string, num_start_values int, median_latency_ms double, edge_count long, node_count long, first_run long",
    )
    rows = runs.run_summary_multi(medians).orderBy("num_start_values").collect()
    assert [(r.median_latency_ms, r.edge_count) for r in rows] == [(3.0, 2), (1.0, 3)]


def test_long_value_lists_become_a_join(spark):
    df = spark.range(5000)
    assert relational.filter_in(df, "id", range(0, 4000, 2)).count() == 2000
    assert relational.filter_in(df, "id", [1, 2, 99999]).count() == 2


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", float("nan")), (None, "b", 1.0), (3, None, None)], "`a.b` long, s string, x double")
    assert tuple(profile.profile_shape(df).first()) == (3, 3)
    assert {r["column"]: r.nulls for r in profile.profile_nulls(df).collect()} == {"a.b": 1, "s": 1, "x": 2}
    assert {(r["column"], r.dtype, r.non_null) for r in profile.profile_dtypes(df).collect()} == {
        ("a.b", "bigint", 2),
        ("s", "string", 2),
        ("x", "double", 2),
    }
    assert profile.profile_head(df.filter(F.col("s").isNotNull()), "s", 1).first().s == "a"


def test_filter_in_prunes_the_scan(spark, tmp_path):
    spark.range(10_000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    for values in ([5, 7, 9], range(0, 3000, 2), ["5", "7"]):
        found = relational.filter_in(table, "id", values)
        plan = found._jdf.queryExecution().toString()
        assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan
        assert found.count() == len(values)


def test_filter_in_takes_any_list(spark):
    df = spark.range(10).selectExpr("id AS x", "CAST(id AS STRING) AS k", "id * 2 AS y")
    for values in (["1", "2", "none"], [1, "2", None], [1, 2], [1.0, 2.0, 2.5]):
        found = relational.filter_in(df, "x", values)
        assert found.columns == ["x", "k", "y"] and sorted(r.x for r in found.collect()) == [1, 2]
    assert relational.filter_in(df, "x", []).count() == 0
    assert relational.filter_in(df, "k", [str(n) for n in range(2, 5000)]).count() == 8


def test_report_has_settings_and_latencies(spark, tmp_path):
    log = spark.createDataFrame(
        [(1, 0, "uni", n, float(n), 5, 6, None) for n in range(5)] + [(2, 0, "uni", 9, None, None, None, "failed")],
        "start_value long, max_depth int, direction string, run_no long, latency_ms double, edge_count long, node_count long, error string",
    )
    medians = runs.run_config_median(log)
    details = runs.run_details(medians, log, page_rows=2)
    got = sorted((r.start_value, r.page, r.all_latencies_ms) for r in details.collect())
    assert got == [(1, 0, [0.0, 1.0]), (1, 1, [2.0, 3.0]), (1, 2, [4.0]), (2, 0, [])]
    runs.json_report(runs.run_summary(medians), details, str(tmp_path / "r"), {"depths": [0], "runs": 5})
    head = spark.read.json(str(tmp_path / "r" / "benchmark")).first()
    assert head.timestamp and head.config.depths == [0] and head.config.runs == 5
    assert spark.read.json(str(tmp_path / "r" / "details")).count() == 4


def test_batches_refer_to_pages_of_starts(spark):
    log = spark.createDataFrame(
        [(n, "uni", run, float(run), 1, 1, None) for n in (1, 3, 5) for run in (1, 2, 3)] + [(9, "uni", 1, None, None, None, "lost")],
        "num_start_values int, direction string, run_no int, latency_ms double, edge_count long, node_count long, error string",
    )
    ranked = spark.createDataFrame([(100 + rank, rank) for rank in range(1, 6)], "start long, rank int")
    details = runs.run_details(runs.run_batch_median(log), log, runs.BATCH, ranked, page_rows=2)
    got = sorted((r.num_start_values, r.page, r.start_values, r.all_latencies_ms) for r in details.collect())
    assert got == [
        (1, 0, [101], [1.0, 2.0]),
        (1, 1, [], [3.0]),
        (3, 0, [101, 102], [1.0, 2.0]),
        (3, 1, [103], [3.0]),
        (5, 0, [101, 102], [1.0, 2.0]),
        (5, 1, [103, 104], [3.0]),
        (5, 2, [105], []),
        (9, 0, [101, 102], []),
        (9, 1, [103, 104], []),
        (9, 2, [105], []),
    ]
    plan = details._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = runs.run_details(runs.run_batch_median(log), None, runs.BATCH, ranked.limit(0)).collect()
    assert sorted((r.num_start_values, r.page, r.start_values) for r in none) == [(1, 0, []), (3, 0, []), (5, 0, []), (9, 0, [])]

from __future__ import annotations

import math

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph.llm import nearest


def brute(rows, step, k, scale=1024):
    smallest = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) or abs(x * scale) > nearest.LARGEST for x in v):
            continue
        whole = [int(np.floor(float(np.float32(x)) * scale)) for x in v]
        smallest[i] = min(smallest.get(i, whole), whole)
    out = []
    for q in (i for i in smallest if i % step == 0):
        scores = [(-sum(a * b for a, b in zip(smallest[q], v)), i) for i, v in smallest.items() if i != q and len(v) == len(smallest[q])]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def search(spark, rows, step=5, k=4):
    frame = spark.createDataFrame([(i, v, 1, "r") for i, v in rows], "vec_id bigint, embedding array<float>, score int, rank string").repartition(3)
    found = nearest.top_k(frame, F.col("vec_id") % step == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block,pivots", [(16_384, 64), (20, 7)])
def test_against_brute_force(spark, monkeypatch, block, pivots):
    """Clusters, a vector that many rows share, ties, nulls, non-finite values, other lengths, rows that share an id."""
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "PIVOTS", pivots)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(k, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for k in range(250)]
    rows += [(1000 + k, [1.0, 0.5, 0.25, 0.0, -1.0, 2.0]) for k in range(120)]
    rows += [(2000, None), (2005, []), (2010, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2015, [float("nan")] * 6), (2020, [float("inf")] * 6)]
    rows += [(3000, [1.0, 2.0]), (3005, [2.0, 1.0]), (3010, [0.5]), (None, [1.0] * 6), (4000, [1e30] * 6), (4005, [-0.0005] * 6)]
    rows += [(5000, [1.0] * 6), (5000, [1.0] * 6), (5005, [3.0] * 6), (5005, [-3.0] * 6)]
    assert search(spark, rows) == brute(rows, 5, 4)


def test_few_rows_and_empty_table(spark):
    assert search(spark, []) == []
    assert search(spark, [(5, [1.0])]) == []
    rows = [(5, [1.0]), (6, [2.0]), (10, [1.0])]
    assert search(spark, rows) == brute(rows, 5, 4)


def test_far_cells_are_not_visited(spark):
    """Two distant groups on one line: the bounds exclude the far one."""
    pivots = nearest.Pivots([[1000, 0], [-1000, 0]])
    summary = {(2, 0): (50, 10.0), (2, 1): (50, 10.0)}
    visits = nearest._worth_visiting(pivots, summary, 10)
    frame = spark.createDataFrame([([900, 0],), ([-900, 5],), ([0, 3],)], "v array<bigint>")
    assert [r[0] for r in frame.select(visits("v")).collect()] == [[0], [1], [0, 1]]


def test_products_beyond_the_range_of_floats_are_exact():
    a = np.array([[2**27, 1], [3, -(2**27)]], np.int64)
    assert nearest._products(a, a).tolist() == [[2**54 + 1, 2 * 2**27], [2 * 2**27, 2**54 + 9]]


def test_large_finite_components(spark):
    vectors = {0: [1.0, 0.5], 1: [1.0, 200_000.0], 2: [-3.0e6, 4.0e6], 3: [1.0e12, -1.0e3], 4: [2.0**-10, 3.0], 5: [float("inf"), 1.0], 6: [1.0, None]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.top_k(frame, F.col("vec_id") <= 1, k=3).collect()]
    whole = {i: [math.floor(x * 1024) for x in v] for i, v in vectors.items() if i < 5}
    expected = []
    for q in (0, 1):
        scores = sorted(((sum(a * b for a, b in zip(whole[q], v)), -i) for i, v in whole.items() if i != q), reverse=True)[:3]
        expected += [(q, k + 1, -i, score) for k, (score, i) in enumerate(scores)]
    assert sorted(found) == expected

from __future__ import annotations

import random

import numpy as np
import pytest

from docgraph.llm import near_duplicates as nd
from tests.llm.helpers import documents, least_reachable, sentence, shingles


def brute(rows, size, percent):
    sets = {d: shingles(t, size) for d, t in rows}
    ids = [d for d in sets if sets[d]]
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = least_reachable(sets, links)
    return {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size,percent,block", [(3, 85, 512), (5, 80, 16)])
def test_against_brute_force(spark, monkeypatch, size, percent, block):
    """Copies, near copies around the threshold in one large group, chains and unrelated texts; also with many blocks."""
    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(size)
    base, chain = sentence(rng, 120), sentence(rng, 80)
    rows = [(k, edited(rng, base, rng.randrange(0, 9))) for k in range(140)]
    rows += [(200 + k, base) for k in range(20)]
    for k in range(25):  # each step is close to the one before, the ends are far apart
        chain = edited(rng, chain, 1)
        rows.append((300 + k, chain))
    rows += [(400 + k, sentence(rng, rng.randrange(0, 60))) for k in range(60)]
    rows += [(500, base.upper()), (501, base.replace(" ", "\t\n ")), (502, ""), (503, None), (504, " \x0b"), (505, "one two"), (506, "One  TWO")]
    found = nd.near_duplicates(documents(spark, rows), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, size, percent)
    assert len(found) == len(rows)


def test_nulls_repeats_and_empty_table(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (None, text), (7, text), (8, None), (8, None), (9, "")]
    found = nd.near_duplicates(documents(spark, rows), 3, 85).collect()
    told = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    assert told == sorted(
        [(1, 6, 1, True), (1, 6, 1, True), (None, 6, None, True), (None, 6, None, True), (7, 6, 1, False), (8, 0, 8, True), (8, 0, 8, True), (9, 0, 9, True)],
        key=str,
    )
    assert nd.near_duplicates(documents(spark, []), 3, 85).collect() == []
    stay = nd.without_near_duplicates(documents(spark, rows), 3, 80)
    assert stay.columns == documents(spark, rows).columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["1", "8", "9", "None", "None"]


def test_very_long_text(spark):
    rng = random.Random(5)
    long = sentence(rng, 300_000, 10**6)
    found = nd.near_duplicates(documents(spark, [(1, long), (2, long + " end"), (3, "short text here")]), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for n in (1, 3, 20, 400, 5000):
        for share in (0.0, 0.3, 0.8, 1.0):
            common = rng.integers(1 << 63, size=n, dtype=np.uint64)
            extra = rng.integers(1 << 63, size=int(n * (1 - share)), dtype=np.uint64)
            one, two = np.unique(common), np.unique(np.concatenate([common[: len(common) - len(extra)], extra]))
            a, b = nd.super_minhash([one, two], 128)
            truth = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
            errors.append(abs((a == b).mean() - truth))
            assert (a < 128 << 24).all()
    assert max(errors) < 0.16 and np.mean(errors) < 0.04


def test_a_single_element_visits_every_component_once():
    (signature,) = nd.super_minhash([np.array([7], np.uint64)], 125)
    assert sorted(int(v) >> 24 for v in signature) == list(range(125))


def test_early_stop_changes_nothing(monkeypatch):
    """Signatures do not depend on the company of a set."""
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(1 << 63, size=n, dtype=np.uint64)) for n in (0, 2, 50, 3000, 1, 700)]
    together = nd.super_minhash(sets, 100)
    for k, s in enumerate(sets):
        assert (nd.super_minhash([s], 100)[0] == together[k]).all()


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.85, 0.95])
def test_bands_reach_the_miss_rate(threshold):
    bands, rows = nd.bands_for(threshold)
    assert (1 - threshold**rows) ** bands <= nd.MISS and bands * rows <= nd.MAX_COMPONENTS


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 200)] + [(500, 500 + k) for k in range(1, 60)] + [(9, 9), (3, 1)]
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    found = {r.node: r.root for r in nd.components(frame, "a", "b").collect()}
    nodes = {n for pair in links for n in pair} - {9}
    assert found == {n: r for n, r in least_reachable(nodes, [p for p in links if p[0] != p[1]]).items()}
    assert nd.components(frame.filter("a < 0"), "a", "b").collect() == []

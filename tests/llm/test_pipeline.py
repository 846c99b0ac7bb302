"""The pipeline's stages on a small corpus with planted cases, each on what the one before kept."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docgraph.plans.scratch import scratch_path
from tests.llm.helpers import least_reachable, shingles
from tests.llm.test_classifiers import INSULTS, SYLLABLES, prose


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(21)
    folder = scratch_path(spark, "corpus")
    rows, labels = [], []
    for k in range(900):
        lang = rng.choice(list(SYLLABLES))
        toxic = int(rng.random() < 0.2)
        words = prose(rng, lang, rng.randrange(20, 60)).split()
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((k, " ".join(words), lang))
        if k % 4:
            labels.append((k, 0, toxic))
    clean = [r for r, x in zip(rows, range(900)) if not any(i in r[1] for i in INSULTS)]
    items = [(k, prose(rng, "bb", 25)) for k in range(5)]
    rows += [(1000 + k, clean[k][1], clean[k][2]) for k in range(30)]  # copies
    rows += [(1100 + k, clean[k][1] + " ka", clean[k][2]) for k in range(30)]  # near copies
    rows += [(1200 + k, prose(rng, "bb", 30) + " " + items[k][1] + " " + prose(rng, "bb", 30), "bb") for k in range(5)]
    rows += [(1300, None, None), (1301, "", None), (1302, "12 !!", None), (None, prose(rng, "aa", 40), "aa"), (5, rows[5][1], rows[5][2])]
    full = [(d, t, lang, "s", len(t or ""), 1.5) for d, t, lang in rows]
    spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        path = scratch_path(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        assert not set(after) - set(before)
        gone = [r for r in before if r not in set(after)]
        if name == "language_id":
            assert {1300, 1301, 1302} <= {r.doc_id for r in gone} and len(gone) < 10
        if name == "toxicity":
            toxic = [r for r in before if any(i in r.text for i in INSULTS)]
            assert len(set(toxic) & set(gone)) > 0.9 * len(toxic) and len(set(gone) - set(toxic)) < 0.02 * len(before)
        if name == "near_dedup":
            sets = {r.doc_id: shingles(r.text, 5) for r in before if r.doc_id is not None}
            ids = sorted(sets)
            links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            root = least_reachable(ids, links)
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == [d for d in ids if root[d] == d]
            assert sum(r.doc_id is None for r in after) == 1 and len(links) > 50
        if name == "decontamination":
            assert {r.doc_id for r in gone} == {r.doc_id for r in before if any(t in r.text for _, t in items)}
            assert len(gone) == 5
        kept[name] = before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in before}
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((str(r.doc_id), r.length) for r in whole.groupBy("doc_id").agg(F.sum("length").alias("length")).collect()) == sorted(
        (str(d), n) for d, n in {r.doc_id: r.doc_tokens for r in pieces}.items()
    )


def test_empty_documents(spark, corpus):
    folder = corpus[0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(f"{folder}/documents.parquet").limit(0), folder).collect() == []


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "packing"]
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"

"""Language identification and toxicity: held-out accuracy on made-up labelled texts, folds, and odd input."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docgraph.llm import language, toxicity
from docgraph.llm.ngrams import hashed_ngrams, letters_only
from docgraph.llm.training import fold, held_out, sample_per_class
from tests.llm.helpers import documents

SYLLABLES = {"aa": "ka ri to mu ne so", "bb": "sch ver ung lich ein keit", "cc": "ção não lhe que os çõe"}
INSULTS = ["blörg", "snarfle", "quibzot"]


def prose(rng, lang, words):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def is_held_out(k):
    return zlib.crc32(str(k).encode()) % 4 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for k in range(700):
        lang = rng.choice(list(SYLLABLES))
        out.append((k, prose(rng, lang, rng.randrange(3, 60)).capitalize() + ".", lang))
    return out


ODD = [(9001, None), (9002, ""), (9003, "123 --- !!"), (9004, " \n"), (None, "karito mune so"), (9001, None), (9005, "x"), (9006, "日本語")]


def test_language_on_held_out_texts(spark, rows):
    docs = documents(spark, rows + ODD)
    told = language.identify_language(docs, language.train_language_model(docs))
    assert set(docs.columns) <= set(told.columns) and len(set(told.columns)) == len(told.columns)
    found = told.collect()
    assert len(found) == len(rows) + len(ODD)
    by_id = {r.doc_id: r for r in found}
    test = [r for r in rows if is_held_out(r[0])]
    assert sum(by_id[d].lang_pred == lang for d, _, lang in test) / len(test) > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    accepted = sum(by_id[d].lang_accepted for d, _, _ in rows) / len(rows)
    assert accepted > 0.98
    for d in (9001, 9002, 9003, 9004):
        assert (by_id[d].lang_pred, by_id[d].score, by_id[d].lang_accepted) == ("und", 0.0, False)
    assert by_id[None].lang_pred == "aa" and by_id[9006].lang_pred in SYLLABLES


def test_language_learns_nothing_from_held_out_rows(spark, rows):
    """Wrong languages on held-out rows, other sources and ids of no meaning change no prediction."""
    wrong = [(d, t, "zz" if is_held_out(d) else lang) for d, t, lang in rows]
    models = [language.train_language_model(documents(spark, x)) for x in (rows, wrong)]
    assert models[0].languages == models[1].languages and (models[0].table == models[1].table).all()
    assert language.train_language_model(documents(spark, [(d, t, lang) for d, t, lang in rows if is_held_out(d)])) is None
    nothing = language.identify_language(documents(spark, rows[:5]), None).collect()
    assert {(r.lang_pred, r.score, r.lang_accepted) for r in nothing} == {("und", 0.0, False)}


def test_scores_of_whole_texts_do_not_depend_on_the_batch(spark, rows):
    model = language.train_language_model(documents(spark, rows))
    long = " ".join(t for _, t, lang in rows if lang == "bb") * 200
    texts = [long, "karito", None, long[: len(long) // 2], ""]
    together = model.probabilities(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert np.allclose(model.probabilities(pa.array([text], pa.string()))[0], together[k])
    assert model.languages[int(together[0].argmax())] == "bb"


@pytest.fixture(scope="module")
def labelled(rows):
    rng = random.Random(13)
    docs, labels = [], []
    for d, text, lang in rows * 2:
        d = len(docs)
        toxic = int(rng.random() < 0.2)
        words = text.split()
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS))
        docs.append((d, " ".join(words), lang))
        labels.append((d, 0, toxic))
    return docs, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_toxicity_on_held_out_texts(spark, labelled):
    docs, labels = labelled
    frame = documents(spark, docs + ODD)
    extra = [(7, 0, None), (None, 0, 1), (99_999, 0, 1), (labels[0][0], 1, labels[0][2])]
    model = toxicity.train_toxicity_model(frame, spark.createDataFrame(labels + extra, LABELS))
    told = toxicity.score_toxicity(frame, model)
    assert told.columns == [*frame.columns, "predicted"]
    found = {r.doc_id: r for r in told.collect()}
    test = [x for x in labels if is_held_out(x[0])]
    right = [found[d].predicted == toxic for d, _, toxic in test]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values()) and found[9001].predicted == found[9002].predicted == 0


def test_whole_texts_are_scored(spark, labelled):
    docs, labels = labelled
    frame = documents(spark, docs)
    model = toxicity.train_toxicity_model(frame, spark.createDataFrame(labels, LABELS))
    clean = prose(random.Random(1), "aa", 100)
    texts = [clean, clean + " quibzot", None, "quibzot snarfle", prose(random.Random(1), "aa", 200_000)]
    scores = model.scores(pa.array(texts, pa.string()))
    assert scores[0] < 0.3 <= scores[1] and scores[2] < 0.3 <= scores[3] and scores[4] < 0.3
    assert np.allclose(model.scores(pa.array(texts[1:2])), scores[1:2])


def test_toxicity_without_labels_of_both_classes(spark, labelled):
    frame = documents(spark, labelled[0][:20])
    for labels, score in (([], 0.0), ([(0, 0, 0), (1, 0, 0), (2, 0, 0)], 0.0), ([(k, 0, 1) for k in range(20)], 1.0)):
        model = toxicity.train_toxicity_model(frame, spark.createDataFrame(labels, LABELS))
        assert {round(r.score, 6) for r in toxicity.score_toxicity(frame, model).collect()} == {score}
    empty = toxicity.score_toxicity(documents(spark, []), model)
    assert empty.collect() == []


def test_folds_and_samples(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "rare").otherwise("common").alias("label"))
    folds = {r.doc_id: (r.fold, r.held) for r in frame.select("doc_id", fold(F.col("doc_id")).alias("fold"), held_out(F.col("doc_id")).alias("held")).collect()}
    assert all(v == (zlib.crc32(str(k).encode()) % 4, is_held_out(k)) for k, v in folds.items())
    sample = {r.label: r.n for r in sample_per_class(frame, "label", 500).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sample["rare"] == 100 and 400 < sample["common"] < 600


def test_ngrams_stay_within_words_and_texts():
    texts = ["Ab, cd", "", None, "éa", "x"]
    raw, offsets = letters_only(pa.array(texts, pa.string()))
    padded = [" ab  cd ", "  ", "  ", " éa ", " x "]
    assert raw.tobytes().decode() == "".join(padded)
    for size in (2, 3, 4):
        found, bounds = hashed_ngrams(raw, offsets, size, 1 << 40)
        for k, text in enumerate(padded):
            data = text.encode()
            grams = [data[i : i + size] for i in range(len(data) - size + 1)]
            grams = [g for g in grams if b" " not in g[1:-1] and g != b"  "]
            assert len(set(found[bounds[k] : bounds[k + 1]].tolist())) == len(set(grams))
            assert bounds[k + 1] - bounds[k] == len(grams)

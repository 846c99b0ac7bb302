"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords (n-grams of letters within a word and its bounds, hashed to
``BUCKETS`` rows of an embedding table); a linear layer and a softmax give the probability of each language. Table and layer are
trained together by stochastic gradient descent in numpy on a sample of bounded size. Part of the sample is kept for calibration: a
temperature is fitted to it, and the score below which at most ``REJECTED`` of its texts lie becomes the rejection
threshold, unless it is above ``CERTAIN``, which then is the threshold.

As the layer is linear, embedding table times layer is one table of a value per bucket and language, so scoring a whole text is a sum
of table rows, vectorised over many texts.

Defined results: a null text or one without a letter is ``und`` with score 0 and not accepted. If there is nothing to learn
from, every text is. Rows pass one by one, so repeated rows, null ids and extra columns stay as they are; a
column of ``docs`` named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm.ngrams import hashed_ngrams, letters_only, row_sums
from docgraph.llm.text import slices, small_batches
from docgraph.llm.training import fold, sample_per_class

# Bounds of the sample the classifier is fitted on, in texts of a language and in languages (the most frequent ones).
TEXTS_PER_LANGUAGE = 1000
MOST_LANGUAGES = 200
SIZES = (2, 3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 12
BATCH = 32
# Share of texts in a learned language that may be rejected, and the score from which none is.
REJECTED = 0.002
CERTAIN = 0.8

_LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings times layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        raw, offsets = letters_only(texts)
        sums, counts = 0, 0
        for size in SIZES:
            found, bounds = hashed_ngrams(raw, offsets, size, BUCKETS)
            sums = sums + row_sums(self.table[found], bounds)
            counts = counts + np.diff(bounds)
        return _softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each whole text with their counts: at most ``BUCKETS`` pairs a text."""
    for part in slices(batches, "text"):
        raw, offsets = letters_only(part.column("text"))
        grams = [hashed_ngrams(raw, offsets, size, BUCKETS) for size in SIZES]
        for k in range(part.num_rows):
            found, times = np.unique(np.concatenate([g[b[k] : b[k + 1]] for g, b in grams]), return_counts=True)
            lists = [pa.array([v.astype(np.int32)], pa.list_(pa.int32())) for v in (found, times)]
            yield pa.RecordBatch.from_arrays([part.column("lang").slice(k, 1).cast(pa.string()), *lists], ["lang", "found", "times"])


def train_language_model(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, seed: int = 7) -> LanguageModel | None:
    """Fit on documents with a language whose fold is not 2; None if there are none."""
    small_batches(docs.sparkSession)
    rows = docs.filter(fold(F.col("doc_id")) != 2).select("doc_id", "text", "lang")
    sample = sample_per_class(rows, "lang", per_language).filter("text is not null")
    sample = sample.mapInArrow(_counted, "lang string, found array<int>, times array<int>").toArrow()
    found = [np.asarray(x.values, np.int32) for x in sample.column("found") if len(x.values)]
    times = [np.asarray(x.values, np.float32) for x in sample.column("times") if len(x.values)]
    names = [n for n, x in zip(sample.column("lang").to_pylist(), sample.column("found")) if len(x.values)]
    languages = sorted(sorted(set(names)), key=names.count, reverse=True)[:MOST_LANGUAGES]
    if not languages:
        return None
    # The order in which rows arrive depends on the cluster; a model must not.
    order = sorted((i for i in range(len(names)) if names[i] in set(languages)), key=lambda i: (names[i], found[i].tobytes(), times[i].tobytes()))
    found = [found[i] for i in order]
    shares = [times[i] / times[i].sum() for i in order]
    target = np.array([languages.index(names[i]) for i in order])
    return _fit(found, shares, target, languages, np.random.default_rng(seed))


def _fit(found: list, shares: list, target: np.ndarray, languages: list[str], random: np.random.Generator) -> LanguageModel:
    shuffled = random.permutation(len(found))
    calibrating, training = shuffled[: len(found) // 4], shuffled[len(found) // 4 :]
    weight = len(training) / len(languages) / np.maximum(1, np.bincount(target[training], minlength=len(languages)))
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = EPOCHS * -(-len(training) // BATCH), 0
    for _ in range(EPOCHS):
        training = random.permutation(training)
        for first in range(0, len(training), BATCH):
            rate, step = 1 - step / steps, step + 1
            chosen = training[first : first + BATCH]
            at = np.concatenate([found[i] for i in chosen])
            share = np.concatenate([shares[i] for i in chosen]).astype(np.float64)
            bounds = np.cumsum([0, *(len(found[i]) for i in chosen)])
            means = row_sums(embeddings[at] * share[:, None], bounds)
            error = _softmax(means @ layer + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error *= weight[target[chosen]][:, None] / len(chosen)
            back = error @ layer.T
            layer -= 5.0 * rate * (means.T @ error)
            bias -= 0.1 * rate * error.sum(axis=0)
            change = np.repeat(back, np.diff(bounds), axis=0) * share[:, None]
            np.subtract.at(embeddings, at, 50.0 * rate * change)
    table = embeddings @ layer
    logits = np.stack([(table[found[i]] * shares[i][:, None]).sum(axis=0) + bias for i in calibrating]) if len(calibrating) else np.zeros((0, len(languages)))
    # The temperature that makes the kept texts likeliest; then the score that all but a few of them reach.
    temperature, threshold = 1.0, 0.0
    if len(logits):
        true = (np.arange(len(logits)), target[calibrating])
        loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[true], 1e-12)).mean()
        temperature = float(min(np.geomspace(0.05, 10, 60), key=loss))
        threshold = min(CERTAIN, float(np.quantile(_softmax(logits / temperature).max(axis=1), REJECTED, method="lower")))
    return LanguageModel(languages, table.astype(np.float32), bias, temperature, threshold)


def language_of(text: Column, model: LanguageModel | None) -> Column:
    """A struct of ``lang``, ``score`` and ``accepted`` for each text."""
    if model is None:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    # BUCKETS x MOST_LANGUAGES floats at most.
    shared = SparkSession.active().sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])

    @F.arrow_udf("struct<lang:string,score:double,accepted:boolean>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        names = np.array(known.languages, object)
        for column in columns:
            parts = [pa.array([], kind)]
            for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
                texts = part.column("text")
                lettered = np.array([bool(t and _LETTER.search(t)) for t in texts.to_pylist()])
                chances = known.probabilities(texts)
                best = chances.argmax(axis=1)
                score = np.where(lettered, np.minimum(chances[np.arange(len(best)), best], 1.0), 0.0)
                lang = pa.array(np.where(lettered, names[best], "und"), pa.string())
                parts.append(pa.StructArray.from_arrays([lang, pa.array(score), pa.array(lettered & (score >= known.threshold))], fields=list(kind)))
            yield pa.concat_arrays(parts)

    return predict(text)


def identify_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_accepted`` (the score reaches the calibrated threshold)."""
    small_batches(docs.sparkSession)
    names = {"lang": "lang_pred", "score": "score", "accepted": "lang_accepted"}
    told = docs.select(F.struct(*docs.columns).alias("row"), language_of(F.col("text"), model).alias("told"))
    return told.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in names.values()], *[F.col("told")[k].alias(v) for k, v in names.items()])

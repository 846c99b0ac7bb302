"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of letters within a word and its bounds, over the whole text. A feature's value
is the logarithm of the ratio of its (smoothed) shares of toxic and other texts. Features of fewer than ``RARE`` texts are left
out, and those with a ratio of ``LEAST_RATIO`` or less, as otherwise many words of plain text would outweigh a toxic passage in a long one. Logistic regression on these values is fitted by stochastic gradient descent with adaptive steps on a sample of bounded
size, and part of the sample is kept to calibrate slope and intercept of the score, with the classes weighted
as in all labelled rows. Scoring needs one weight per bucket.

Defined results: an empty or null text has no feature and gets the score of the calibrated intercept; without labels of both classes every score is
the share of toxic labels (0 if there are none). A document labelled several times is toxic if any label says so. Rows pass one by one, so repeated rows,
null ids and extra columns stay as they are; a column of ``docs`` named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm.ngrams import hashed_ngrams, letters_only, row_sums
from docgraph.llm.text import slices, small_batches
from docgraph.llm.training import fold, sample_per_class
from docgraph.plans.scratch import write_table

# Bounds of the sample the classifier is fitted on.
TOXIC_TEXTS = 2000
OTHER_TEXTS = 4000
SIZES = (5, 7, 9, 11)
BUCKETS = 1 << 21
RARE = 3
LEAST_RATIO = 1.0
EPOCHS = 10
BATCH = 64
# Scores from here on count as toxic.
THRESHOLD = 0.3


@dataclass
class ToxicityModel:
    weights: np.ndarray  # one per bucket, ratio times coefficient
    slope: float
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        raw, offsets = letters_only(texts)
        keys = []
        for size in SIZES:
            found, bounds = hashed_ngrams(raw, offsets, size, BUCKETS)
            used = np.flatnonzero(self.weights[found])
            rows = np.searchsorted(bounds, used, side="right") - 1
            keys.append(rows * BUCKETS + found[used])
        keys = np.unique(np.concatenate(keys))
        bounds = np.searchsorted(keys, np.arange(len(offsets)) * BUCKETS)
        return _sigmoid(self.slope * row_sums(self.weights[keys & (BUCKETS - 1)], bounds) + self.intercept)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each whole text."""
    for part in slices(batches, "text"):
        raw, offsets = letters_only(part.column("text"))
        grams = [hashed_ngrams(raw, offsets, size, BUCKETS) for size in SIZES]
        for k in range(part.num_rows):
            found = np.unique(np.concatenate([g[b[k] : b[k + 1]] for g, b in grams])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("toxic").slice(k, 1), pa.array([found], pa.list_(pa.int32()))], ["toxic", "found"])


def train_toxicity_model(docs: DataFrame, labels: DataFrame, seed: int = 7) -> ToxicityModel:
    """Fit on labelled documents whose fold is not 2. ``labels``: ``doc_id``, ``toxic`` (0 or 1)."""
    small_batches(docs.sparkSession)
    known = labels.filter((fold(F.col("doc_id")) != 2) & F.col("toxic").isNotNull())
    known = write_table(known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "labels")
    total = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = sample_per_class(known.filter("toxic = 1"), "toxic", TOXIC_TEXTS)
    other = sample_per_class(known.filter("toxic = 0"), "toxic", OTHER_TEXTS)
    chosen = write_table(toxic.union(other), "sample")
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("toxic", "text")
    sample = texts.mapInArrow(_features, "toxic int, found array<int>").toArrow()
    y = sample.column("toxic").to_numpy()
    found = [np.asarray(x.values, np.int32) for x in sample.column("found")]
    share = total.get(1, 0) / max(1, sum(total.values()))
    if len(set(y.tolist())) < 2:
        return ToxicityModel(np.zeros(BUCKETS, np.float32), 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    # The order in which rows arrive depends on the cluster; a model must not.
    order = sorted(range(len(y)), key=lambda i: (y[i], found[i].tobytes()))
    return _fit([found[i] for i in order], y[order], share, np.random.default_rng(seed))


def _fit(found: list[np.ndarray], y: np.ndarray, share: float, random: np.random.Generator) -> ToxicityModel:
    shuffled = random.permutation(len(y))
    kept, training = shuffled[: len(y) // 5], shuffled[len(y) // 5 :]
    counts = np.zeros((2, BUCKETS))
    for i in training:
        counts[y[i], found[i]] += 1
    of = np.bincount(y[training], minlength=2)
    ratio = np.log((counts[1] + 1) / (of[1] + 2)) - np.log((counts[0] + 1) / (of[0] + 2))
    common = np.flatnonzero((counts.sum(axis=0) >= RARE) & (ratio > LEAST_RATIO))
    place = np.full(BUCKETS, -1, np.int32)
    place[common] = np.arange(len(common))
    value = ratio[common]
    columns = [c[c >= 0] for c in (place[f] for f in found)]
    # Each class weighs as much as it does among all labels.
    weight = np.where(y == 1, share * len(y) / max(1, of.sum()) / max(1, of[1]), (1 - share) * len(y) / max(1, of.sum()) / max(1, of[0])) * of.sum()
    w, seen, intercept = np.full(len(common), 0.02), np.full(len(common), 1e-8), -2.0
    for _ in range(EPOCHS):
        training = random.permutation(training)
        for first in range(0, len(training), BATCH):
            chosen = training[first : first + BATCH]
            at = np.concatenate([columns[i] for i in chosen])
            bounds = np.cumsum([0, *(len(columns[i]) for i in chosen)])
            error = (_sigmoid(row_sums(w[at] * value[at], bounds) + intercept) - y[chosen]) / len(chosen)
            touched, where = np.unique(at, return_inverse=True)
            change = np.bincount(where, weights=np.repeat(error, np.diff(bounds)), minlength=len(touched)) * value[touched] + 1e-4 * w[touched]
            seen[touched] += change * change
            w[touched] -= 0.05 * change / np.sqrt(seen[touched])
            intercept -= 0.1 * error.sum()
    weights = np.zeros(BUCKETS, np.float32)
    weights[common] = w * value
    raw = np.array([weights[found[i]].sum(dtype=np.float64) for i in kept]) + intercept
    slope, shift = _calibrate(raw, y[kept], weight[kept])
    return ToxicityModel(weights, slope, slope * intercept + shift)


def _calibrate(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the kept labels likeliest (Platt's targets), by Newton steps."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    toxic = int(y.sum())
    target = np.where(y == 1, (toxic + 1) / (toxic + 2), 1 / (len(y) - toxic + 2))
    at = np.array([1.0, 0.0])
    design = np.stack([raw, np.ones(len(raw))], axis=1)
    for _ in range(50):
        p = _sigmoid(design @ at)
        slope = design.T @ (weight * (p - target)) + 1e-3 * (at - [1.0, 0.0])
        curve = (design.T * (weight * p * (1 - p))) @ design + 1e-3 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return (float(at[0]), float(at[1])) if np.isfinite(at).all() and at[0] > 0 else (1.0, 0.0)


def toxicity_of(text: Column, model: ToxicityModel) -> Column:
    """The score of each text."""
    shared = SparkSession.active().sparkContext.broadcast(model)  # one float per bucket

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batches = slices([pa.RecordBatch.from_arrays([column], ["text"])], "text")
            yield pa.array(np.concatenate([np.zeros(0), *(shared.value.scores(part.column("text")) for part in batches)]))

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches the threshold)."""
    small_batches(docs.sparkSession)
    scored = docs.withColumn("score", toxicity_of(F.col("text"), model))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))

"""License scans: winnowed fingerprints pick candidates, banded alignment of words reports coverage and spans.

Texts are sequences of words (letters and digits, lower case). Of every ``WINNOW`` neighbouring shingles of ``SHINGLE`` words the one with the
smallest hash is a fingerprint, on both sides, so any run of ``SHINGLE + WINNOW - 1`` words that a document shares with a
template shares a fingerprint. Templates whose allowed gaps may leave shorter runs only are indexed without winnowing, by shingles of the longest run that
is left in any case (``run_left``). The templates' fingerprints are an inverted index (hash to template and position), shared with all tasks in
blocks of ``BLOCK_BYTES`` of text. Fingerprints of a document found in the index point to a template and a diagonal (position in the document minus
position in the template); neighbouring diagonals are one candidate region. There the template is aligned with the document inside the band
of diagonals, for the largest number of equal words. Coverage is their number by the words of the template or of the matched span, whichever is longer, so
inserted words cost as much as missing ones; a match of at least ``COVERAGE`` is reported, and of matches that overlap the one with the most equal words less
the others counts.

Defined results: without templates or documents nothing is found. Very long texts are treated whole. ``docs`` keep their columns but one named like the
result. Null and empty texts, and templates of fewer than ``SHINGLE`` words, match nothing. A document that holds a template several times has a
row for each. Repeated rows are reported each. Templates with the same id are reported under it; those without id are left out. Positions
are characters of the original text, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm.text import (
    U,
    character_numbers,
    column_bytes,
    normalise,
    run_hashes,
    slices,
    small_batches,
    span_hashes,
    text_blocks,
    word_spans,
)

SHINGLE = 3
WINNOW = 2
COVERAGE = 0.8
# Diagonals that a region may reach beyond its fingerprints, as a share of the template's words, and at least.
SLACK = 0.1
LEAST_SLACK = 3
BLOCK_BYTES = 8_000_000
_FLAG_BITS = 22

_NAMES = ["template_id", "coverage", "matched_words", "start", "end"]
MATCH = "struct<template_id:string,coverage:double,matched_words:int,start:int,end:int>"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first and last byte of each word in the column's bytes, offsets of the rows in the words, and the bytes."""
    raw, offsets = column_bytes(texts)
    text, at, bounds = normalise(raw, offsets)
    starts, ends, rows = word_spans(text, bounds)
    return span_hashes(text, starts, ends), at[starts], at[ends - 1], np.searchsorted(rows, np.arange(len(offsets))), raw


def run_left(length: int, coverage: float) -> int:
    """The longest run of equal words that a template of ``length`` words has in any case, if words are missing or replaced up to the coverage."""
    equal = next(k for k in range(length + 1) if k >= coverage * length or k == length)
    return -(-equal // (length - equal + 1))


def fingerprints(words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE, winnow: int = WINNOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place among all words, and row of the winnowed shingles."""
    hashes = run_hashes(words, size)
    row = np.searchsorted(bounds, np.arange(len(hashes)), side="right") - 1
    whole = np.arange(len(hashes)) + size <= bounds[row + 1]
    place, row, hashes = np.flatnonzero(whole), row[whole], hashes[whole]
    if not len(hashes):
        return hashes, place, row
    picked = np.zeros(len(hashes), bool)
    first = np.searchsorted(row, row)  # of each shingle's row
    last = np.searchsorted(row, row, side="right")
    # The window that starts at each shingle; a short row is one window.
    best = np.arange(len(hashes))
    for k in range(1, winnow):
        other = np.minimum(np.arange(len(hashes)) + k, last - 1)
        best = np.where(hashes[other] < hashes[best], other, best)
    starts_window = (np.arange(len(hashes)) + winnow <= last) | (np.arange(len(hashes)) == first)
    picked[best[starts_window]] = True
    return hashes[picked], place[picked], row[picked]


class Index:
    """The inverted index of the templates that have the same kind of fingerprints."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, members: list[int], size: int, winnow: int):
        self.size, self.winnow = size, winnow
        hashes, place, row = fingerprints(words, bounds, size, winnow)
        own = np.isin(row, members)
        hashes, place, row = hashes[own], place[own], row[own]
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.owners, self.places = row[order], (place - bounds[row])[order]
        self.flags = np.zeros(1 << _FLAG_BITS, bool)
        self.flags[(self.hashes >> U(64 - _FLAG_BITS)).astype(np.int64)] = True


class Templates:
    """The words and the inverted indexes of some templates."""

    def __init__(self, ids: list[str], texts: list[str], coverage: float = COVERAGE):
        words, _, _, bounds, _ = words_of(pa.array(texts, pa.string()))
        self.ids = ids
        self.words = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        kinds: dict[tuple[int, int], list[int]] = {}
        for k, own in enumerate(self.words):
            if len(own) >= SHINGLE:
                run = run_left(len(own), coverage)
                kind = (SHINGLE, WINNOW) if run >= SHINGLE + WINNOW - 1 else (max(1, min(run, SHINGLE)), 1)
                kinds.setdefault(kind, []).append(k)
        self.indexes = [Index(words, bounds, members, *kind) for kind, members in sorted(kinds.items())]

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Row, template, lowest and highest diagonal of the regions that share fingerprints."""
        for index in self.indexes:
            yield from self._candidates(index, words, bounds)

    def _candidates(self, index: Index, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        hashes, place, row = fingerprints(words, bounds, index.size, index.winnow)
        maybe = np.flatnonzero(index.flags[(hashes >> U(64 - _FLAG_BITS)).astype(np.int64)])
        if not len(maybe) or not len(index.hashes):
            return
        slot = np.minimum(np.searchsorted(index.hashes, hashes[maybe]), len(index.hashes) - 1)
        sure = index.hashes[slot] == hashes[maybe]
        maybe, slot = maybe[sure], slot[sure]
        if not len(maybe):
            return
        times = index.times[slot]
        posting = np.arange(times.sum()) + np.repeat(index.first[slot] - (np.cumsum(times) - times), times)
        template = index.owners[posting]
        row = np.repeat(row[maybe], times)
        diagonal = np.repeat(place[maybe], times) - bounds[row] - index.places[posting]
        order = np.lexsort((diagonal, template, row))
        row, template, diagonal = row[order], template[order], diagonal[order]
        start = 0
        for k in range(1, len(row) + 1):
            if k == len(row) or row[k] != row[start] or template[k] != template[start] or diagonal[k] - diagonal[k - 1] > slack(len(self.words[template[start]])):
                yield int(row[start]), int(template[start]), int(diagonal[start]), int(diagonal[k - 1])
                start = k


def slack(length: int) -> int:
    """Less than the template's length, so that a template and its repetition right behind it are two regions."""
    return min(max(LEAST_SLACK, int(SLACK * length)), max(length - 1, 0))


def best_apart(found: list[tuple]) -> list[tuple]:
    """Of matches (template id, coverage, matched words, start, end) that overlap, the one with the most equal words less the others; in the order of
    the text. Templates that match the same words as well as each other all stay."""
    value = lambda m: 2 * m[2] - round(m[2] / m[1])
    same = lambda m, n: m[3:] == n[3:] and value(m) == value(n)
    kept: list[tuple] = []
    for match in sorted(set(found), key=lambda m: (-value(m), -m[1], m[3], m[4], m[0])):
        if all(match[4] <= other[3] or other[4] <= match[3] or same(match, other) for other in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: (m[3], m[4], m[0]))


def tightened(words: np.ndarray, places: list[int]) -> list[int]:
    """Places of the same words with the same last one, each as late as possible."""
    places = list(places)
    for k in range(len(places) - 2, -1, -1):
        at = places[k + 1] - 1
        while words[at] != words[places[k]]:
            at -= 1
        places[k] = at
    return places


def align(template: np.ndarray, words: np.ndarray, low: int, high: int) -> list[int]:
    """Places in ``words`` of the longest common subsequence with the template inside a band of diagonals."""
    low, high = low - slack(len(template)), high + slack(len(template))
    width = high - low + 1
    best = np.zeros((len(template) + 1, width), np.int32)
    equal = np.zeros((len(template), width), bool)
    for i, word in enumerate(template):
        first, last = max(0, i + low), min(len(words), i + high + 1)
        if first < last:
            equal[i, first - i - low : last - i - low] = words[first:last] == word
        take = best[i] + equal[i]
        take[:-1] = np.maximum(take[:-1], best[i, 1:])
        best[i + 1] = np.maximum.accumulate(take)
    places, i, d = [], len(template), int(best[-1].argmax())
    while i and best[i, d]:
        if d and best[i, d] == best[i, d - 1]:
            d -= 1
        elif equal[i - 1, d] and best[i, d] == best[i - 1, d] + 1:
            places.append(i - 1 + d + low)
            i -= 1
        else:
            i, d = i - 1, d + (best[i - 1, d] < best[i, d])
    return places[::-1]


def matches(templates: Templates, texts: pa.Array, coverage: float) -> list[list[tuple]]:
    """For each text (template id, coverage, matched words, start, end) of all templates found, also where they overlap."""
    words, firsts, lasts, bounds, raw = words_of(texts)
    offsets = column_bytes(texts)[1]
    found: list[list[tuple]] = [[] for _ in range(len(texts))]
    for row, template, low, high in templates.candidates(words, bounds):
        own = words[bounds[row] : bounds[row + 1]]
        # No more words can be equal than occur near the region at all.
        size = len(templates.words[template])
        near = own[max(0, low - slack(size)) : max(0, high + slack(size) + size)]
        if np.isin(templates.words[template], near).sum() < coverage * size:
            continue
        places = tightened(own, align(templates.words[template], own, low, high))
        # Words that stand between matched ones cost as much as words that are missing.
        whole = max(size, places[-1] - places[0] + 1) if places else size
        if len(places) < coverage * whole:
            continue
        chars = character_numbers(raw[offsets[row] : offsets[row + 1]])
        start = int(chars[firsts[bounds[row] + places[0]] - offsets[row]])
        end = int(chars[lasts[bounds[row] + places[-1]] - offsets[row]]) + 1
        found[row].append((templates.ids[template], len(places) / whole, len(places), start, end))
    return [sorted(set(f), key=lambda m: (m[3], m[4], m[0], m[1])) for f in found]


def _scanner(shared, coverage: float):
    names = _NAMES
    kind = pa.list_(pa.struct(list(zip(names, [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]))))

    @F.arrow_udf(f"array<{MATCH}>")
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found: list = []
            for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
                found += [[dict(zip(names, m)) for m in best_apart(row)] for row in matches(shared.value, part.column("text"), coverage)]
            yield pa.array(found, kind)

    return scan


def _best(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Matches of several blocks of templates may overlap, too."""
    for column in columns:
        best = [best_apart([tuple(m.values()) for m in row or []]) for row in column.to_pylist()]
        yield pa.array([[dict(zip(_NAMES, m)) for m in row] for row in best], column.type)


def scan_licenses(docs: DataFrame, templates: DataFrame, coverage: float = COVERAGE, into: str = "licenses") -> DataFrame:
    """``docs`` with an array of the templates (``template_id``, ``text``) that each text holds."""
    spark = docs.sparkSession
    small_batches(spark)
    found = F.array().cast(f"array<{MATCH}>")
    templates = templates.select(F.col("template_id").cast("string").alias("template_id"), "text")
    blocks = 0
    for rows in text_blocks(templates, "template_id", BLOCK_BYTES):
        blocks += 1
        block = Templates([i for i, _ in rows], [t for _, t in rows], coverage)
        found = F.concat(found, _scanner(spark.sparkContext.broadcast(block), coverage)(F.col("text")))
    return docs.withColumn(into, F.arrow_udf(_best, f"array<{MATCH}>")(found) if blocks > 1 else found)

"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least ``max(LEAST_LENGTH, EXPONENT * q)``
that no neighbouring word extends keeping the period. Per slice of texts, all in numpy:

1. Words are numbered; the suffix array of all texts comes from prefix doubling, in which only suffixes that aren't told apart yet are sorted again.
   The first key holds the row, so no two suffixes of different texts share a prefix. The ranks of each round stay: two places have equal ranks in
   round k if the next 2^k words are equal, which gives longest common prefixes (and suffixes) exactly, by binary descent.
2. LCP intervals come from the nearest smaller values to both sides of each LCP value, by pointer jumping; the places that share them are the
   borders of the children. No tree is built.
3. For every interval of depth d and every suffix i of its children but the largest: if i + d lies in the interval (its place in the inverse suffix
   array does) but not in the child, the words at i and at i + d agree for exactly d words: a square of period d at i that can't be moved to the right, a
   branching tandem repeat. Likewise for i - d. As the largest child is left out, a suffix is tested once per halving: n log n tests in all.
4. The square is rotated to the left as long as it stays a square, at once by the longest common suffix; start and end are those of a run.
   Periods that are multiples of a smaller one give the same start and end, so runs are merged there and keep the smallest period.

Collapsing a text drops each word that a run contains after the run's first q words, and joins the others by one space.

Defined results: null, empty and blank texts have no words, no run, and collapse to ''. Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte. Every row
is treated for itself, so repeated rows and null ids are rows like any other. Texts of any length are treated whole, at about 4 bytes a word for each
doubling of the longest repeat. Other columns stay; the results replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm.text import column_bytes, slices, small_batches

LEAST_LENGTH = 6
EXPONENT = 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"
FOUND = f"struct<runs:array<{RUN}>,n_words:bigint,collapsed:string>"


class SuffixArray:
    """The sorted suffixes of many texts end to end; ``rows`` numbers the text of each word, ``words`` its value."""

    def __init__(self, words: np.ndarray, rows: np.ndarray):
        n = len(words)
        key = rows.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        self.order = np.argsort(key, kind="stable")
        rank, open_ = np.empty(n, np.int32), self._settle(key[self.order], np.arange(n), self.order)
        rank[self.order], unsettled = open_
        # levels[k][i] tells the next 2^k words at i; the entry behind the last word equals no other.
        self.levels = [np.append(rank, np.int32(-1))]
        width = 1
        while unsettled.any():
            slots = np.flatnonzero(unsettled)
            members = self.order[slots]
            rank = self.levels[-1]
            behind = rank[np.minimum(members + width, n)].astype(np.int64)
            key = rank[members].astype(np.int64) * (n + 1) + behind + 1
            by_key = np.argsort(key, kind="stable")
            members = members[by_key]
            self.order[slots] = members
            told, still = self._settle(key[by_key], slots, members)
            rank = rank.copy()
            rank[members] = told
            unsettled = np.zeros(n, bool)
            unsettled[slots] = still
            self.levels.append(rank)
            width *= 2
        self.place = self.levels[-1][:n]

    @staticmethod
    def _settle(key: np.ndarray, slots: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank (first slot of equal keys) of each sorted key, and whether others share it."""
        fresh = np.ones(len(key) + 1, bool)
        fresh[1:-1] = key[1:] != key[:-1]
        first = np.flatnonzero(fresh[:-1])
        return slots[first][np.cumsum(fresh[:-1]) - 1], ~(fresh[:-1] & fresh[1:])

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` share, for different places."""
        n, length = len(self.place), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank = self.levels[k]
            length += (rank[np.minimum(a + length, n)] == rank[np.minimum(b + length, n)]).astype(np.int64) << k
        return length

    def common_suffix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before ``a`` that equal those before ``b``, for a < b in the same row."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank, at = self.levels[k], a - length - (1 << k)
            inside = at >= 0
            equal = rank[np.where(inside, at, 0)] == rank[np.where(inside, b - length - (1 << k), -1)]
            length += (inside & equal).astype(np.int64) << k
        return length


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value; 0 for those with the least value, which the first one must have."""
    jump = np.maximum(np.arange(len(values)) - 1, 0)
    open_ = np.flatnonzero((values[jump] >= values) & (values > values[0]))
    while len(open_):
        # All between a place and its pointer is no smaller, so the pointer's own pointer may be taken.
        jump[open_] = jump[jump[open_]]
        open_ = open_[values[jump[open_]] >= values[open_]]
    return jump


def branching_tandems(words: np.ndarray, rows: np.ndarray, suffixes: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of the squares that can't be moved to the right, of those that may be the end of a run."""
    n, order, place = len(words), suffixes.order, suffixes.place
    lcp = np.full(n + 1, -1, np.int64)
    near = np.flatnonzero((rows[order[1:]] == rows[order[:-1]]) & (words[order[1:]] == words[order[:-1]])) + 1
    lcp[near] = suffixes.common_prefix(order[near - 1], order[near])
    low = smaller_before(lcp)
    high = n - smaller_before(lcp[::-1])[::-1]
    # A run of the period d ends with EXPONENT suffixes, d apart, that all lie in the interval of depth d.
    border = near[(high[near] - low[near] >= EXPONENT) & (high[near] - low[near] >= -(-LEAST_LENGTH // lcp[near]))]
    if not len(border):
        return border, border
    border = border[np.lexsort((border, high[border], low[border]))]
    low, high, depth = low[border], high[border], lcp[border]
    # Children: from the interval's start to its first border, between borders, and from the last border to the end.
    first = np.ones(len(border), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    last = np.append(first[1:], True)
    interval = np.cumsum(first) - 1
    child_low = np.concatenate([low[first], border])
    child_high = np.concatenate([border[first], np.where(last, high, np.append(border[1:], 0))])
    owner = np.concatenate([np.arange(first.sum()), interval])
    size = child_high - child_low
    by_size = np.lexsort((size, owner))
    largest = by_size[np.append(owner[by_size][1:] != owner[by_size][:-1], True)]
    small = np.ones(len(size), bool)
    small[largest] = False
    child_low, child_high, owner, size = child_low[small], child_high[small], owner[small], size[small]
    low, high, depth = low[first][owner], high[first][owner], depth[first][owner]

    child = np.repeat(np.arange(len(size)), size)
    suffix = order[np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + child_low[child]]
    starts, periods = [], []
    for sign in (1, -1):
        other = suffix + sign * depth[child]
        there = place[np.clip(other, 0, n - 1)]
        found = (other >= 0) & (other < n) & (there >= low[child]) & (there < high[child])
        found &= (there < child_low[child]) | (there >= child_high[child])
        starts.append(np.minimum(suffix, other)[found])
        periods.append(depth[child][found])
    return np.concatenate(starts), np.concatenate(periods)


def periodic_runs(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in texts end to end, in the order of start and period."""
    suffixes = SuffixArray(words, rows)
    at, period = branching_tandems(words, rows, suffixes)
    start, end = at - suffixes.common_suffix(at, at + period), at + 2 * period
    long = end - start >= np.maximum(LEAST_LENGTH, EXPONENT * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def found_in(texts: pa.Array) -> list[dict]:
    """Runs, number of words and collapsed text of each text."""
    raw, offsets = column_bytes(texts)
    raw = raw.tobytes()
    tokens = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for own in tokens for w in own), np.int64)
    sizes = np.array([len(own) for own in tokens], np.int64)
    bounds = np.append(0, np.cumsum(sizes))
    start, end, period = periodic_runs(flat, np.repeat(np.arange(len(tokens)), sizes))
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change[:-1]) > 0
    edges = np.searchsorted(start, bounds)
    out = []
    for row, own in enumerate(tokens):
        first, runs = int(bounds[row]), slice(edges[row], edges[row + 1])
        if edges[row] < edges[row + 1]:
            own = [w for w, gone in zip(own, dropped[first : first + len(own)].tolist()) if not gone]
        names = ("start", "length", "period")
        told = zip((start[runs] - first).tolist(), (end[runs] - start[runs]).tolist(), period[runs].tolist())
        out.append({"runs": [dict(zip(names, r)) for r in told], "n_words": int(sizes[row]), "collapsed": b" ".join(own).decode()})
    return out


def _find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = pa.struct([("runs", pa.list_(run)), ("n_words", pa.int64()), ("collapsed", pa.string())])
    for column in columns:
        parts = slices([pa.RecordBatch.from_arrays([column], ["text"])], "text")
        yield pa.array([found for part in parts for found in found_in(part.column("text"))], kind)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (``text``) with its ``runs`` (start, length, period, in words from 0), ``n_words`` and ``collapsed`` text."""
    small_batches(docs.sparkSession)
    found = docs.withColumn("_found", F.arrow_udf(_find, FOUND)(F.col("text")))
    return found.withColumns({name: F.col(f"_found.{name}") for name in ("runs", "n_words", "collapsed")}).drop("_found")

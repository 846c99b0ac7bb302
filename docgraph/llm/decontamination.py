"""Benchmark decontamination: passages of benchmark items inside documents, by q-gram lemma filtering and banded alignment.

Texts are compared as UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case and every run of other ASCII characters than letters
and digits as one space. The windows of an item are its runs of ``WINDOW`` bytes, one from every start (a shorter item is one window), so a verbatim passage of
``WINDOW`` bytes is a window wherever it stands in the item. A document holds a window if some region of it can be turned into the window by at
most ``ERRORS`` * length edits.

* Lemma: such a region shares at least length + 1 - Q * (edits + 1) q-grams with the window, and all of them lie on
  neighbouring diagonals (position in the document minus position in the item), as each edit moves the diagonal by one.
* So shared q-grams are counted in bands of diagonals. Bands overlap by the edit budget, so every region lies within one band. A
  band with fewer shared q-grams than the lemma asks for cannot hold a region and is dropped.
* In the bands left, the windows that still meet the bound are verified by an alignment restricted to the band, ``ALIGNED`` windows at once.

Neighbouring windows found are joined to one passage; its edits are the most of any of its windows, and as windows over its ends are held too if
the budget allows, it may reach some bytes over a verbatim fragment. Every document is scanned whole, in one pass without a shuffle; the q-grams of
the benchmark are shared with all tasks in blocks of ``BLOCK_BYTES`` of text, and a larger benchmark takes one pass per block.

Defined results: items of fewer than ``SHORTEST`` bytes after normalisation are found where they stand verbatim and whole, from word to word; those of fewer
than ``LEAST_WORDS`` words (or ``Q`` bytes) prove nothing and are never found. Without items or documents nothing is found. Null and
empty texts hold nothing. Very long texts are treated whole. ``docs`` keep their columns but one named like the result. Repeated rows of documents are reported each; items that share their ``item_id`` are reported under it;
items without id are left out. Positions are characters of the original text, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm.text import U, character_numbers, column_bytes, mix, normalise, slices, small_batches, text_blocks

WINDOW = 80
STRIDE = 1
ERRORS = 0.08
Q = 10
SHORTEST = 40
LEAST_WORDS = 4
BAND = 8
ALIGNED = 2048
BLOCK_BYTES = 4_000_000

_FLAG_BITS = 23

PASSAGE = "struct<item_id:bigint,item_start:int,item_end:int,doc_start:int,doc_end:int,edits:int>"


def qgram_hashes(text: np.ndarray) -> np.ndarray:
    n = len(text) - Q + 1
    if n <= 0:
        return np.zeros(0, U)
    # Runs of 2, 4 and 8 bytes, then the last two.
    two = (text[:-1].astype(U) << U(8)) | text[1:]
    four = (two[:-2] << U(16)) | two[2:]
    eight = (four[:-4] << U(32)) | four[4:]
    return mix(eight[:n] + two[8 : 8 + n] * U(0x9E3779B97F4A7C15))


def windows_of(length: int) -> list[tuple[int, int]]:
    """Start and length of the windows of an item."""
    if length <= WINDOW:
        return [(0, length)]
    starts = list(range(0, length - WINDOW, STRIDE))
    return [(s, WINDOW) for s in [*starts, length - WINDOW]]


def budget(length: int) -> int:
    return int(ERRORS * length) if length >= SHORTEST else 0


def least_shared(length: int) -> int:
    return length + 1 - Q * (budget(length) + 1)


class Block:
    """The q-grams of some items: a flag table for a first look, sorted hashes, and where each stands."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw, offsets = column_bytes(pa.array(texts, pa.string()))
        text, at, bounds = normalise(raw, offsets)
        self.ids, self.items, self.starts = [], [], []
        hashes, owners, places = [], [], []
        for k, item in enumerate(ids):
            own = text[bounds[k] : bounds[k + 1]]
            own = own[:-1] if len(own) and own[-1] == 32 else own
            if len(own) < Q or len(own) < SHORTEST and (own == 32).sum() + 1 < LEAST_WORDS:
                continue
            found = qgram_hashes(own)
            hashes.append(found)
            owners.append(np.full(len(found), len(self.ids), np.int64))
            places.append(np.arange(len(found)))
            self.ids.append(item)
            self.items.append(own)
            chars = character_numbers(raw[offsets[k] : offsets[k + 1]])
            self.starts.append(chars[at[bounds[k] : bounds[k] + len(own)] - offsets[k]])
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.places = np.concatenate(places)[order] if places else np.zeros(0, np.int64)
        self.flags = np.zeros(1 << _FLAG_BITS, bool)
        self.flags[(self.hashes >> U(64 - _FLAG_BITS)).astype(np.int64)] = True
        self.least = np.array([min(least_shared(n) for _, n in windows_of(len(item))) for item in self.items], np.int64)

    def candidates(self, text: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, np.ndarray]]:
        """(row, item, first diagonal of the band, sorted shared places in the item) of the bands that meet the bound."""
        hashes = qgram_hashes(text)
        maybe = np.flatnonzero(self.flags[(hashes >> U(64 - _FLAG_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.hashes):
            return []
        slot = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        sure = self.hashes[slot] == hashes[maybe]
        maybe, slot = maybe[sure], slot[sure]
        rows = np.searchsorted(bounds, maybe, side="right") - 1
        inside = maybe + Q <= bounds[rows + 1]
        maybe, slot, rows = maybe[inside], slot[inside], rows[inside]
        # One entry per place in an item that holds the q-gram.
        times = self.times[slot]
        posting = np.arange(times.sum()) + np.repeat(self.first[slot] - (np.cumsum(times) - times), times)
        item, place = self.owners[posting], self.places[posting]
        row, spot = np.repeat(rows, times), np.repeat(maybe, times)
        if not len(item):
            return []
        # Diagonals counted from 0; a band starts every BAND diagonals and reaches over the budget into the next one.
        reach = budget(WINDOW)
        diagonal = spot - bounds[row] - place + (1 << 20)
        band = diagonal // BAND
        again = diagonal % BAND < reach
        row, item, place = (np.concatenate([x, x[again]]) for x in (row, item, place))
        band = np.concatenate([band, band[again] - 1])
        order = np.lexsort((place, band, item, row))
        row, item, band, place = row[order], item[order], band[order], place[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        # The lemma speaks of places in the item, so several diagonals with the same place count once.
        once = new.copy()
        once[1:] |= place[1:] != place[:-1]
        row, item, band, place, new = row[once], item[once], band[once], place[once], new[once]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(row)))
        enough = np.flatnonzero(count >= self.least[item[first]])
        return [
            (int(row[first[k]]), int(item[first[k]]), int(band[first[k]]) * BAND - (1 << 20), place[first[k] : first[k] + count[k]])
            for k in enough
        ]


def align(window: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits (if at most ``most``) between the window and a region of the text that starts on a diagonal from ``low`` to ``high``.

    Returns edits, start and end of the region. Diagonal d at row i means position i + d of the text.
    """
    found, edits, first, last = align_all(window[:, None], text, np.zeros(1, np.int64), np.array([len(text)]), np.array([low]), high - low + 1, most)
    return (int(edits[0]), int(first[0]), int(last[0])) if len(found) else None


def align_all(
    windows: np.ndarray, text: np.ndarray, begins: np.ndarray, lengths: np.ndarray, lows: np.ndarray, width: int, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``align`` for each column of ``windows`` with a text of its own, ``lengths`` bytes of ``text`` from ``begins``, on ``width`` diagonals from ``lows``.

    Returns the columns found, their edits, and starts and ends of their regions.
    """
    size = len(windows)
    lows = lows - most
    width += 2 * most
    # A cost and where its region starts are one number; of equal costs the shorter region counts.
    unit = width
    far = (size + 1) * unit
    at = lows + np.arange(size + width)[:, None]
    beyond = np.concatenate([(at < 0) | (at > lengths), (at[-1:] + 1 < 0) | (at[-1:] + 1 > lengths)])
    real = (at >= 0) & (at < lengths)
    around = np.where(real, text[np.where(real, begins + at, 0)] if len(text) else 0, -1).astype(np.int16)
    steps = (np.arange(width, dtype=np.int32) * unit)[:, None]
    cost = np.where(beyond[:width], far, np.arange(width, dtype=np.int32)[::-1, None]).astype(np.int32)
    left = np.arange(len(lows))
    for i in range(size):
        best = cost + (around[i : i + width] != windows[i]) * np.int32(unit)
        np.minimum(best[:-1], cost[1:] + unit, out=best[:-1])
        np.copyto(best, far, where=beyond[i + 1 : i + 1 + width])
        # Extra characters of the text: from the left, one edit a step.
        best -= steps
        cost = np.minimum.accumulate(best, axis=0)
        cost += steps
        if i % 8 == 7:
            keep = cost.min(axis=0) < (most + 1) * unit
            if 4 * keep.sum() < 3 * len(keep):
                left, windows, around, beyond, cost = left[keep], windows[:, keep], around[:, keep], beyond[:, keep], cost[:, keep]
            if not len(left):
                break
    edits = cost // unit
    end = edits.argmin(axis=0) if len(left) else np.zeros(0, np.int64)
    here = np.arange(len(left))
    good = np.flatnonzero(edits[end, here] <= most)
    end, left = end[good], left[good]
    first = lows[left] + unit - 1 - cost[end, good] % unit
    return left, edits[end, good], first, lows[left] + end + size


def held_windows(block: Block, text: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """Row, item, start and end in the item, start and end in the text, and edits of the windows that the texts hold."""
    waiting: dict[int, list[tuple]] = {}
    for row, item, low, places in block.candidates(text, bounds):
        length = min(WINDOW, len(block.items[item]))
        starts = np.array([s for s, _ in windows_of(len(block.items[item]))])
        shared = np.searchsorted(places, starts + length - Q, side="right") - np.searchsorted(places, starts)
        starts = starts[shared >= least_shared(length)]
        # A long item may have more windows than are aligned at once.
        for k in range(0, len(starts), ALIGNED):
            some = waiting.setdefault(length, [])
            some.append((row, item, low, starts[k : k + ALIGNED]))
            if sum(len(w[3]) for w in some) >= ALIGNED:
                yield from _verified(block, text, bounds, length, waiting.pop(length))
    for length, some in waiting.items():
        yield from _verified(block, text, bounds, length, some)


def _verified(block: Block, text: np.ndarray, bounds: np.ndarray, length: int, some: list[tuple]) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    counts = [len(starts) for *_, starts in some]
    rows, items, lows = (np.repeat([w[k] for w in some], counts) for k in range(3))
    starts = np.concatenate([w[3] for w in some])
    windows = np.concatenate([block.items[item][starts + np.arange(length)[:, None]] for _, item, _, starts in some], axis=1)
    begins = bounds[rows]
    found, edits, first, last = align_all(
        windows, text, begins, bounds[rows + 1] - begins, lows + starts, BAND + budget(WINDOW), budget(length)
    )
    if length < SHORTEST:
        # A short item counts as whole words only.
        padded = np.append(text, np.uint8(32))
        row = rows[found]
        free = ((first == 0) | (padded[bounds[row] + first - 1] == 32)) & ((bounds[row] + last == bounds[row + 1]) | (padded[bounds[row] + last] == 32))
        found, edits, first, last = found[free], edits[free], first[free], last[free]
    start = starts[found]
    yield from zip(*(x.tolist() for x in (rows[found], items[found], start, start + length, first, last, edits)))


def passages(block: Block, texts: pa.Array) -> list[list[tuple]]:
    """For each text the passages (item id, item start and end, text start and end, edits) it shares with items."""
    raw, offsets = column_bytes(texts)
    text, at, bounds = normalise(raw, offsets)
    found: dict[tuple[int, int], set] = {}
    for row, item, start, end, first, last, edits in held_windows(block, text, bounds):
        found.setdefault((row, item), set()).add((first, last, start, end, edits))
    results: list[list[tuple]] = [[] for _ in range(len(texts))]
    for (row, item), hits in sorted(found.items()):
        # Windows that meet in the text are one passage.
        merged: list[list[int]] = []
        for first, last, start, end, edits in sorted(hits):
            if merged and first <= merged[-1][1]:
                merged[-1] = [merged[-1][0], max(last, merged[-1][1]), min(start, merged[-1][2]), max(end, merged[-1][3]), max(edits, merged[-1][4])]
            else:
                merged.append([first, last, start, end, edits])
        chars = character_numbers(raw[offsets[row] : offsets[row + 1]])
        places = at[bounds[row] : bounds[row + 1]] - offsets[row]
        spots = block.starts[item]
        for first, last, start, end, edits in merged:
            doc = (int(chars[places[first]]), int(chars[places[last - 1]]) + 1)
            results[row].append((block.ids[item], int(spots[start]), int(spots[end - 1]) + 1, *doc, edits))
    return results


def _finder(shared) -> callable:
    @F.arrow_udf(f"array<{PASSAGE}>")
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ["item_id", "item_start", "item_end", "doc_start", "doc_end", "edits"]
        kind = pa.list_(pa.struct([(n, pa.int64() if n == "item_id" else pa.int32()) for n in names]))
        for column in columns:
            found: list = []
            for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
                found += [[dict(zip(names, p)) for p in row] for row in passages(shared.value, part.column("text"))]
            yield pa.array(found, kind)

    return find


def passages_of(text: Column, benchmark: DataFrame) -> Column:
    """An array of the passages that each text shares with ``benchmark`` (``item_id``, ``text``)."""
    found = F.array().cast(f"array<{PASSAGE}>")
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    for items in text_blocks(benchmark, "item_id", BLOCK_BYTES):
        block = Block([i for i, _ in items], [t for _, t in items])
        found = F.concat(found, _finder(benchmark.sparkSession.sparkContext.broadcast(block))(text))
    return found


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, into: str = "passages") -> DataFrame:
    """``docs`` with the column ``into``, an array of the passages each text shares with ``benchmark``."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, passages_of(F.col("text"), benchmark))

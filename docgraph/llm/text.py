"""Numpy helpers that work on many texts at once: word hashes, shingle sets, UTF-8 bytes of a column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table

U = np.uint64

# Rows that Spark hands to Python at once, and bytes of text that numpy treats at once; temporary arrays take
# about 50 times the bytes of the second.
ROWS_PER_BATCH = 1000
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def small_batches(spark: SparkSession) -> None:
    """Keep the batches that go to Python small, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(_BASE))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, end to end, and the n + 1 offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    values = column.buffers()[2]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut where the texts of a part would exceed ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = column_bytes(batch.column(column))[1][1:]
        first = 0
        while first < batch.num_rows:
            limit = (ends[first - 1] if first else 0) + most
            last = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, U)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; no word reaches over the end of its row."""
    n = len(raw)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    row_start = np.zeros(n + 1, bool)
    row_start[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (row_start | ~before))
    ends = np.flatnonzero(before & (row_start | ~inside))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    n = len(raw)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE_VALUES[raw] * _powers(_BASE, n), out=sums[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` consecutive words (``len(words) - size + 1`` of them)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = words[:n].copy()
    for k in range(1, size):
        out = mix(out + U(_BASE)) + words[k : k + n]
    return mix(out ^ U(size))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` lower-cased words.

    A text with fewer words has its whole word sequence as the only shingle; one without words, or null, has none.
    """
    raw, offsets = column_bytes(texts)
    raw = lower_ascii(raw)
    starts, ends, rows = word_spans(raw, offsets)
    words = span_hashes(raw, starts, ends)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    runs = run_hashes(words, size)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        count = last - first
        if count >= size:
            sets.append(np.unique(runs[first : last - size + 1]))
        else:
            sets.append(run_hashes(words[first:last], count) if count else np.zeros(0, U))
    return sets


# Bytes that stay in normalised texts: letters and digits, and all of longer characters.
_KEPT = np.zeros(256, bool)
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def normalise(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters and digits of the rows, any run of other ASCII characters as one space.

    Returns the bytes, the positions in ``raw`` they come from, and the offsets of the rows in them.
    """
    kept = _KEPT[raw]
    first = np.zeros(len(raw), bool)
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True
    before = np.ones(len(raw), bool)
    before[1:] = kept[:-1]
    at = np.flatnonzero(kept | (before & ~first))  # a row does not start with a space
    lower = ((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5
    # Capitals of U+00C0 to U+00DE, two bytes of which the first is C3.
    lower[1:] |= ((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)).astype(np.uint8) << 5
    return np.where(kept[at], raw[at] | lower[at], np.uint8(32)), at, np.searchsorted(at, offsets)


def character_numbers(raw: np.ndarray) -> np.ndarray:
    """For each byte of a UTF-8 text the number of the character it belongs to."""
    return np.cumsum((raw & 0xC0) != 0x80) - 1


def text_blocks(rows: DataFrame, key: str, most: int) -> Iterator[list[tuple]]:
    """All (``key``, text) pairs on the driver, in sorted blocks of about ``most`` bytes of text, one block at a time."""
    rows = write_table(rows.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, "text"), "reference")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // most)
    for k in range(count):
        block = rows.filter(F.pmod(F.xxhash64(key, "text"), F.lit(count)) == k)
        yield sorted(map(tuple, block.collect()))

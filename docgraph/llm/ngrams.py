"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docgraph.llm.text import U

# ASCII letters stay, other ASCII characters part words, bytes of longer characters stay.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def letters_only(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes of the texts with a space for anything but letters, a space around each text, and their offsets."""
    parts = [f" {t or ''} ".lower().encode().translate(_LETTERS) for t in texts.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def hashed_ngrams(raw: np.ndarray, offsets: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``size`` bytes that lie within a word and its two bounds, and the offsets of the rows in them.

    Texts end with a space, so an n-gram that reaches into the next text has a space inside and is left out. ``buckets`` is a power of two.
    """
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = raw == 32
    inside = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(space, out=inside[1:])
    whole = np.flatnonzero((inside[size - 1 : len(raw)] - inside[1 : n + 1]) == 0) if size > 2 else np.flatnonzero(~(space[:n] & space[1:]))
    value = np.zeros(len(whole), U)
    for k in range(size):
        value = value * U(0x100000001B3) + raw[whole + k]
    value = (value ^ (value >> U(29))) * U(0xBF58476D1CE4E5B9 ^ (size << 1))
    return (value >> U(64 - (buckets.bit_length() - 1))).astype(np.int64), np.searchsorted(whole, offsets)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (first axis) between consecutive bounds; an empty stretch sums to 0."""
    sums = np.zeros((len(bounds) - 1, *values.shape[1:]))
    full = np.flatnonzero(bounds[:-1] < bounds[1:])
    if len(full):
        sums[full] = np.add.reduceat(values, bounds[full], axis=0, dtype=np.float64)
    return sums

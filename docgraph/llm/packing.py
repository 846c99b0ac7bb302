"""Packing of whole documents into windows of a fixed number of tokens by Karmarkar-Karp multiway differencing.

Each task packs the documents of its partition in groups of about ``GROUP_WINDOWS`` windows, as it meets them; nothing is moved
between tasks, so no source or document size can overload one. In a group:

1. A document longer than a window gives full windows; what remains is shorter than one.
2. A few remainders are set aside, a 64th of the tokens; the others are divided among the windows of the group. Each remainder starts as a
   partition of its own (one filled window, the others empty). The two partial partitions with the largest spread are merged, the fullest window of one
   with the emptiest of the other, until one partition is left, with near-equal windows.
3. If a window exceeds the capacity, the division is repeated with one window more.
4. The differenced windows stay as they are, with whole documents. If documents may be cut, the small gaps that are left are closed with pieces of those
   set aside, and of the emptiest windows where the number had to rise. What is left over, less than a window, goes to the next group of the task. Only
   the last rest of a task is short; it is cut into sequences whose lengths are powers of two, which need no padding.

Token ids come from the tokenizer named by a path that all executors can read; every document ends with ``end_id``.

Defined results: a null or empty text is the document of the single id ``end_id``. Every row is a document of its own, whether or not its
``doc_id`` repeats or is null. An empty table gives no piece. Sequence ids are unique, not consecutive.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docgraph.llm.text import slices, small_batches
from docgraph.llm.tokens import encoder_for, ranked_merges

WINDOW = 4096
# Windows packed together; a task holds their ids in memory (1 MB).
GROUP_WINDOWS = 64
# One token in so many is set aside to close gaps: about the spread of the differenced windows, so that their number seldom has to rise.
ROOM = 64

Piece = tuple[int, int, int]  # number of the document, first token, number of tokens

_RESULT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def difference_partition(sizes: list[int], count: int) -> list[list[int]]:
    """The indexes of ``sizes`` in ``count`` lists with near-equal sums, by multiway differencing."""
    if count == 1 or not sizes:
        return [list(range(len(sizes))), *([] for _ in range(count - 1))]
    heap: list = []
    for k, size in enumerate(sizes):
        sums = np.zeros(count, np.int64)
        sums[0] = size
        heap.append((-size, k, sums, [k, *[None] * (count - 1)]))
    heapq.heapify(heap)
    for turn in range(len(sizes), 2 * len(sizes) - 1):
        _, _, sums, held = heapq.heappop(heap)
        _, _, others, other_held = heapq.heappop(heap)
        # Sums are in descending order: the largest of one meets the smallest of the other.
        sums = sums + others[::-1]
        order = np.argsort(-sums, kind="stable")
        joined = [a if b is None else b if a is None else (a, b) for a, b in zip(held, reversed(other_held))]
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), turn, sums, [joined[i] for i in order.tolist()]))
    return [_leaves(tree) for tree in heap[0][3]]


def _leaves(tree) -> list[int]:
    found, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        elif node is not None:
            found.append(node)
    return sorted(found)


def _cut(pieces: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces up to ``tokens`` tokens, and the rest."""
    head: list[Piece] = []
    for k, (doc, start, length) in enumerate(pieces):
        if length >= tokens:
            head += [(doc, start, tokens)] * (tokens > 0)
            return head, [(doc, start + tokens, length - tokens)] * (length > tokens) + pieces[k + 1 :]
        head.append((doc, start, length))
        tokens -= length
    return head, []


def _tokens(pieces: list[Piece]) -> int:
    return sum(length for _, _, length in pieces)


def full_windows(size: int, doc: int, capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """The windows that a document fills alone, and the piece that remains."""
    rest = size % capacity
    return [[(doc, start, capacity)] for start in range(0, size - rest, capacity)], [(doc, size - rest, rest)] * (rest > 0)


def divide(pieces: list[Piece], count: int, capacity: int) -> list[list[Piece]]:
    """The pieces, none cut, in ``count`` near-equal windows, or as many more as the capacity asks for."""
    while True:
        parts = [[pieces[k] for k in part] for part in difference_partition([p[2] for p in pieces], count)]
        if max(_tokens(part) for part in parts) <= capacity:
            return parts
        count += 1


def pack_group(pieces: list[Piece], spare: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """As many full windows as the tokens give, and the rest, shorter than a window.

    ``pieces`` and ``spare`` are shorter than a window; ``spare`` was cut before, so gaps are closed with it first.
    """
    count = (_tokens(pieces) + _tokens(spare)) // capacity
    if not count:
        return [], spare + pieces
    # The large ones first, so that few documents are cut; then the smallest that is enough.
    above = _tokens(pieces) - count * (capacity - capacity // ROOM)
    whole = []
    for piece in sorted(pieces, key=lambda p: -p[2]):
        if piece[2] <= above:
            spare = spare + [piece]
            above -= piece[2]
        else:
            whole.append(piece)
    if above > 0:
        # All that is left is larger than that; the last is the smallest.
        spare = spare + [whole.pop()]
    parts = sorted(divide(whole, count, capacity), key=_tokens, reverse=True)
    for part in parts[count:]:
        spare = spare + part
    windows = []
    for part in parts[:count]:
        more, spare = _cut(spare, capacity - _tokens(part))
        windows.append(part + more)
    return windows, spare


def _short(rest: list[Piece]) -> list[list[Piece]]:
    """The last tokens in windows of powers of two."""
    windows, size = [], _tokens(rest)
    while size:
        part = 1 << (size.bit_length() - 1)
        head, rest = _cut(rest, part)
        windows.append(head)
        size -= part
    return windows


def pack(sizes: list[int], capacity: int = WINDOW, cut: bool = True) -> list[list[Piece]]:
    """Windows of at most ``capacity`` tokens that hold every token of the documents once.

    A document longer than the capacity is cut in any case; others only if ``cut``.
    """
    windows, rest = [], []
    for doc, size in enumerate(sizes):
        full, remaining = full_windows(size, doc, capacity)
        windows += full
        rest += remaining
    if cut:
        more, left = pack_group(rest, [], capacity)
        return windows + more + _short(left)
    return windows + [part for part in divide(rest, max(1, -(-_tokens(rest) // capacity)), capacity) if part]


def _pack_partition(path: str, ranks: dict[bytes, int] | None, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, ranks)
        sequence = TaskContext.get().partitionId() << 33
        # The documents that are held, by number; their pieces; the windows they fill alone; and the rest of the group before.
        docs: dict[int, tuple[int | None, np.ndarray]] = {}
        pieces: list[Piece] = []
        windows: list[list[Piece]] = []
        spare: list[Piece] = []
        held = number = 0

        def rows_of(packed: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for window_pieces in packed:
                offset = 0
                for doc, start, length in window_pieces:
                    name, ids = docs[doc]
                    rows.append((name, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), sequence, offset))
                    offset += length
                sequence += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names)

        for part in slices(batches, "text"):
            found, offsets = encoder.encode(part.column("text"))
            for k, doc in enumerate(part.column("doc_id").cast(pa.int64()).to_pylist()):
                ids = np.append(found[offsets[k] : offsets[k + 1]], np.uint32(end_id)).astype("<u4")
                docs[number] = doc, ids
                full, rest = full_windows(len(ids), number, window)
                windows += full
                pieces += rest
                held += len(ids)
                number += 1
                if held >= GROUP_WINDOWS * window:
                    more, spare = pack_group(pieces, spare, window)
                    yield rows_of(windows + more)
                    docs = {piece[0]: docs[piece[0]] for piece in spare}
                    pieces, windows, held = [], [], _tokens(spare)
        more, spare = pack_group(pieces, spare, window)
        if windows or more or spare:
            yield rows_of(windows + more + _short(spare))

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents (``doc_id``, ``text``): ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``."""
    small_batches(docs.sparkSession)
    ranks = ranked_merges(tokenizer_path)
    return docs.select("doc_id", "text").mapInArrow(_pack_partition(tokenizer_path, ranks, end_id, window), _RESULT)

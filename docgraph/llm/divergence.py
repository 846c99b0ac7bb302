"""Source divergence audit: how far the word use of each source is from other sources, and from its whole language.

1. Counting. A term is a run of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased. A task packs the terms of some MB of text by
   length: up to 8 bytes are one uint64 (big-endian, so numbers sort like the bytes), up to 16 are two, longer ones go into buckets of equal padded
   width, sorted as bytes. Short terms are radix-sorted, 16 bits a pass, after the group (language and source), and their runs are counted: occurrences,
   and documents, as the sort is stable and documents stand in their order. Spark adds up the counts of the tasks.
2. Shares. A language keeps the terms of at least ``least_docs`` of its documents, V of them. A group (and a language) gives a kept term that it
   holds ``count`` times the share p = 1 + floor(1e9 * (count + 2) / (N + 2 * V)), N being the sum of its counts. All arithmetic is in whole numbers; the
   quotient is divided out three decimal digits at a time, so it is exact for N + 2 * V below 9e15.
3. Divergence of two shares: floor((p - q)^2 / (p + q)). Terms of a group above the language's share are ranked by it (part ``term``).
   Sources of a language are compared over all kept terms (part ``pair``): terms are dealt into blocks of about ``BLOCK_TERMS`` and sources into
   tiles of ``TILE``, a task holds the shares of two tiles over a block as dense arrays, and the sums of the blocks are added up. So no row is made
   per term and pair of sources, and no task holds more than two tiles and a block.

Defined results: null ``text``, ``lang`` and ``source`` count as ''. Every row is a document, also repeated ones. A group without terms has shares like
any other (from a count of 0); the only group of a language has no pair; a language without kept terms has value 0 in all pairs and no
term. Ties in a ranking go to the smaller item in UTF-8 order. Very long texts are one unit of work, at about 60 times their bytes for a moment; a very
long term is one entry of its bucket. Without rows there is no result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.llm.text import U, column_bytes, lower_ascii, slices, small_batches
from docgraph.plans.scratch import write_table

LEAST_DOCS = 10
TOP = 10
# Bytes of text that are counted at once, kept terms of a block, sources of a tile.
SLICE_BYTES = 4 << 20
BLOCK_TERMS = 2048
TILE = 256

_COUNTS = "lang string, source string, term string, times bigint, docs bigint"

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every term in the texts' bytes; no term reaches over the end of its row."""
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _LETTERS[raw]
    row_edge = np.zeros(n + 1, bool)
    row_edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (row_edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (row_edge | ~inside[1:]))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def packed(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most ``8 * words`` bytes as big-endian uint64 words, the first bytes in the first word; zeros fill up."""
    padded = np.concatenate([raw, np.zeros(8 * words, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = []
    for k in range(words):
        word = np.ascontiguousarray(windows[starts + 8 * k]).view(">u8").ravel().astype(U)
        unused = np.clip(8 * (k + 1) - lengths, 0, 8).astype(U) * U(8)
        # A shift by 64 is undefined, so it is made in two steps.
        half = unused >> U(1)
        out.append(word >> half >> (unused - half) << half << (unused - half))
    return out


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys``, the least significant first, in passes of 16 bits; digits that are equal in all rows cost no pass."""
    order = np.arange(len(keys[0]))
    for key in keys:
        for shift in range(0, 8 * key.dtype.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(changes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First entry, entries and distinct documents of each run; ``changes`` tells where a sorted entry differs from the one before."""
    first = np.flatnonzero(changes)
    fresh = changes.copy()
    fresh[1:] |= docs[1:] != docs[:-1]
    return first, np.diff(np.append(first, len(changes))), np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first


def count_terms(texts: pa.Array, groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents of the terms of each group of texts, one bucket of lengths at a time."""
    raw, offsets = column_bytes(texts)
    raw = lower_ascii(raw)
    starts, ends, rows = term_spans(raw, offsets)
    lengths = ends - starts
    for words in (1, 2):
        own = np.flatnonzero((lengths > 8 * (words - 1)) & (lengths <= 8 * words))
        if len(own):
            keys, group = packed(raw, starts[own], lengths[own], words), groups[rows[own]]
            order = radix_order([*keys[::-1], group])
            keys, group = [key[order] for key in keys], group[order]
            changes = np.ones(len(own), bool)
            changes[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in [*keys, group]])
            first, times, docs = run_counts(changes, rows[own][order])
            joined = np.stack([key[first] for key in keys], axis=1).astype(">u8").view(f"S{8 * words}").ravel()
            yield group[first], joined.tolist(), times, docs
    long = np.flatnonzero(lengths > 16)
    widths = -(-lengths[long] // 8) * 8
    for width in np.unique(widths).tolist():
        own = long[widths == width]
        cells = raw[np.minimum(starts[own, None] + np.arange(width), len(raw) - 1)]
        cells[np.arange(width) >= lengths[own, None]] = 0
        terms, group = np.ascontiguousarray(cells).view(f"S{width}").ravel(), groups[rows[own]]
        order = np.argsort(terms, kind="stable")
        order = order[radix_order([group[order]])]
        terms, group = terms[order], group[order]
        changes = np.ones(len(own), bool)
        changes[1:] = (terms[1:] != terms[:-1]) | (group[1:] != group[:-1])
        first, times, docs = run_counts(changes, rows[own][order])
        yield group[first], terms[first].tolist(), times, docs


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per group and term, and for each group a row without a term."""
    names = ["lang", "source", "term", "times", "docs"]
    for part in slices(batches, "text", SLICE_BYTES):
        pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
        known = {pair: k for k, pair in enumerate(dict.fromkeys(pairs))}
        lang, source = (pa.array([pair[k] for pair in known], pa.string()) for k in (0, 1))
        zeros = pa.array(np.zeros(len(known), np.int64))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(known), pa.string()), zeros, zeros], names)
        for group, terms, times, docs in count_terms(part.column("text"), np.array([known[pair] for pair in pairs], np.uint32)):
            at = pa.array(group)
            yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times), pa.array(docs)], names)


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(1e9 * (count + 2) / (total + 2 * kept)) of SQL expressions, by long division; without kept terms there is no share to tell."""
    divisor = f"greatest({total} + 2 * {kept}, 1)"
    left, quotient = f"({count} + 2)", "0L"
    for _ in range(3):
        left = f"({left} * 1000)"
        quotient, left = f"({quotient} * 1000 + {left} div {divisor})", f"({left} % {divisor})"
    return F.expr(f"{quotient} + 1")


def _compare_tiles(table: pa.Table) -> pa.Table:
    """Divergence over one block of terms of all pairs of sources of two tiles (each pair once); shares of terms that a source
    doesn't hold are the source's ``least``."""
    marks = table.filter(pc.is_null(table.column("term")))
    held = table.filter(pc.is_valid(table.column("term")))
    place, least, tile, source = (marks.column(c).to_numpy(zero_copy_only=False) for c in ("place", "share", "tile", "source"))
    order = np.argsort(place)
    place, least, tile, source = place[order], least[order].astype(np.int64), tile[order], source[order]
    codes = held.column("term").combine_chunks().dictionary_encode()
    shares = np.repeat(least[:, None], len(codes.dictionary), axis=1)
    row = np.searchsorted(place, held.column("place").to_numpy())
    shares[row, codes.indices.to_numpy(zero_copy_only=False)] = held.column("share").to_numpy()
    unseen = int(marks.column("block_terms")[0].as_py()) - len(codes.dictionary)
    lang = table.column("lang")[0].as_py()
    one, other, value = [], [], []
    for k in range(len(place)):
        # Within a tile each later source, else the sources of the higher tile.
        with_ = np.flatnonzero(tile > tile[k]) if tile[0] != tile[-1] else np.arange(k + 1, len(place))
        if len(with_):
            both = shares[with_] + shares[k]
            apart = shares[with_] - shares[k]
            sums = (apart * apart // both).sum(axis=1)
            away = least[with_] - least[k]
            sums += unseen * (away * away // (least[with_] + least[k]))
            one += [source[k]] * len(with_)
            other += source[with_].tolist()
            value.append(sums)
    columns = [pa.array([lang] * len(one), pa.string()), pa.array(one, pa.string()), pa.array(other, pa.string()), pa.array(np.concatenate(value) if value else [], pa.int64())]
    return pa.Table.from_arrays(columns, ["lang", "source", "item", "value"])


def _pairs(own: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` of every ordered pair of sources of a language."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("long")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("blocks", blocks).withColumn("place", place).withColumn("tile", F.floor(F.col("place") / TILE).cast("int"))
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    groups = groups.join(tiles, "lang")
    sizes = kept.join(groups.filter("place = 0").select("lang", "blocks"), "lang").groupBy("lang", block).agg(F.count(F.lit(1)).alias("block_terms"))

    least = share("0L", "total", "kept")
    marks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    marks = marks.join(sizes, ["lang", "block"], "left").withColumn("block_terms", F.coalesce("block_terms", F.lit(0)))
    marks = marks.withColumn("share", least).withColumn("term", F.lit(None).cast("string"))
    held = own.join(groups, ["lang", "source"]).withColumn("block", block).withColumn("block_terms", F.lit(0).cast("long"))
    held = held.withColumn("share", share("count", "total", "kept"))
    columns = ["lang", "block", "source", "place", "tile", "tiles", "term", "share", "block_terms"]
    both = marks.select(columns).union(held.select(columns)).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.withColumn("low", F.least("tile", "_with")).withColumn("high", F.greatest("tile", "_with")).drop("_with", "tiles")
    found = both.groupBy("lang", "block", "low", "high").applyInArrow(_compare_tiles, "lang string, source string, item string, value bigint")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    there = F.struct("source", "item")
    back = F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    return found.select("lang", F.explode(F.array(there, back)).alias("of"), "value").select("lang", "of.source", "of.item", "value")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item`` (the other source, or the term), ``value`` and ``rank`` for
    ``docs`` (``text``, ``lang``, ``source``): every pair of sources of a language, and the ``top`` terms of each group."""
    small_batches(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = docs.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("times").alias("count"), F.sum("docs").alias("docs"))
    counts = write_table(counts, "terms")
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("in_lang"))
    kept = write_table(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    own = write_table(counts.drop("docs").join(kept, ["lang", "term"]), "own")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = counts.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = write_table(groups.fillna(0, ["total", "kept", "lang_total"]), "groups")

    shared = own.join(groups, ["lang", "source"])
    shared = shared.select("lang", "source", "term", share("count", "total", "kept").alias("p"), share("in_lang", "lang_total", "kept").alias("q"))
    terms = shared.filter("p > q").selectExpr("lang", "source", "'term' as part", "term as item", "((p - q) * (p - q)) div (p + q) as value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    pairs = _pairs(own, groups, kept).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(by_value)).union(terms)

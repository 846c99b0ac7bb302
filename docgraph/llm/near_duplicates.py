"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find grouping.

1. One pass over the texts gives each document its set size, a 128-bit digest of the set, and band keys of its
   signature. Documents with equal sets form a class, represented by the smallest ``doc_id``; only representatives go on.
2. Representatives that share a band key form a bucket. A bucket is not expanded into pairs: its smallest member (the
   hub) is paired with the others, the pairs are verified on the full sets of both texts, and linked documents are
   grouped. The members of all buckets of one hub are its cluster.
3. Only clusters that still reach over several groups go on. Two members share no band unless they share a cluster, so all links
   left lie within clusters. A member is now described by the difference of its set from the hub's; two differences give the exact size of
   the members' intersection, whatever the hub is. Differences of near copies are short, so a cluster's comparison is
   a product of small sparse matrices in blocks of ``BLOCK`` members, and only links that join groups leave the task. So no link between different
   texts is missed and no pair of a large group becomes a row.
4. Groups are components of the links: union-find within each partition, then star contraction between partitions.

A signature has one value per component. Element ``d`` visits the components in a pseudo-random order; the value of its j-th
visit is j plus a random fraction, and a component keeps the least value. Once all components of a document hold values
below j + 1 no later visit can change them, so long documents stop after one or two visits per element.

Number of bands and rows per band follow from the threshold: the longest bands for which a pair at exactly the threshold
shares no band with probability under ``MISS``.

Defined results: a document without words (or with null text) has an empty set and is linked with nothing. Rows with the same
``doc_id`` are taken as one document. A row without ``doc_id`` cannot be named by others: it links with nothing, has a null
``component_id`` and is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm.text import U, mix, shingle_sets, slices, small_batches
from docgraph.plans.scratch import write_table

# Probability that a pair exactly at the threshold shares no band; above the threshold it falls fast.
MISS = 1e-6
MAX_COMPONENTS = 256
# Members of a cluster that one task compares with each other; a pair of blocks is a task.
BLOCK = 512
# Columns of a dense piece of a block's matrix.
_COLUMNS = 8192

_FRACTION_BITS = 24
_STEP = 0x9E3779B97F4A7C15


def bands_for(threshold: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows per band) with at most ``most`` components, if possible, for a similarity in (0, 1]."""
    for rows in range(most, 0, -1):
        bands = most // rows
        if (1 - threshold**rows) ** bands <= MISS:
            return bands, rows
    if most < MAX_COMPONENTS:
        return bands_for(threshold, MAX_COMPONENTS)
    raise ValueError(f"a similarity of {threshold} is too low for signatures of {MAX_COMPONENTS} components")


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Signatures (one row of ``size`` values per set) of sets of hashes; empty sets keep the largest value."""
    signatures = np.full((len(sets), size), np.iinfo(np.uint32).max, np.uint32)
    flat = signatures.ravel()
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seeds = np.concatenate(sets) if sets else np.zeros(0, U)
    # The first visit is the same without keeping the order of visits, and for most texts it is the only one.
    draw = mix(seeds + U(_STEP))
    np.minimum.at(flat, owners * size + (draw % U(size)).astype(np.int64), (draw >> U(64 - _FRACTION_BITS)).astype(np.uint32))
    open_rows = (signatures.max(axis=1) >= 1 << _FRACTION_BITS)[owners]
    owners, seeds = owners[open_rows], seeds[open_rows]
    per_part = 1 << 15
    cuts = np.searchsorted(owners, np.unique(owners)) if len(owners) else np.zeros(0, np.int64)
    while len(owners):
        # Whole documents at a time, as their early stop depends on all their elements.
        later = cuts[cuts >= min(per_part, len(owners))]
        end = int(later[0]) if len(later) else len(owners)
        _visit(flat, signatures, owners[:end], seeds[:end], size)
        owners, seeds, cuts = owners[end:], seeds[end:], cuts[cuts >= end] - end
    return signatures


def _visit(flat: np.ndarray, signatures: np.ndarray, owners: np.ndarray, seeds: np.ndarray, size: int) -> None:
    """All visits of these elements, in a random order of components drawn by Fisher-Yates swaps."""
    order = np.tile(np.arange(size, dtype=np.uint8), (len(owners), 1))
    sets, local = np.unique(owners, return_inverse=True)
    for j in range(size):
        draw = mix(seeds + U((_STEP * (j + 1)) & ((1 << 64) - 1)))
        at = np.arange(len(seeds))
        other = j + (draw % U(size - j)).astype(np.int64)
        component = order[at, other].astype(np.int64)
        order[at, other] = order[:, j]
        if not j:  # already counted
            continue
        value = (draw >> U(64 - _FRACTION_BITS)).astype(np.uint32) | np.uint32(j << _FRACTION_BITS)
        np.minimum.at(flat, sets[local] * size + component, value)
        more = signatures[sets].max(axis=1) >= (j + 1) << _FRACTION_BITS
        if not more.all():
            still = more[local]
            sets, local = sets[more], (np.cumsum(more) - 1)[local[still]]
            seeds, order = seeds[still], order[still]
            if not len(seeds):
                return


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), U) + mix(np.arange(1, bands + 1, dtype=U))
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(U)
    for k in range(rows):
        keys = mix(keys + U(_STEP)) ^ parts[:, :, k]
    return mix(keys)


def _digest(values: np.ndarray) -> bytes:
    """128 bits that do not depend on the order of the set."""
    sums = [int(np.add.reduce(mix(values + U(salt)), dtype=U)) for salt in (1, 2)]
    return b"".join(s.to_bytes(8, "little") for s in sums)


_FEATURES = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"


def _features(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), size)
            keys = band_keys(super_minhash(sets, bands * rows), bands, rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([k if len(s) else None for s, k in zip(sets, keys)], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def _similar(size: int, percent: int):
    """Pairs whose shingle sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_b", 1 << 19):
            hubs = part.column("text_a").dictionary_encode()
            known = shingle_sets(hubs.dictionary, size)
            keep = []
            for code, other in zip(hubs.indices.to_pylist(), shingle_sets(part.column("text_b"), size)):
                one = known[code]
                least = min(len(one), len(other))
                if 100 * least < percent * max(len(one), len(other)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(other) - common) and common > 0)
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _differences(size: int):
    """For pairs of a hub and a member, the size of the member's set and the hashes that only one of both sets holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_b", 1 << 19):
            hubs = part.column("text_a").dictionary_encode()
            known = shingle_sets(hubs.dictionary, size)
            others = shingle_sets(part.column("text_b"), size)
            apart = [np.setxor1d(known[code], other, assume_unique=True) for code, other in zip(hubs.indices.to_pylist(), others)]
            sizes = pa.array([len(x) for x in others], pa.int64())
            columns = [part.column("a"), part.column("b"), sizes, pa.array([x.tobytes() for x in apart], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "apart"])

    return run


def _compare_block(percent: int):
    """Links among the members of one or two blocks of a cluster, as one star per component that joins several groups."""

    def run(table: pa.Table) -> pa.Table:
        roots = table.column("root").to_numpy()
        ids = table.column("b").to_numpy()
        sizes = table.column("n").to_numpy().astype(np.int64)
        sets = [np.frombuffer(x, U) for x in table.column("apart").to_pylist()]
        lengths = np.array([len(x) for x in sets], np.int64)
        values, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Hashes that one member alone holds are in no intersection.
        number = np.cumsum(times > 1) - 1
        used = (times > 1)[where]
        column, row = number[where[used]], np.repeat(np.arange(len(sets)), lengths)[used]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            low, high = np.searchsorted(column, [first, first + _COLUMNS])
            piece = np.zeros((len(sets), min(_COLUMNS, int(column[-1]) + 1 - first)), np.float32)
            piece[row[low:high], column[low:high] - first] = 1
            common += piece @ piece.T
        apart = lengths[:, None] + lengths[None, :] - 2 * common.astype(np.int64)
        total = sizes[:, None] + sizes[None, :]
        linked = 100 * (total - apart) >= percent * (total + apart)
        # Members of one group count as linked; labels then sink to the smallest in reach.
        _, group = np.unique(roots, return_inverse=True)
        label = np.arange(len(ids))
        while True:
            low = np.full(group.max() + 1, len(ids))
            np.minimum.at(low, group, label)
            lower = np.minimum(np.where(linked, low[group][None, :], len(ids)).min(axis=1), low[group])
            if (lower == label).all():
                break
            label = lower
        return pa.table({"a": pa.array(ids[label], pa.int64()), "b": pa.array(ids, pa.int64())}).filter(pa.array(ids[label] != ids))

    return run


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition, in runs of bounded size: each node with its smallest known root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    def stars() -> pa.RecordBatch:
        nodes = [x for x in parent if parent[x] != x]
        return pa.RecordBatch.from_arrays([pa.array([find(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
                parent.setdefault(min(u, v), min(u, v))
        if len(parent) > 1_000_000:
            yield stars()
            parent.clear()
    yield stars()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(``node``, ``root``) with the smallest node of its component for every node that occurs in a link.

    Union-find in each partition first; then rounds of star contraction over the rest: each node is tied to the smallest of
    its neighbours, and its larger neighbours are tied to that one, until nothing changes.
    """
    edges = links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).filter("u <> v")
    edges = write_table(edges.mapInArrow(_forest, "u bigint, v bigint"), "forest")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        # Large star: larger neighbours of a node go to the smallest one.
        large = both.join(least, "u").filter("v > u").select(F.col("low").alias("u"), "v").filter("u <> v").distinct()
        large = write_table(large, "large")
        # Small star: a node and its smaller neighbours go to the smallest one.
        smallest = large.groupBy("v").agg(F.min("u").alias("low"))
        tied = large.join(smallest, "v").select("u", "v", "low")
        parents = tied.filter("u <> low").select(F.col("low").alias("u"), F.col("u").alias("v"))
        small = tied.select(F.col("low").alias("u"), "v").union(parents)
        edges = write_table(small.distinct(), "small")
        # A node with two parents, or a parent that has one itself, needs another round.
        split = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
        chained = edges.select(F.col("u").alias("v")).join(edges.select("v"), "v", "left_semi")
        if not split.union(chained).limit(1).count():
            break
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)


def _with_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) with ``text_a`` and ``text_b``."""
    wanted = write_table(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    texts = docs.join(wanted, "doc_id", "left_semi")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` and ``class_id`` (smallest doc_id with the same set), a row per
    row of ``docs`` (``doc_id``, ``text``, any other columns).

    Two documents are linked if their sets of shingles of ``shingle_words`` words have 100 * intersection >= ``percent`` * union.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bands, rows = bands_for(percent / 100)
    features = write_table(docs.mapInArrow(_features(shingle_words, bands, rows), _FEATURES), "features")
    named = features.filter("doc_id is not null and digest is not null")
    classes = write_table(named.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")

    # One row per class and band key; keys that occur once are dropped before anything is joined.
    members = named.join(classes, [named.digest == classes.digest, F.col("doc_id") == F.col("class_id")], "left_semi")
    keyed = members.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last")
    pairs = keyed.join(buckets, "key").filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    pairs = write_table(pairs, "pairs")
    linked = _with_texts(docs, pairs).mapInArrow(_similar(shingle_words, percent), "a bigint, b bigint")
    links = write_table(linked, "links")
    groups = write_table(components(links, "a", "b"), "groups")

    # Clusters that reach over several groups, counting the hub's own.
    told = pairs.join(groups, F.col("b") == F.col("node"), "left").select("a", "b", F.coalesce("root", "b").alias("root"))
    mixed = told.groupBy("a").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"))
    told = write_table(told.join(mixed.filter("low < high"), "a"), "told")
    apart = _with_texts(docs, told.select("a", "b")).mapInArrow(_differences(shingle_words), "a bigint, b bigint, n bigint, apart binary")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("b"), blocks.cast("long")).cast("int")
    told = told.select("a", "b", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = told.join(apart, ["a", "b"]).select("a", "b", "root", "n", "apart", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    joining = dealt.groupBy("a", "i", "j").applyInArrow(_compare_block(percent), "a bigint, b bigint")
    joining = write_table(joining, "joining")
    known = groups.select(F.col("root").alias("a"), F.col("node").alias("b"))
    groups = write_table(components(known.union(joining), "a", "b"), "groups")

    roots = classes.join(groups, F.col("class_id") == F.col("node"), "left")
    roots = roots.select("digest", "class_id", F.coalesce("root", "class_id").alias("component_id"))
    grouped = named.join(roots, "digest").select("doc_id", "n_shingles", "component_id", "class_id")
    alone = features.filter("doc_id is null or digest is null")
    alone = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return grouped.union(alone).select("doc_id", "n_shingles", "component_id", kept, "class_id")


def without_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay if each group of near duplicates keeps its smallest ``doc_id``; all columns.

    Of rows that share a ``doc_id`` one stays; rows without one all stay.
    """
    found = near_duplicates(docs, shingle_words, percent).filter("doc_id is not null")
    # Only what goes or repeats is joined: far fewer rows than stay.
    told = found.groupBy("doc_id").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    odd = write_table(told.filter("not stays or rows > 1").select("doc_id", "stays"), "odd")
    repeated = docs.join(odd.filter("stays"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.join(odd, "doc_id", "left_anti").union(repeated)

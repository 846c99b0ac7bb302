"""Exact top-k search by inner product as a Voronoi join.

1. Vectors become integers, floor(``SCALE`` * x). Equal vectors become one row with their k + 1 smallest ids, as no others of them can be
   among the k best of a query; so a vector that repeats a million times is one candidate.
2. ``PIVOTS`` vectors are pivots, and every vector belongs to the cell of its nearest pivot. The summary of a cell holds its pivot, its
   number of ids and its radius, the largest distance of a member from the pivot.
3. For a query q and a cell with pivot p and radius r every inner product lies between q.p - |q| r and q.p + |q| r. The lower bounds of
   enough cells to hold k candidates give a score that the k-th best reaches at least; a cell whose upper bound lies below
   it holds no result. Queries are copied only to the cells left; the data is dealt out once, whatever the queries are.
4. Cells are dealt in blocks of about ``BLOCK`` vectors, chosen by a hash, so a crowded cell is many tasks. A task holds one block at a time, and
   its queries pass by in batches: scores are a matrix product, and only the k best of each query leave. The best of all blocks are merged.

Inner products are exact: float64 matrix products where all sums stay below 2**53, integer ones below 2**62, else numbers of any size for all vectors
that the float64 products, within their error, leave among the k best.

Defined results: a vector that is null, empty, or has a null or non-finite component takes no part, as query or candidate; nor does a row
without id, or a vector with a component beyond ``LARGEST`` after scaling, as its integers don't fit 64 bits. A score among the k best that doesn't fit a
long ends the job. Only vectors of equal length are compared. Equal scores go to the smaller id. Rows that share an id count once, with the smallest of their vectors. Without
rows, queries or candidates there is no result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.llm.text import small_batches
from docgraph.plans.scratch import write_table

SCALE = 1024
PIVOTS = 64
BLOCK = 16_384
LARGEST = 1 << 62

_SCORES = "query_id bigint, vec_id bigint, score bigint"


def _whole(vector: Column, scale: int) -> Column:
    """The vector as integers, null if it takes no part."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    # A comparison with NaN as the largest value excludes it as well.
    fits = F.forall(scaled, lambda x: F.coalesce((x >= -LARGEST) & (x <= LARGEST), F.lit(False)))
    return F.when((F.size(vector) > 0) & fits, F.transform(scaled, lambda x: F.floor(x)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows."""
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _most(a: np.ndarray, b: np.ndarray) -> float:
    """A bound of the inner products of the rows of both."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of both: exact, unless they could leave 64 bits."""
    if _most(a, b) < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if _most(a, b) < 2**62 else a.astype(np.float64) @ b.T.astype(np.float64)


def _error(a: np.ndarray, b: np.ndarray) -> float:
    """By how much ``_products`` may be wrong."""
    return 0 if _most(a, b) < 2**62 else _most(a, b) * (a.shape[1] + 2) * 2.0**-52


class Pivots:
    """Pivots by length of vector, with cells numbered from 0; cell -1 takes vectors of other lengths."""

    def __init__(self, vectors: list[list[int]]):
        by_length: dict[int, list] = {}
        for vector in vectors:
            if vector not in by_length.setdefault(len(vector), []):
                by_length[len(vector)].append(vector)
        self.tables = {length: np.array(rows, np.float64) for length, rows in by_length.items()}

    def nearest(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and its distance from the pivot."""
        cells, distances = np.full(len(column), -1), np.zeros(len(column))
        lengths = np.asarray(column.value_lengths())
        for length, table in self.tables.items():
            chosen = np.flatnonzero(lengths == length)
            if len(chosen):
                rows = _matrix(column.take(pa.array(chosen))).astype(np.float64)
                squares = (rows**2).sum(1)[:, None] + (table**2).sum(1) - 2 * rows @ table.T
                cells[chosen] = squares.argmin(1)
                distances[chosen] = np.linalg.norm(rows - table[cells[chosen]], axis=1)
        return cells, distances


def _worth_visiting(pivots: Pivots, summary: dict[tuple[int, int], tuple[int, float]], k: int):
    """Cells that may hold one of a query's k best, given (length, cell): (ids, radius)."""

    @F.arrow_udf("array<int>")
    def cells(vectors: pa.Array) -> pa.Array:
        found: list = []
        for vector in vectors.to_pylist():
            query, length = np.array(vector, np.float64), len(vector)
            here = sorted(cell for size, cell in summary if size == length)
            own = [c for c in here if c >= 0]
            if not own:
                found.append(here)
                continue
            count = np.array([summary[length, c][0] for c in own])
            # A little more than the radius, as distances are rounded.
            reach = np.linalg.norm(query) * np.array([summary[length, c][1] for c in own]) * (1 + 1e-9) + 1e-6
            middle = pivots.tables[length][own] @ query
            order = np.argsort(reach - middle, kind="stable")
            # One candidate may be the query itself.
            enough = np.searchsorted(np.cumsum(count[order]), k + 1)
            least = (middle - reach)[order[enough]] if enough < len(own) else -np.inf
            slack = 1e-9 * np.abs(middle) + 1e-6
            found.append([c for c in here if c < 0] + [c for c, high in zip(own, middle + reach + slack) if high >= least - 1e-6 * max(1, abs(least))])
        return pa.array(found, pa.list_(pa.int32()))

    return cells


def _search(k: int):
    """k best of each query in each block. Rows come sorted by block, a block's vectors (with ``ids``) before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, ids, block = None, [], [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("length", "cell", "block", "is_query"))))
            first = 0
            while first < len(keys):
                last = first
                while last < len(keys) and keys[last] == keys[first]:
                    last += 1
                part = batch.slice(first, last - first)
                if keys[first][:3] != key:
                    key, vectors, ids, block = keys[first][:3], [], [], None
                if not keys[first][3]:
                    vectors.append(_matrix(part.column("vector")))
                    ids += part.column("ids").to_pylist()
                elif vectors:
                    block = np.concatenate(vectors) if block is None else block
                    yield _best(block, ids, _matrix(part.column("vector")), part.column("query_id").to_pylist(), k)
                first = last

    return run


def _best(block: np.ndarray, ids: list[list[int]], queries: np.ndarray, query_ids: list[int], k: int) -> pa.RecordBatch:
    rows: list[tuple[int, int, int]] = []
    scores, error = _products(queries, block), _error(queries, block)
    for vector, query, own in zip(queries, scores, query_ids):
        # Of k + 1 vectors at most one is the query's own.
        least = np.partition(query, -(k + 1))[-(k + 1)] if len(query) > k + 1 else query.min()
        near = np.flatnonzero(query >= least - 2 * error).tolist()
        exact = {at: int(query[at]) if not error else sum(x * y for x, y in zip(vector.tolist(), block[at].tolist())) for at in near}
        found = [(-exact[at], other) for at in near for other in ids[at] if other != own]
        rows += [(own, other, -score) for score, other in sorted(found)[:k]]
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best rows of each query.

    ``is_query`` is a condition on ``vec_id`` that tells which rows are queries; all rows with another id are their candidates.
    """
    spark = rows.sparkSession
    small_batches(spark)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), _whole(F.col(vector), scale).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    repeated = write_table(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"), "repeated")
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = write_table(rows.join(repeated, "vec_id", "left_anti").union(one), "vectors")

    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector").collect()
    pivots = Pivots([list(r.vector) for r in chosen])

    @F.arrow_udf("struct<cell:int,distance:double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        cells, distances = pivots.nearest(vectors)
        return pa.StructArray.from_arrays([pa.array(cells, pa.int32()), pa.array(distances)], ["cell", "distance"])

    # The limit per vector is applied before the shuffle, so a vector that many rows share moves only a few of them.
    order = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = rows.withColumn("_order", order).filter(F.col("_order") <= k + 1).groupBy("vector").agg(F.collect_list("vec_id").alias("ids"))
    placed = distinct.withColumn("_at", nearest("vector")).select("vector", "ids", F.size("vector").alias("length"), "_at.*")
    placed = write_table(placed, "placed")
    cells = placed.groupBy("length", "cell").agg(
        F.sum(F.size("ids")).alias("ids"), F.max("distance").alias("radius"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    )
    cells = cells.collect()  # at most PIVOTS, and one for each other length
    summary = {(c.length, c.cell): (c.ids, c.radius) for c in cells}
    sizes = F.create_map(*[F.lit(x) for c in cells for x in (f"{c.length}:{c.cell}", c.blocks)]) if cells else F.create_map().cast("map<string,int>")
    blocks = F.element_at(sizes, F.concat_ws(":", "length", "cell"))

    visits = rows.filter(is_query).withColumn("cell", F.explode(_worth_visiting(pivots, summary, k)("vector")))
    visits = visits.withColumn("length", F.size("vector"))
    visits = visits.select("length", "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("is_query"), "vector", F.lit(None).cast("array<bigint>").alias("ids"), F.col("vec_id").alias("query_id"))
    block = F.pmod(F.xxhash64("vector"), blocks.cast("long")).cast("int").alias("block")
    data = placed.select("length", "cell", block, F.lit(False).alias("is_query"), "vector", "ids", F.lit(None).cast("bigint").alias("query_id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = data.union(visits).repartition(parts, "length", "cell", "block").sortWithinPartitions("length", "cell", "block", "is_query")
    found = dealt.mapInArrow(_search(k), _SCORES)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

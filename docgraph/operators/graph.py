"""Recursive graph lookup over a vertex table and an edge table.

Rules (stated here because the query form alone does not fix them):

0. A start value is matched against ``to_field``; the ``from_field`` value of a matched edge is the
   next value to match.
1. ``dist(v)`` is the least number of hops from the start (0 for the start itself).
2. ``uni``: an edge is returned when ``dist(to_field) <= max_depth``, with that distance as depth.
3. ``bi``: edges are usable both ways; an edge is returned when the lesser distance of its two ends
   is at most ``max_depth``, with that value as depth.
4. Each edge row is returned once per start. Parallel rows each count; a self-loop counts once.
5. Batch: distances are the least over all starts, and every edge is returned once.
6. A start key that is absent from the vertex table gives no row; one without edges gives an empty
   report and counts of 0.
7. Null ends never match and are not counted as nodes. An edge with one null end is still returned
   for its other end.

How it runs: all starts are traversed together. A start is one bit of a ``bits`` column, so a
vertex that many starts reach in the same round is one row, and one pass over the edges moves them
all. Starts beyond ``FLAGS`` go to further ``word`` values. Every round writes its newly reached
``(node, word, bits)`` rows to the shared folder; the edge lists are written once, bucketed by node
with hot vertices split into pieces, and are never shuffled again. Only the newly reached rows and
the combined candidates move.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, LongType, StringType, StructField, StructType

from docgraph.plans.scratch import scratch_path, write_bucketed, write_counted, write_table
from docgraph.plans.groups import collect_pages
from docgraph.plans.skew import HotKeys, find_hot_keys, join_skewed
from docgraph.plans.together import run_together

# Starts per word. The top two bits stay free so that no bit arithmetic overflows under ANSI rules.
FLAGS = 62

DIRECTIONS = ("uni", "bi")

COUNTS = ("edge_count", "node_count")

# Frontiers up to this size are left to Catalyst, which broadcasts them while their files are small.
FEW_ROWS = 200_000

# Frontier rows per bucket that one task may hold in a hash table (some tens of MB).
HASHED_ROWS = 1_000_000

# Vertices that a plan names one by one at most; fewer than half the buckets in any case, so that buckets are left out.
NAMED_NODES = 1_000

# Column by which the rows of a hot vertex are spread over its pieces.
SPREAD = "_spread"


def _of_few(table: DataFrame, buckets: int, vertices: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of a bucketed table that ``vertices`` can meet, as far as the scan can tell.

    A few vertices are named, so that only their buckets are opened (every bucket if hot vertices are split) and, as these are sorted,
    only the pages with their rows are read. Joins find the rows of more vertices. ``rows`` is the number of vertices, where known.
    """
    node_type = table.schema["node"].dataType
    most = min(NAMED_NODES, buckets // 2)
    if not isinstance(node_type, (IntegralType, StringType)) or (most if rows is None else rows) > most:
        return table
    nodes = [row["node"] for row in vertices.select("node").take(most + 1)]
    return table if len(nodes) > most else table.filter(F.col("node").isin([F.lit(n).cast(node_type) for n in nodes]))


@dataclass
class EdgeList:
    """``(node, neighbour, n)`` rows, n parallel edges each, bucketed by node."""

    table: DataFrame
    buckets: int
    hot: HotKeys

    def with_node(self, vertices: DataFrame, how: str = "inner", hashed: bool = False) -> DataFrame:
        """The edge rows with the columns that ``vertices`` has for their node; only ``vertices`` moves."""
        keys, vertices = self.hot.keys("node"), self.hot.copy(vertices, "node")
        return self.table.join(vertices.hint("shuffle_hash") if hashed else vertices, keys, how).drop(*keys[1:])

    def neighbours(self, frontier: DataFrame, rows: int = 0) -> DataFrame:
        """Send the bits of every frontier vertex to its neighbours.

        A frontier of few rows is broadcast by its size. One whose share per bucket fits a hash
        table spares sorting the edges; a larger one is merged.
        """
        near = EdgeList(_of_few(self.table, self.buckets, frontier, rows), self.buckets, self.hot)
        sent = near.with_node(frontier, hashed=FEW_ROWS < rows <= HASHED_ROWS * self.buckets)
        return sent.filter(F.col("neighbour").isNotNull()).select(F.col("neighbour").alias("node"), "word", "bits")

    def totals(self) -> DataFrame:
        """Edge rows per node."""
        return self.table.groupBy("node").agg(F.sum("n").alias("n"))


@dataclass
class Links:
    """An edge table prepared for traversal; reusable for any number of lookups.

    ``edges`` are the rows that lookups return.
    """

    edges: DataFrame
    from_field: str
    to_field: str
    forward: EdgeList
    reverse: EdgeList | None
    _placed: tuple[DataFrame, int] | None = field(default=None, repr=False)

    @property
    def node_type(self):
        return self.edges.schema[self.to_field].dataType

    def placed(self) -> tuple[DataFrame, int]:
        """The edge rows with their first end as ``node``, bucketed by it like the forward list, and a number that was written with
        each row as ``SPREAD``; and the number of buckets. Written by the first lookup; sweeps don't need it."""
        if self._placed is None:
            hot = self.forward.hot
            rows = self.edges.withColumn("node", F.coalesce(self.to_field, self.from_field)).filter(F.col("node").isNotNull())
            # Copies of one edge agree in every field; a number written with each row tells them apart.
            rows = write_table(rows.withColumn(SPREAD, F.monotonically_increasing_id()), "edges") if hot.salted else rows.withColumn(SPREAD, F.monotonically_increasing_id())
            self._placed = write_bucketed(hot.scatter(rows, "node", by=SPREAD), hot.keys("node"), hot.rows, "edges")
        return self._placed

    def rows_at(self, vertices: DataFrame) -> DataFrame:
        """The edge rows with the columns that ``vertices`` has for their ``node``; only ``vertices`` moves."""
        keys = self.forward.hot.keys("node")
        near = _of_few(*self.placed(), vertices)
        return near.join(self.forward.hot.copy(vertices, "node"), keys).drop(*keys[1:])

    def lists(self, direction: str) -> list[EdgeList]:
        if direction not in DIRECTIONS:
            raise ValueError(f"direction must be one of {DIRECTIONS}, not {direction!r}")
        if direction == "uni":
            return [self.forward]
        if self.reverse is None:
            raise ValueError("the links were prepared without the reverse direction")
        return [self.forward, self.reverse]


def prepare_links(
    edges: DataFrame,
    from_field: str = "target",
    to_field: str = "source",
    both_ways: bool = True,
    min_split_rows: int | None = None,
) -> Links:
    """Write the edge lists of ``edges``, one per direction in which they can be followed.

    The edge table is read once, to sum parallel edges; the lists and the search for hot vertices
    work on the narrow sums.
    """
    spark = edges.sparkSession
    edges = edges.withColumn(from_field, F.col(from_field).cast(edges.schema[to_field].dataType))
    pairs = write_table(edges.groupBy(to_field, from_field).agg(F.count(F.lit(1)).alias("n")), "pairs")

    def edge_list(node: str, neighbour: str) -> EdgeList:
        rows = pairs.filter(F.col(node).isNotNull()).select(F.col(node).alias("node"), F.col(neighbour).alias("neighbour"), "n")
        hot = find_hot_keys(rows, "node", min_split_rows, F.col("n"))
        spread = hot.scatter(rows, "node", by="neighbour")
        return EdgeList(*write_bucketed(spread, hot.keys("node"), hot.rows, "links"), hot)

    forward, *reverse = run_together(
        spark, [lambda: edge_list(to_field, from_field)] + [lambda: edge_list(from_field, to_field)] * both_ways
    )
    return Links(edges, from_field, to_field, forward, *reverse or [None])


def _word_and_flag(position: str) -> tuple[Column, Column]:
    """Word and bit number of the start at a zero-based position, given as an SQL expression."""
    return F.expr(f"({position}) div {FLAGS}"), F.expr(f"cast(pmod({position}, {FLAGS}) as int)")


def _bit(flag: str | Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(flag) if isinstance(flag, str) else flag)


def _flag_position(rows: DataFrame, flags: int) -> DataFrame:
    """One row per set bit, its number in column ``flag``; ``flags`` numbers are in use."""
    positions = F.array(*[F.lit(i) for i in range(flags)])
    # Chosen within the array, so that no row is made for a bit that is not set. Most rows have one bit, whose number needs no search.
    several = F.filter(positions, lambda i: F.getbit("bits", i) == 1)
    alone = F.array(F.bit_count(F.col("bits") - 1).cast("int"))
    return rows.withColumn("flag", F.explode(F.when(F.bit_count("bits") == 1, alone).otherwise(several)))


def _lowest_position(word: Column, bits: Column) -> Column:
    lowest = bits.bitwiseAND(-bits)
    return word * FLAGS + F.bit_count(lowest - 1)


def traverse(links: Links, seeds: DataFrame, direction: str, rounds: int) -> DataFrame:
    """Distances from the seeds: ``(node, word, bits, dist)``, each bit of a node at one distance.

    ``seeds`` has ``(node, word, bits)``. The driver only learns the number of rows of each round.
    """
    lists = links.lists(direction)
    spark = seeds.sparkSession
    path = scratch_path(spark, "reached")
    layout = StructType(
        [
            StructField("node", links.node_type),
            StructField("word", LongType()),
            StructField("bits", LongType()),
            StructField("dist", IntegerType()),
        ]
    )

    def reached() -> DataFrame:
        return spark.read.schema(layout).parquet(path)

    # One way, a neighbour may lie in any earlier round. All reached rows then form a table bucketed by node and word, to which each
    # round appends, so that they are compared where they are.
    name = f"spark_catalog.default.docgraph_reached_{uuid4().hex}" if direction == "uni" else None
    # With as many buckets as shuffle partitions, combining the candidates already puts them where they are compared.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near_enough = partitions // 2 <= links.forward.buckets <= partitions
    buckets = partitions if near_enough else links.forward.buckets

    def written(fresh: DataFrame, dist: int) -> int:
        if name is None:
            return write_counted(fresh, f"{path}/dist={dist}")
        seen = Observation()
        placed = fresh.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("dist", F.lit(dist))
        writer = placed.write.format("parquet").partitionBy("dist").bucketBy(buckets, "node", "word")
        writer.option("path", path).mode("append").saveAsTable(name)
        return seen.get["rows"]

    rows = written(seeds.groupBy("node", "word").agg(F.bit_or("bits").alias("bits")), 0)
    for dist in range(1, rounds + 1):
        if rows == 0:
            break
        frontier = reached().filter(F.col("dist") == dist - 1)
        sent = [edge_list.neighbours(frontier, rows) for edge_list in lists]
        if name is None:
            # Both ways, a neighbour of round k-1 lies in round k-2, k-1 or k: older rounds need no check.
            fresh = _not_in_last_rounds(sent, reached().filter(F.col("dist") >= dist - 2))
        else:
            fresh = _not_reached(sent[0], spark.table(name), None if near_enough else buckets)
        rows = written(fresh, dist)
    if name is not None:
        spark.sql(f"DROP TABLE {name}")
    return reached()


def _not_in_last_rounds(sent: list[DataFrame], last: DataFrame) -> DataFrame:
    """The new bits of the candidates; one shuffle combines the candidates and removes what a start has reached before."""
    none = F.lit(None).cast("long")
    moved = last.select("node", "word", none.alias("bits"), F.col("bits").alias("seen"))
    for candidates in sent:
        moved = moved.union(candidates.select("*", none))
    new_bits = F.bit_or("bits").bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or("seen"), F.lit(0).cast("long"))))
    return moved.groupBy("node", "word").agg(new_bits.alias("bits")).filter(F.col("bits") != 0)


def _not_reached(sent: DataFrame, reached: DataFrame, buckets: int | None) -> DataFrame:
    """The new bits of the candidates; only the combined candidates move, to the ``buckets`` of the reached rows if these are not the shuffle's."""
    candidates = sent.groupBy("node", "word").agg(F.bit_or("bits").alias("bits"))
    candidates = candidates.repartition(buckets, "node", "word") if buckets else candidates
    seen = reached.groupBy("node", "word").agg(F.bit_or("bits").alias("seen"))
    new_bits = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("seen", F.lit(0).cast("long"))))
    return candidates.join(seen, ["node", "word"], "left").select("node", "word", new_bits.alias("bits")).filter(F.col("bits") != 0)


def reached_edges(links: Links, reached: DataFrame, direction: str, max_depth: int, depth_field: str = "depth") -> DataFrame:
    """Rows of the edge table with ``word``, ``bits`` and their depth.

    For ``bi``, ``reached`` must extend one round beyond ``max_depth``: then both ends of a returned
    edge are in it, and matching the two ends bit by bit gives every start's lesser distance
    without grouping the edges.
    """
    to_end, from_end = links.to_field, links.from_field
    if direction == "uni":
        near = reached.filter(F.col("dist") <= max_depth)
        placed = links.rows_at(near).filter(F.col(to_end).isNotNull())
        return placed.drop("node", SPREAD).withColumnRenamed("dist", depth_field)
    placed = links.rows_at(_near(reached)).withColumn("node", F.coalesce(from_end, to_end))
    return _at_both_ends(links, placed, reached, max_depth, depth_field)


def _near(reached: DataFrame) -> DataFrame:
    return reached.withColumnsRenamed({"bits": "_bits", "dist": "_dist"})


def _at_both_ends(links: Links, placed: DataFrame, reached: DataFrame, max_depth: int, depth_field: str) -> DataFrame:
    """Complete rows that have one end's distances with those of the other end, ``node``."""
    far = reached.withColumnsRenamed({"bits": "_far_bits", "dist": "_far_dist", "word": "_far_word"})
    placed = join_skewed(placed, far, "node", links.reverse.hot, SPREAD)
    return (
        placed.filter(F.col("word") == F.col("_far_word"))
        .withColumn("bits", F.col("_bits").bitwiseAND(F.col("_far_bits")))
        .withColumn(depth_field, F.least("_dist", "_far_dist"))
        .filter((F.col("bits") != 0) & (F.col(depth_field) <= max_depth))
        .drop("node", SPREAD, "_bits", "_dist", "_far_bits", "_far_dist", "_far_word")
    )


def start_keys(
    vertices: DataFrame, starts: DataFrame | Iterable | None = None, start_field: str = "id", node_type=None
) -> DataFrame:
    """The wanted start keys that exist in the vertex table, as column ``start``."""
    node_type = node_type or vertices.schema[start_field].dataType
    keys = vertices.select(F.col(start_field).cast(node_type).alias("start")).filter(F.col("start").isNotNull())
    if starts is None:
        return keys.distinct()
    if not isinstance(starts, DataFrame):
        layout = StructType([StructField("start", vertices.schema[start_field].dataType)])
        starts = vertices.sparkSession.createDataFrame([(key,) for key in starts], layout)
    wanted = starts.select(F.col(starts.columns[0]).cast(node_type).alias("start"))
    return keys.join(wanted, "start", "left_semi").distinct()


# Words that the starts of one partition may take: monotonically increasing ids leave 2**33 for each.
_WORDS_PER_PARTITION = -(-(1 << 33) // FLAGS)


def number_starts(starts: DataFrame) -> tuple[DataFrame, int]:
    """Give every start a word and a flag: ``(start, word, flag)``, written so that it stays fixed.

    Also returns how many flags of a word are in use. One job counts and numbers; few starts share one partition of the
    shuffle, as adaptive execution joins small ones, so that their words are full.
    """
    row = F.monotonically_increasing_id()
    numbered = starts.select("start").distinct().select("start", F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    word, flag = _word_and_flag("at")
    numbered = numbered.select("start", (F.col("part") * _WORDS_PER_PARTITION + word).alias("word"), flag.alias("flag"))
    path = scratch_path(starts.sparkSession, "starts")
    count = write_counted(numbered, path)
    return starts.sparkSession.read.schema(numbered.schema).parquet(path), max(1, min(FLAGS, count))


def _seeds(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("start").alias("node"), "word", _bit("flag").alias("bits"))


def _one_seed(starts: DataFrame) -> DataFrame:
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return starts.select(F.col("start").alias("node"), zero.alias("word"), one.alias("bits"))


def _per_start(rows: DataFrame, numbered: DataFrame, flags: int) -> DataFrame:
    """Replace ``word`` and ``bits`` by one row per start."""
    return _flag_position(rows, flags).join(numbered, ["word", "flag"]).drop("word", "flag", "bits")


def graph_lookup(
    vertices: DataFrame,
    edges: DataFrame | Links,
    starts: DataFrame | Iterable | None = None,
    start_field: str = "id",
    from_field: str = "target",
    to_field: str = "source",
    depth_field: str = "depth",
    max_depth: int = 0,
    direction: str = "uni",
    batch: bool = False,
) -> DataFrame:
    """Every edge reached from the starts, with its depth, as flat rows.

    One row per start and edge with the start key in ``start``; with ``batch`` one row per edge.
    Without ``starts`` every vertex is a start. Pass prepared ``Links`` to look up repeatedly.
    """
    if max_depth < 0:
        raise ValueError("max_depth must not be negative")
    links = edges if isinstance(edges, Links) else prepare_links(edges, from_field, to_field, direction == "bi")
    keys = start_keys(vertices, starts, start_field, links.node_type)
    rounds = max_depth + (direction == "bi")
    if batch:
        reached = traverse(links, _one_seed(keys), direction, rounds)
        return reached_edges(links, reached, direction, max_depth, depth_field).drop("word", "bits")
    numbered, flags = number_starts(keys)
    reached = traverse(links, _seeds(numbered), direction, rounds)
    returned = reached_edges(links, reached, direction, max_depth, depth_field)
    return _per_start(returned, numbered, flags)


def nest_reports(
    flat: DataFrame, starts: DataFrame, as_field: str = "reports", page_rows: int = 10_000
) -> DataFrame:
    """The edges of each start as an array of structs; a start without edges has an empty array.

    A start with more than ``page_rows`` edges gets several rows, numbered by ``page``, so that no
    array grows with the graph. Edges are in the order of their fields.
    """
    fields = [c for c in flat.columns if c != "start"]
    nested = collect_pages(flat, ["start"], F.struct(*fields), as_field, page_rows)
    empty = F.array().cast(nested.schema[as_field].dataType)
    # The pages stay where they are; only keys are compared.
    without = starts.select("start").join(nested.filter("page = 0").select("start"), "start", "left_anti")
    return nested.unionByName(without.select("start", F.lit(0).alias("page"), empty.alias(as_field)))


def edge_count(flat: DataFrame, starts: DataFrame) -> DataFrame:
    """Number of edges per start in the rows of a lookup, 0 if none; ``lookup_counts`` counts without making the rows."""
    counts = flat.groupBy("start").agg(F.count(F.lit(1)).alias("edge_count"))
    return starts.select("start").join(counts, "start", "left").fillna(0, ["edge_count"])


def node_count(
    flat: DataFrame, starts: DataFrame, from_field: str = "target", to_field: str = "source"
) -> DataFrame:
    """Distinct ends of the edges per start in the rows of a lookup; the start counts only if it is on an edge."""
    ends = flat.select("start", F.explode(F.array(to_field, from_field)).alias("node")).filter(F.col("node").isNotNull())
    counts = ends.distinct().groupBy("start").agg(F.count(F.lit(1)).alias("node_count"))
    return starts.select("start").join(counts, "start", "left").fillna(0, ["node_count"])


def lookup_counts(
    vertices: DataFrame,
    edges: DataFrame | Links,
    starts: DataFrame | Iterable | None = None,
    max_depth: int = 0,
    direction: str = "uni",
    counts: Iterable[str] = COUNTS,
    **fields: str,
) -> DataFrame:
    """``start`` and the wanted ``counts`` of the lookup from each start, without a row per start and edge."""
    counts = list(counts)
    return depth_sweep(vertices, edges, starts, [max_depth], [direction], counts=counts, **fields).select("start", *counts)


def _alive(links: Links, direction: str, reached: DataFrame) -> DataFrame:
    """Reached rows that lie on a returned edge: all but the starts without an edge to follow."""
    seeds = reached.filter(F.col("dist") == 0)
    used = None
    for edge_list in links.lists(direction):
        some = edge_list.with_node(seeds).select(*reached.columns)
        used = some if used is None else used.unionAll(some)
    return used.distinct().unionAll(reached.filter(F.col("dist") > 0))


def _pairs_with_node(links: Links, vertices: DataFrame, how: str = "inner") -> DataFrame:
    """All edge rows once, summed per pair of ends, with one end's columns; ``node`` is the other end.

    Edges come from the forward list; those without a ``to_field`` are only in the reverse list. An
    edge with one null end has the same vertex as both.
    """
    forward = links.forward.with_node(vertices, how)
    lone = links.reverse.with_node(vertices, how).filter(F.col("neighbour").isNull())
    pairs = forward.unionByName(lone).withColumn(SPREAD, F.col("node"))
    return pairs.withColumn("node", F.coalesce("neighbour", "node")).drop("neighbour")


def _first_edges(links: Links, direction: str, reached: DataFrame, max_depth: int) -> DataFrame:
    """``(word, bits, depth, n)``: n edge rows first returned at that depth."""
    if direction == "uni":
        # All edges of a vertex come back together, so its edge total stands for them.
        near = reached.filter(F.col("dist") <= max_depth)
        return links.forward.totals().join(near, "node").withColumnRenamed("dist", "depth")
    return _at_both_ends(links, _pairs_with_node(links, _near(reached)), reached, max_depth, "depth")


def depth_sweep(
    vertices: DataFrame,
    edges: DataFrame | Links,
    starts: DataFrame | Iterable | None,
    max_depths: Iterable[int],
    directions: Iterable[str] = DIRECTIONS,
    start_field: str = "id",
    from_field: str = "target",
    to_field: str = "source",
    counts: Iterable[str] = COUNTS,
) -> DataFrame:
    """Edge and node counts, or one of them, for every start, depth and direction, from one traversal per direction.

    The edges for a depth are those the deepest run first returned at that depth or before, and
    their ends are the vertices within one more hop. Edges alone don't need that hop, unless they are followed both ways.
    """
    directions, depths, shown = list(directions), sorted(set(max_depths)), list(counts)
    if not shown or not set(shown) <= set(COUNTS):
        raise ValueError(f"counts must be some of {COUNTS}, not {shown}")
    links = edges if isinstance(edges, Links) else prepare_links(edges, from_field, to_field, "bi" in directions)
    numbered, flags = number_starts(start_keys(vertices, starts, start_field, links.node_type))
    wanted = F.array(*[F.lit(d) for d in depths])
    rounds = {d: depths[-1] + ("node_count" in shown or d == "bi") for d in directions}
    runs = run_together(vertices.sparkSession, [partial(traverse, links, _seeds(numbered), d, rounds[d]) for d in directions])
    results = []
    for direction, reached in zip(directions, runs):
        first_edges = _flag_position(_first_edges(links, direction, reached, depths[-1]), flags).select(
            "word", "flag", "depth", "n", F.lit(0).alias("nodes")
        )
        # A vertex joins the ends of the returned edges one round before its own distance.
        first_nodes = _flag_position(_alive(links, direction, reached), flags).select(
            "word",
            "flag",
            F.greatest(F.col("dist") - 1, F.lit(0)).alias("depth"),
            F.lit(0).alias("n"),
            F.lit(1).alias("nodes"),
        )
        counted = {"edge_count": first_edges, "node_count": first_nodes}
        counts = (
            _union([counted[c] for c in shown])
            .groupBy("word", "flag", "depth")
            .agg(F.sum("n").alias("n"), F.sum("nodes").alias("nodes"))
            .withColumn("max_depth", F.explode(F.filter(wanted, lambda d: d >= F.col("depth"))))
            .groupBy("word", "flag", "max_depth")
            .agg(F.sum("n").alias("edge_count"), F.sum("nodes").alias("node_count"))
        )
        results.append(
            numbered.withColumn("max_depth", F.explode(wanted))
            .join(counts, ["word", "flag", "max_depth"], "left")
            .select("start", "max_depth", F.lit(direction).alias("direction"), *shown)
            .fillna(0, shown)
        )
    return _union(results)


def multivalue_sweep(
    vertices: DataFrame,
    edges: DataFrame | Links,
    ranked: DataFrame,
    max_depth: int = 3,
    directions: Iterable[str] = DIRECTIONS,
    start_field: str = "id",
    from_field: str = "target",
    to_field: str = "source",
) -> DataFrame:
    """Batch edge and node counts for the first 1, 2, ... N starts, from one traversal per direction.

    ``ranked`` has ``start`` and ``rank`` (1..N). The batch of the first k starts reaches whatever
    the lowest rank that reaches it allows, so each edge and node is counted once, at that rank.
    """
    directions = list(directions)
    links = edges if isinstance(edges, Links) else prepare_links(edges, from_field, to_field, "bi" in directions)
    known = start_keys(vertices, ranked.select("start"), start_field, links.node_type)
    ranked = write_table(ranked.select(F.col("start").cast(links.node_type), "rank"), "ranked")
    word, flag = _word_and_flag("cast(rank as bigint) - 1")
    seeds = ranked.join(known, "start", "left_semi").select(
        F.col("start").alias("node"), word.alias("word"), _bit(flag).alias("bits")
    )
    lowest = F.min(_lowest_position(F.col("word"), F.col("bits"))).alias("rank")
    runs = run_together(vertices.sparkSession, [partial(traverse, links, seeds, d, max_depth + 1) for d in directions])
    results = []
    for direction, reached in zip(directions, runs):
        rank_of = reached.filter(F.col("dist") <= max_depth).groupBy("node").agg(lowest)
        if direction == "uni":
            first_edges = links.forward.totals().join(rank_of, "node").select("rank", "n")
        else:
            pairs = _pairs_with_node(links, rank_of, "left").withColumnRenamed("rank", "_rank")
            pairs = join_skewed(pairs, rank_of, "node", links.reverse.hot, SPREAD, "left")
            first_edges = pairs.select(F.least("_rank", "rank").alias("rank"), "n").filter(F.col("rank").isNotNull())
        first_nodes = _alive(links, direction, reached).groupBy("node").agg(lowest)
        counts = (
            first_edges.select("rank", "n", F.lit(0).alias("nodes"))
            .unionByName(first_nodes.select("rank", F.lit(0).alias("n"), F.lit(1).alias("nodes")))
            .groupBy("rank")
            .agg(F.sum("n").alias("n"), F.sum("nodes").alias("nodes"))
            .withColumn("rank", F.col("rank") + 1)
        )
        results.append(
            _running_totals(ranked.select("rank").distinct(), counts)
            .withColumn("direction", F.lit(direction))
            .withColumn("max_depth", F.lit(max_depth))
        )
    return _union(results).select("num_start_values", "max_depth", "direction", "edge_count", "node_count")


# Ranks whose running totals one task makes.
_RANKS = 4096


def _running_totals(ranks: DataFrame, counts: DataFrame) -> DataFrame:
    """Sum the counts of all ranks up to each rank: within stretches of ``_RANKS``, plus the totals of the stretches before."""
    rows = ranks.join(counts, "rank", "left").fillna(0, ["n", "nodes"]).withColumn("_stretch", F.floor(F.col("rank") / _RANKS))
    rows = write_table(rows, "ranks")
    within = Window.partitionBy("_stretch").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    # One row per stretch here.
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy("_stretch").agg(F.sum("n").alias("n"), F.sum("nodes").alias("nodes"))
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}")
    total = lambda c: (F.col(f"_{c}") + F.sum(c).over(within)).cast("long")
    return rows.join(whole.select("_stretch", earlier("n"), earlier("nodes")), "_stretch").select(
        F.col("rank").cast("int").alias("num_start_values"), total("n").alias("edge_count"), total("nodes").alias("node_count")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def random_starts(vertices: DataFrame, start_field: str = "id", n: int = 10, seed: int | None = None) -> DataFrame:
    """N random start keys with their rank.

    With a seed the order is a hash of seed and key, so the choice does not depend on partitioning.
    """
    if seed is None:
        order = F.rand()
    else:
        order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(start_field).cast("string")))
    chosen = (
        vertices.filter(F.col(start_field).isNotNull())
        .select(F.col(start_field).alias("start"), order.alias("_order"))
        .orderBy("_order", "start")
        .limit(n)
    )
    ranked = chosen.select("start", F.row_number().over(Window.orderBy("_order", "start")).alias("rank"))
    # Without a seed every evaluation would choose anew.
    return write_table(ranked, "starts") if seed is None else ranked


def edge_report_parse(reports: DataFrame, column: str = "report", from_field: str = "target", to_field: str = "source") -> DataFrame:
    """Read ``{date, source, target, depth}`` texts; texts with fewer than three parts are skipped."""
    parts = F.split(F.expr(f"trim(BOTH '{{}}' FROM `{column}`)"), ",")
    return (
        reports.withColumn("_parts", parts)
        .filter(F.size("_parts") >= 3)
        .withColumn(to_field, F.trim(F.element_at("_parts", 2)))
        .withColumn(from_field, F.trim(F.element_at("_parts", 3)))
        .drop("_parts")
    )

"""Graph lookup against a literal brute-force expansion."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from docgraph.operators import degree, graph
from docgraph.plans import scratch
from tests.brute import ends, returned_edges

# Name, edges, start, direction, expected edges/nodes at depths 0, 1 and 9.
SHAPES = [
    ("path", [(1, 2), (2, 3), (3, 4)], 1, "uni", [(1, 2), (2, 3), (3, 4)]),
    ("path both ways", [(1, 2), (2, 3), (3, 4)], 2, "bi", [(2, 3), (3, 4), (3, 4)]),
    ("cycle", [(1, 2), (2, 3), (3, 1)], 1, "uni", [(1, 2), (2, 3), (3, 3)]),
    ("self-loop", [(1, 1), (1, 2)], 1, "uni", [(2, 2), (2, 2), (2, 2)]),
    ("self-loop both ways", [(1, 1), (1, 2)], 2, "bi", [(1, 2), (2, 2), (2, 2)]),
    ("parallel", [(1, 2), (1, 2), (2, 3)], 1, "uni", [(2, 2), (3, 3), (3, 3)]),
    ("diamond", [(1, 2), (1, 3), (2, 4), (3, 4)], 1, "uni", [(2, 3), (4, 4), (4, 4)]),
    ("two parts", [(1, 2), (5, 6)], 1, "uni", [(1, 2), (1, 2), (1, 2)]),
    ("sink start", [(1, 2)], 2, "uni", [(0, 0), (0, 0), (0, 0)]),
    ("sink start both ways", [(1, 2)], 2, "bi", [(1, 2), (1, 2), (1, 2)]),
    ("star in", [(2, 1), (3, 1), (4, 1)], 2, "bi", [(1, 2), (3, 4), (3, 4)]),
    ("null end", [(1, None), (None, 2), (1, 2), (None, None)], 1, "uni", [(2, 2), (2, 2), (2, 2)]),
    ("null end both ways", [(1, None), (None, 2), (1, 2)], 1, "bi", [(2, 2), (3, 2), (3, 2)]),
    ("only a null end", [(1, None)], 1, "uni", [(1, 1), (1, 1), (1, 1)]),
]
DEPTHS = [0, 1, 9]
# Shapes are laid side by side in one graph: shape k has its vertices from 100 * k on.
STEP = 100


def _edge_table(spark, edges):
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(edges)], "edge_id long, source long, target long")


def _vertex_table(spark, keys):
    return spark.createDataFrame([(k,) for k in sorted(keys)], "id long")


@pytest.fixture(scope="module")
def shapes(spark):
    edges = [(s and s + STEP * k, t and t + STEP * k) for k, shape in enumerate(SHAPES) for s, t in shape[1]]
    vertices = {k * STEP + v for k in range(len(SHAPES)) for v in range(1, 10)}
    return _vertex_table(spark, vertices), graph.prepare_links(_edge_table(spark, edges)), edges


@pytest.mark.parametrize("direction", ["uni", "bi"])
def test_shapes_by_sweep(shapes, direction):
    vertices, links, _ = shapes
    wanted = {k * STEP + shape[2]: shape for k, shape in enumerate(SHAPES) if shape[3] == direction}
    rows = graph.depth_sweep(vertices, links, list(wanted), DEPTHS, [direction]).collect()
    got = {(r.start, r.max_depth): (r.edge_count, r.node_count) for r in rows}
    expected = {(start, d): shape[4][i] for start, shape in wanted.items() for i, d in enumerate(DEPTHS)}
    assert got == expected


@pytest.mark.parametrize("direction", ["uni", "bi"])
def test_shapes_by_lookup(shapes, direction):
    vertices, links, edges = shapes
    starts = [k * STEP + shape[2] for k, shape in enumerate(SHAPES) if shape[3] == direction]
    flat = graph.graph_lookup(vertices, links, starts, max_depth=1, direction=direction).collect()
    got = {(r.start, r.edge_id, r.depth) for r in flat}
    assert got == {(s, i, d) for s in starts for i, d in returned_edges(edges, [s], 1, direction).items()}
    assert len(flat) == len(got)


def _random_graphs(count, seed):
    rng = random.Random(seed)
    for k in range(count):
        size = rng.randint(2, 7)
        base = k * STEP
        pick = lambda: None if rng.random() < 0.05 else base + rng.randint(1, size)
        yield base, size, [(pick(), pick()) for _ in range(rng.randint(0, 10))]


@pytest.mark.parametrize("split_rows", [None, 3])
def test_random_graphs(spark, split_rows, monkeypatch):
    """Hundreds of small graphs side by side, every vertex a start: dozens of words of flags.

    With ``split_rows`` the vertices of one added hub graph are split into pieces, the lists are in
    several buckets, and frontiers are joined through hash tables.
    """
    if split_rows:
        monkeypatch.setattr(graph, "FEW_ROWS", 0)
        monkeypatch.setattr(scratch, "ROWS_PER_BUCKET", 500)
    graphs = list(_random_graphs(150, 7))
    hub = 150 * STEP
    graphs.append((hub, 9, [(hub + 1, hub + 2 + i % 8) for i in range(400)] + [(hub + 2 + i % 8, hub + 1) for i in range(350)]))
    edges = [e for _, _, part in graphs for e in part]
    vertices = _vertex_table(spark, {b + v for b, n, _ in graphs for v in range(1, n + 1)})
    links = graph.prepare_links(_edge_table(spark, edges), min_split_rows=split_rows)
    assert links.forward.hot.salted == links.reverse.hot.salted == bool(split_rows)
    offsets, n = {}, 0
    for base, _, part in graphs:
        offsets[base] = n
        n += len(part)
    for direction in ("uni", "bi"):
        expected, counts = set(), {}
        for base, size, part in graphs:
            for v in range(1, size + 1):
                for depth in (0, 2, 5):
                    found = returned_edges(part, [base + v], depth, direction)
                    counts[base + v, depth] = (len(found), len(ends(part, found)))
                expected |= {(base + v, offsets[base] + i, d) for i, d in found.items() if d <= 2}
        flat = graph.graph_lookup(vertices, links, max_depth=2, direction=direction)
        rows = [(r.start, r.edge_id, r.depth) for r in flat.select("start", "edge_id", "depth").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expected
        swept = graph.depth_sweep(vertices, links, None, [0, 2, 5], [direction]).collect()
        assert {(r.start, r.max_depth): (r.edge_count, r.node_count) for r in swept} == counts


@pytest.mark.parametrize("direction", ["uni", "bi"])
def test_batch_and_prefixes(spark, direction):
    rng = random.Random(11)
    # Vertex 25 has only an incoming edge, 26 none at all; 70 ranks need two words of flags.
    edges = [(rng.randint(1, 24), rng.randint(1, 24)) for _ in range(30)] + [(3, 25), (None, 4), (5, None)]
    vertices, links = _vertex_table(spark, range(1, 101)), graph.prepare_links(_edge_table(spark, edges))
    starts = [25, 26, *rng.sample(range(1, 25), 6), *range(27, 88), 9]
    found = returned_edges(edges, starts, 1, direction)
    rows = graph.graph_lookup(vertices, links, starts, max_depth=1, direction=direction, batch=True).collect()
    assert sorted((r.edge_id, r.depth) for r in rows) == sorted(found.items())

    ranked = spark.createDataFrame([(s, i + 1) for i, s in enumerate(starts)], "start long, rank int")
    rows = graph.multivalue_sweep(vertices, links, ranked, 2, [direction]).collect()
    expected = {}
    for k in range(1, len(starts) + 1):
        found = returned_edges(edges, starts[:k], 2, direction)
        expected[k] = (len(found), len(ends(edges, found)))
    assert {r.num_start_values: (r.edge_count, r.node_count) for r in rows} == expected


def test_unknown_start_and_empty_report(shapes):
    vertices, links, _ = shapes
    keys = graph.start_keys(vertices, [1, 9, 12345])
    flat = graph.graph_lookup(vertices, links, [1, 9, 12345])
    nested = {r.start: r.reports for r in graph.nest_reports(flat, keys).collect()}
    assert set(nested) == {1, 9} and nested[9] == [] and [e.edge_id for e in nested[1]] == [0]
    assert {r.start: r.edge_count for r in graph.edge_count(flat, keys).collect()} == {1: 1, 9: 0}
    assert {r.start: r.node_count for r in graph.node_count(flat, keys).collect()} == {1: 2, 9: 0}


def test_reports_come_in_pages(spark):
    edges = _edge_table(spark, [(1, t) for t in range(2, 202)] + [(2, 1)])
    vertices = _vertex_table(spark, [1, 2, 3])
    flat = graph.graph_lookup(vertices, edges, max_depth=0)
    pages = graph.nest_reports(flat, graph.start_keys(vertices), page_rows=30).collect()
    of_one = [p for p in pages if p.start == 1]
    assert sorted(p.page for p in of_one) == list(range(7))
    assert sorted(e.target for p in of_one for e in p.reports) == list(range(2, 202))
    assert max(len(p.reports) for p in of_one) <= 60
    assert [(p.page, len(p.reports)) for p in pages if p.start != 1] in ([(0, 1), (0, 0)], [(0, 0), (0, 1)])


def test_text_keys_and_other_field_names(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "sender string, receiver string")
    vertices = spark.createDataFrame([(v,) for v in "abcxy"], "name string")
    flat = graph.graph_lookup(vertices, edges, ["a"], "name", "receiver", "sender", "hops", 1)
    assert sorted(map(tuple, flat.select("start", "sender", "receiver", "hops").collect())) == [
        ("a", "a", "b", 0),
        ("a", "b", "c", 1),
    ]


def test_key_types_may_differ(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3)], "source int, target long")
    flat = graph.graph_lookup(_vertex_table(spark, [1, 2]), edges, [1], max_depth=5)
    assert sorted((r.source, r.target, r.depth) for r in flat.collect()) == [(1, 2, 0), (2, 3, 1)]


def test_bad_arguments(spark, shapes):
    vertices, links, edges = shapes
    with pytest.raises(ValueError, match="direction"):
        graph.graph_lookup(vertices, links, [1], direction="both")
    with pytest.raises(ValueError, match="negative"):
        graph.graph_lookup(vertices, links, [1], max_depth=-1)
    one_way = graph.prepare_links(_edge_table(spark, edges), both_ways=False)
    with pytest.raises(ValueError, match="reverse"):
        graph.graph_lookup(vertices, one_way, [1], direction="bi")


def _exchanges(frame):
    """Per shuffle of the plan, the columns it moves and the number of partitions."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*), (\d+)\)", plan), plan


def test_edge_lists_are_not_shuffled(spark, monkeypatch):
    """Once written, an edge list is joined in its buckets: only the frontier moves, to as many
    partitions as there are buckets, whatever the session's shuffle partitions."""
    monkeypatch.setattr(scratch, "ROWS_PER_BUCKET", 300)
    edges = spark.range(900).selectExpr("id AS edge_id", "id % 50 AS source", "id % 70 AS target")
    links = graph.prepare_links(edges)
    frontier = spark.range(5).selectExpr("id AS node", "0L AS word", "1L AS bits")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, join in ((5, "SortMergeJoin"), (10**6, "ShuffledHashJoin"), (10**9, "SortMergeJoin")):
            moved, plan = _exchanges(links.forward.neighbours(frontier, rows))
            assert [n for _, n in moved] == ["3"] and "Bucketed: true" in plan and join in plan
            assert "neighbour" not in moved[0][0]
        # Edge totals per vertex come from the buckets without any shuffle.
        moved, _ = _exchanges(links.forward.table.groupBy("node").agg(F.sum("n")))
        assert moved == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_reached_rows_are_read_in_the_second_round(spark):
    """The frontier is a partition of the written rounds, not a filter over all of them."""
    links = graph.prepare_links(_edge_table(spark, [(1, 2), (2, 3)]))
    seeds = spark.createDataFrame([(1, 0, 1)], "node long, word long, bits long")
    reached = graph.traverse(links, seeds, "uni", 5)
    assert sorted(map(tuple, reached.collect())) == [(1, 0, 1, 0), (2, 0, 1, 1), (3, 0, 1, 2)]
    plan = reached.filter("dist = 1")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*dist.* = 1", plan)


def test_random_starts(spark):
    vertices = _vertex_table(spark, range(50))
    first = graph.random_starts(vertices, n=5, seed=1).collect()
    assert first == graph.random_starts(vertices.repartition(7), n=5, seed=1).collect()
    assert [r["rank"] for r in first] == [1, 2, 3, 4, 5]
    assert graph.random_starts(vertices, n=5).select("start").distinct().count() == 5


def test_edge_report_parse(spark):
    texts = spark.createDataFrame([("{2020-01-01, 4, 5, 0}",), ("{x, 1,2}",), ("{error}",), ("",), (None,)], "report string")
    rows = graph.edge_report_parse(texts).select("source", "target").collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("4", "5")]


def test_sweep_properties(shapes):
    vertices, links, _ = shapes
    rows = graph.depth_sweep(vertices, links, None, [0, 1, 2, 5]).orderBy("direction", "start", "max_depth").collect()
    for a, b in zip(rows, rows[1:]):
        if (a.direction, a.start) == (b.direction, b.start):
            assert a.edge_count <= b.edge_count and a.node_count <= b.node_count
    by_key = {(r.direction, r.start, r.max_depth): r for r in rows}
    for (direction, start, depth), row in by_key.items():
        assert row.edge_count <= by_key["bi", start, depth].edge_count


def test_degrees_double_the_edges(shapes):
    _, links, edges = shapes
    degrees = degree.degree_distribution(links.edges)
    assert degrees.agg(F.sum("cnt")).first()[0] == sum((s is not None) + (t is not None) for s, t in edges)


def _without_broadcast(spark, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_edges_stay_in_place(spark):
    """The final join of a lookup moves the reached vertices, never the edge rows."""
    edges = spark.range(200_000).selectExpr("id AS edge_id", "id % 1000 AS source", "id % 777 AS target")
    links = graph.prepare_links(edges)
    reached = spark.createDataFrame([(5, 0, 1, 0)], "node long, word long, bits long, dist int")
    plan = _without_broadcast(spark, lambda: links.rows_at(reached))
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert links.rows_at(reached).count() == 200


def test_reached_vertices_stay_in_place(spark):
    """One way, a round moves its candidates; what was reached before is joined where it is, however long the path is."""
    name = "docgraph_test_reached"
    reached = spark.range(400).selectExpr("id AS node", "0L AS word", "1L AS bits", "CAST(id AS INT) AS dist").repartition(4, "node", "word")
    reached.write.format("parquet").bucketBy(4, "node", "word").mode("overwrite").saveAsTable(name)
    sent = spark.createDataFrame([(399, 0, 1), (400, 0, 1), (400, 0, 2), (3, 0, 3)], "node long, word long, bits long")
    try:
        plan = _without_broadcast(spark, lambda: graph._not_reached(sent, spark.table(name), 4))
        seen = plan[plan.index("docgraph_test_reached") - 2000 : plan.index("docgraph_test_reached")]
        assert plan.count("Exchange") == 2 and "SortMergeJoin" in plan and "Bucketed: true" in plan, seen
        fresh = graph._not_reached(sent, spark.table(name), 4)
        assert sorted(map(tuple, fresh.collect())) == [(3, 0, 2), (400, 0, 3)]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_long_path(spark):
    vertices = spark.range(130).toDF("id")
    edges = spark.range(129).selectExpr("id AS edge_id", "id AS source", "id + 1 AS target")
    flat = graph.graph_lookup(vertices, edges, [0], max_depth=60)
    assert sorted((r.edge_id, r.depth) for r in flat.collect()) == [(k, k) for k in range(61)]


def test_running_totals_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(graph, "_RANKS", 4)
    ranks = spark.range(1, 31).selectExpr("CAST(id AS INT) AS rank")
    counts = spark.createDataFrame([(k, k * 10, 1) for k in range(2, 31, 3)], "rank int, n long, nodes long")
    got = {r.num_start_values: (r.edge_count, r.node_count) for r in graph._running_totals(ranks, counts).collect()}
    assert got == {k: (sum(j * 10 for j in range(2, k + 1, 3)), len(range(2, k + 1, 3))) for k in range(1, 31)}


def _files_read(frame):
    """Bytes and number of the files that the scans of bucketed tables open."""
    frame.collect()
    todo, sizes = [frame._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet") and node.relation().bucketSpec().isDefined():
            parts = node.inputRDD().filePartitions()
            sizes += [f.length() for i in range(parts.size()) for f in parts.apply(i).files()]
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(sizes), len(sizes)


def test_few_starts_open_their_buckets_only(spark, monkeypatch):
    monkeypatch.setattr(scratch, "ROWS_PER_BUCKET", 500)
    read = {}
    for size in (2_000, 20_000):
        edges = spark.range(size).selectExpr("id as edge_id", "id % 1000 * 7 as source", "(id * 31 + 1) % 7000 as target").filter("target != source")
        grown = edges if size == 2_000 else edges.withColumn("source", F.col("source") + F.expr("7000 * (edge_id div 2000)"))
        links = graph.prepare_links(grown)
        vertices = grown.select(F.col("source").alias("id")).distinct()
        found = graph.graph_lookup(vertices, links, [7], max_depth=0)
        rows = sorted(r.edge_id for r in found.collect())
        assert rows == sorted(r.edge_id for r in grown.filter("source = 7").collect()) and len(rows) == 2
        read[size] = _files_read(found)
        assert links.forward.buckets >= size // 500 - 1 and read[size][1] == 1
        # As many starts as there are buckets are joined, with the same rows.
        all_starts = graph.graph_lookup(vertices, links, max_depth=0)
        assert all_starts.count() == grown.count() and _files_read(all_starts)[1] > 1
    assert read[20_000][0] < 2 * read[2_000][0]


@pytest.mark.parametrize("kind", ["string", "binary", "smallint", "double"])
def test_named_nodes_of_any_type(spark, monkeypatch, kind):
    monkeypatch.setattr(scratch, "ROWS_PER_BUCKET", 2)
    pairs = [(str(i), str((i * 5 + 1) % 12)) for i in range(12)]
    table = spark.createDataFrame(pairs, "source string, target string")
    table = table.select(F.col("source").cast(kind), F.col("target").cast(kind))
    vertices = table.select(F.col("source").alias("id"))
    start = table.filter(F.col("source") == F.lit("3").cast(kind)).first().source
    found = graph.graph_lookup(vertices, graph.prepare_links(table), [start], max_depth=2, direction="bi")
    assert found.count() == len(returned_edges(pairs, ["3"], 2, "bi"))


def test_combined_candidates_move_once(spark, monkeypatch):
    """With as many buckets as shuffle partitions, the shuffle that combines the candidates is the only one of a one-way round."""
    edges = [(i, (i * 7 + k) % 40) for i in range(40) for k in range(3)]
    plans, own = [], graph._not_reached

    def watched(*given):
        fresh = own(*given)
        plans.append(fresh._jdf.queryExecution().executedPlan().toString())
        return fresh

    monkeypatch.setattr(graph, "_not_reached", watched)
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    counts = {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for partitions in (1, 2, 8):
            plans.clear()
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            links = graph.prepare_links(_edge_table(spark, edges))
            vertices = _vertex_table(spark, range(42))
            counts[partitions] = sorted(map(tuple, graph.lookup_counts(vertices, links, max_depth=2).collect()))
            assert links.forward.buckets == 1 and len(plans) == 3
            # With few buckets beside the shuffle's, the combined candidates move to them.
            shuffles = [len(re.findall(r"Exchange hashpartitioning\(node#\d+L?, word#", plan)) for plan in plans]
            assert max(shuffles) <= (2 if partitions == 8 else 1)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = []
    for start in range(42):
        returned = returned_edges(edges, [start], 2, "uni")
        expected.append((start, len(returned), len(ends(edges, returned))))
    assert counts[1] == counts[2] == counts[8] == expected


@pytest.mark.parametrize("direction", ["uni", "bi"])
def test_counts_alone(shapes, monkeypatch, direction):
    """Either count without the other; edges followed one way need no hop beyond the depth."""
    vertices, links, _ = shapes
    rounds, own = [], graph.traverse
    monkeypatch.setattr(graph, "traverse", lambda *given: rounds.append(given[-1]) or own(*given))
    both = {r.start: r for r in graph.lookup_counts(vertices, links, max_depth=1, direction=direction).collect()}
    for name in graph.COUNTS:
        found = graph.lookup_counts(vertices, links, max_depth=1, direction=direction, counts=[name])
        assert found.columns == ["start", name] and {r.start: r[name] for r in found.collect()} == {s: r[name] for s, r in both.items()}
    assert rounds == ([2, 1, 2] if direction == "uni" else [2, 2, 2])
    with pytest.raises(ValueError, match="counts"):
        graph.lookup_counts(vertices, links, counts=["edges"])


def test_flags_of_one_bit_and_of_several(spark):
    words = [1, 2, 3, 1 << 61, (1 << 62) - 1, (1 << 61) | 1, 1 << 31]
    rows = graph._flag_position(spark.createDataFrame([(w,) for w in words], "bits long"), graph.FLAGS).collect()
    assert sorted((r.bits, r.flag) for r in rows) == sorted((w, i) for w in words for i in range(62) if w >> i & 1)
    single = spark.createDataFrame([(4,)], "bits long")
    assert "bit_count" in graph._flag_position(single, graph.FLAGS)._jdf.queryExecution().analyzed().toString()

"""Graph lookups, degrees and the plain query commands on the derived customer graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph import fixtures
from docgraph.operators import degree, graph, relational
from docgraph.plans.scratch import scratch_path

EDGES_SQL = """select a.o_orderkey as edge_id, a.o_orderdate as "creationDate", a.o_custkey as source, b.o_custkey as target
  from orders a join orders b on b.o_orderkey = a.o_orderkey + 1"""

STARTS_SQL = """select c_custkey as start, row_number() over (order by md5('42:' || c_custkey), c_custkey) as rank
  from customer order by md5('42:' || c_custkey), c_custkey limit 10"""

ALL_STARTS_SQL = "select c_custkey as start from customer"

EDGE_COLUMNS = "edge_id, \"creationDate\", source, target"


def _reach_sql(direction: str, depth: int, starts: str = STARTS_SQL) -> str:
    """CTEs ``e`` (edges), ``st`` (starts), ``d`` (distances) and ``flat`` (returned edges)."""
    both = "union select target, source from e" if direction == "bi" else ""
    other = "union all select d.start, e.*, d.dist from e join d on d.node = e.target" if direction == "bi" else ""
    return f"""with recursive e as ({EDGES_SQL}),
 st as ({starts}),
 adj(a, b) as (select source, target from e {both if both else 'group by all'}),
 r(start, node, dist) as (
   select start, start, 0 from st
   union
   select r.start, adj.b, r.dist + 1 from r join adj on adj.a = r.node where r.dist < {depth}),
 d as (select start, node, min(dist) as dist from r group by start, node),
 flat as (
   select start, {EDGE_COLUMNS}, min(dist) as depth from (
     select d.start, e.*, d.dist from e join d on d.node = e.source {other}) group by all having min(dist) <= {depth})
"""


def _graph(spark: SparkSession, sf_dir: str, n: int = 10):
    vertices, edges = fixtures.vertices(spark, sf_dir), fixtures.edges(spark, sf_dir)
    return vertices, edges, graph.random_starts(vertices, n=n, seed=42)


def _lookup(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    vertices, edges, starts = _graph(spark, sf_dir)
    return graph.graph_lookup(vertices, edges, starts.select("start"), **settings)


def graph_lookup_uni(spark, sf_dir):
    return _lookup(spark, sf_dir, max_depth=3, direction="uni")


def graph_lookup_bi(spark, sf_dir):
    return _lookup(spark, sf_dir, max_depth=3, direction="bi")


def graph_max_depth(spark, sf_dir):
    """The whole reachable graph: the bound lies far beyond the last round."""
    return _lookup(spark, sf_dir, max_depth=50, direction="uni")


def graph_depth_field(spark, sf_dir):
    flat = _lookup(spark, sf_dir, max_depth=50, direction="bi", depth_field="hops")
    return flat.groupBy("start", "hops").agg(F.count(F.lit(1)).alias("edges"), F.sum("edge_id").alias("edge_ids"))


# Pages so short that the test tables have starts with several.
REPORT_ROWS = 5


def graph_reports(spark, sf_dir):
    vertices, edges, starts = _graph(spark, sf_dir)
    flat = graph.graph_lookup(vertices, edges, starts.select("start"), max_depth=1)
    shown = lambda r: F.concat_ws(" ", r["edge_id"], r["source"], r["target"], r["depth"])
    nested = graph.nest_reports(flat, starts, page_rows=REPORT_ROWS)
    return nested.select(
        "start",
        "page",
        F.size("reports").cast("long").alias("edges"),
        F.array_join(F.transform("reports", shown), ", ").alias("reports"),
    )


def graph_multi_start(spark, sf_dir):
    """Every vertex is a start."""
    vertices, edges, _ = _graph(spark, sf_dir)
    return graph.graph_lookup(vertices, edges, max_depth=1)


def graph_batch_mode(spark, sf_dir):
    return _lookup(spark, sf_dir, max_depth=2, direction="bi", batch=True)


def _counts(spark, sf_dir, count: str) -> DataFrame:
    """Every vertex is a start."""
    vertices, edges, _ = _graph(spark, sf_dir)
    return graph.lookup_counts(vertices, edges, max_depth=1, counts=[count])


def graph_edge_count(spark, sf_dir):
    return _counts(spark, sf_dir, "edge_count")


def graph_node_count(spark, sf_dir):
    return _counts(spark, sf_dir, "node_count")


def edge_report_parse(spark, sf_dir):
    """Reports as text; those of even sources come back as an error text that has no fields."""
    report = F.concat(
        F.lit("{"), F.concat_ws(", ", F.date_format("creationDate", "yyyy-MM-dd"), "source", "target", F.lit("0")), F.lit("}")
    )
    texts = fixtures.edges(spark, sf_dir).select(
        "edge_id", F.when(F.col("source") % 2 == 0, "{error}").otherwise(report).alias("report")
    )
    return graph.edge_report_parse(texts)


def random_starts(spark, sf_dir):
    return _graph(spark, sf_dir)[2]


def depth_sweep(spark, sf_dir):
    vertices, edges, starts = _graph(spark, sf_dir)
    return graph.depth_sweep(vertices, edges, starts.select("start"), fixtures.PUBLISHED_DEPTHS)


def multivalue_sweep(spark, sf_dir):
    vertices, edges, starts = _graph(spark, sf_dir)
    return graph.multivalue_sweep(vertices, edges, starts, max_depth=3)


def _sweep_sql(direction: str) -> str:
    depths = ", ".join(f"({d})" for d in fixtures.PUBLISHED_DEPTHS)
    return f"""{_reach_sql(direction, max(fixtures.PUBLISHED_DEPTHS))},
 ends as (select start, depth, source as node from flat union all select start, depth, target from flat)
select st.start, w.max_depth, '{direction}' as direction,
  (select count(*) from flat where flat.start = st.start and flat.depth <= w.max_depth) as edge_count,
  (select count(distinct node) from ends where ends.start = st.start and ends.depth <= w.max_depth) as node_count
from st, (values {depths}) w(max_depth)"""


def _multi_sql(direction: str) -> str:
    return f"""{_reach_sql(direction, 3)},
 k as (select rank as k from st),
 back as (select k.k, flat.* exclude (start, depth) from flat join st using (start) join k on st.rank <= k.k group by all),
 ends as (select k, source as node from back union select k, target from back)
select k.k as num_start_values, 3 as max_depth, '{direction}' as direction,
  (select count(*) from back where back.k = k.k) as edge_count,
  (select count(*) from ends where ends.k = k.k) as node_count
from k"""


def _degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return degree.degree_distribution(fixtures.edges(spark, sf_dir))


DEGREES_SQL = f"""with e as ({EDGES_SQL}),
 deg as (select source, count(*) as cnt from (select source from e union all select target from e) group by source)
"""


def degree_summary(spark, sf_dir):
    return degree.degree_summary(degree.degree_frequencies(_degrees(spark, sf_dir))).withColumn(
        "mean_degree", F.round("mean_degree", 6)
    )


def degree_log_histogram(spark, sf_dir):
    bins = degree.degree_log_histogram(degree.degree_frequencies(_degrees(spark, sf_dir)))
    return bins.withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))


def degree_ccdf(spark, sf_dir):
    return degree.degree_ccdf(degree.degree_frequencies(_degrees(spark, sf_dir))).withColumn("p", F.round("p", 9))


def degrees_json(spark, sf_dir):
    path = scratch_path(spark, "degrees-json")
    degree.degrees_json(_degrees(spark, sf_dir), path)
    return spark.read.schema("cnt long").json(path)


def project_fields(spark, sf_dir):
    return relational.project_fields(fixtures.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_shipdate")


def eval_alias(spark, sf_dir):
    edges = fixtures.edges(spark, sf_dir)
    return relational.project_fields(relational.eval_alias(edges, "source", "target"), "edge_id", "source")


def eval_rand(spark, sf_dir):
    """The numbers differ from run to run; their range does not."""
    drawn = relational.eval_rand(fixtures.vertices(spark, sf_dir).select("id"), "a")
    return drawn.select("id", ((F.col("a") >= 0) & (F.col("a") < 1)).alias("in_range"))


def filter_eq(spark, sf_dir):
    return relational.filter_eq(fixtures.edges(spark, sf_dir), "source", 7)


def filter_in(spark, sf_dir):
    return relational.filter_in(fixtures.edges(spark, sf_dir), "source", [1, 7, 30, 42])


def filter_in_long(spark, sf_dir):
    """A long list, of texts for a field of whole numbers."""
    return relational.filter_in(fixtures.edges(spark, sf_dir), "source", [str(k) for k in range(0, 3000, 2)] + ["none"])


def stats_count_by(spark, sf_dir):
    return relational.stats_count_by(fixtures.edges(spark, sf_dir), "source")


def sort_asc_limit(spark, sf_dir):
    return relational.sort_limit(fixtures.table(spark, sf_dir, "lineitem"), "l_extendedprice", 10, "l_orderkey", "l_linenumber").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


def sort_desc(spark, sf_dir):
    return relational.sort_desc(fixtures.table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey")


def union_all(spark, sf_dir):
    edges = fixtures.edges(spark, sf_dir)
    return relational.union_all(edges.select("source"), edges.select(F.col("target").alias("source")))


def distinct_union(spark, sf_dir):
    return relational.distinct_union(fixtures.edges(spark, sf_dir), "source", "target")


E = f"with e as ({EDGES_SQL}) "

QUERIES = {
    "graph_lookup_uni": (graph_lookup_uni, f"{_reach_sql('uni', 3)} select * from flat"),
    "graph_lookup_bi": (graph_lookup_bi, f"{_reach_sql('bi', 3)} select * from flat"),
    "graph_max_depth": (graph_max_depth, f"{_reach_sql('uni', 50)} select * from flat"),
    "graph_depth_field": (
        graph_depth_field,
        f"{_reach_sql('bi', 50)} select start, depth as hops, count(*) as edges, sum(edge_id)::bigint as edge_ids from flat group by all",
    ),
    "graph_reports": (
        graph_reports,
        f"""{_reach_sql('uni', 1)},
 paged as (select *, ((row_number() over (partition by start order by edge_id) - 1) // {REPORT_ROWS})::integer as page from flat)
 select st.start, coalesce(page, 0) as page, count(paged.start) as edges,
 coalesce(string_agg(edge_id || ' ' || source || ' ' || target || ' ' || depth, ', ' order by edge_id), '') as reports
 from st left join paged using (start) group by st.start, page""",
    ),
    "graph_multi_start": (graph_multi_start, f"{_reach_sql('uni', 1, ALL_STARTS_SQL)} select * from flat"),
    "graph_batch_mode": (
        graph_batch_mode,
        f"{_reach_sql('bi', 2)} select {EDGE_COLUMNS}, min(depth) as depth from flat group by {EDGE_COLUMNS}",
    ),
    "graph_edge_count": (
        graph_edge_count,
        f"""{_reach_sql('uni', 1, ALL_STARTS_SQL)} select st.start, count(flat.start) as edge_count
 from st left join flat using (start) group by st.start""",
    ),
    "graph_node_count": (
        graph_node_count,
        f"""{_reach_sql('uni', 1, ALL_STARTS_SQL)},
 ends as (select start, source as node from flat union select start, target from flat)
 select st.start, count(node) as node_count from st left join ends using (start) group by st.start""",
    ),
    "edge_report_parse": (
        edge_report_parse,
        E
        + """select edge_id, '{' || strftime("creationDate", '%Y-%m-%d') || ', ' || source || ', ' || target || ', 0}' as report,
 source::varchar as source, target::varchar as target from e where source % 2 <> 0""",
    ),
    "random_starts": (random_starts, STARTS_SQL),
    "depth_sweep": (depth_sweep, f"select * from ({_sweep_sql('uni')}) union all select * from ({_sweep_sql('bi')})"),
    "multivalue_sweep": (multivalue_sweep, f"select * from ({_multi_sql('uni')}) union all select * from ({_multi_sql('bi')})"),
    "degree_distribution": (_degrees, f"{DEGREES_SQL} select * from deg"),
    "degree_summary": (
        degree_summary,
        f"""{DEGREES_SQL} select count(*) as vertices, min(cnt) as min_degree, max(cnt) as max_degree,
 round(avg(cnt), 6) as mean_degree, median(cnt)::double as median_degree from deg""",
    ),
    "degree_log_histogram": (
        degree_log_histogram,
        f"""{DEGREES_SQL}, bins as (
 select k::int as bin, pow((select max(cnt) + 1 from deg)::double, k / 49.0::double) as lo,
   pow((select max(cnt) + 1 from deg)::double, (k + 1) / 49.0::double) as hi from range(49) t(k))
select bin, round(lo, 6) as lo, round(hi, 6) as hi,
 (select count(*) from deg where cnt >= lo and cnt < hi) as vertices from bins""",
    ),
    "degree_ccdf": (
        degree_ccdf,
        f"""{DEGREES_SQL}, f as (select cnt as degree, count(*) as n from deg group by cnt)
select degree, round(sum(n) over (order by degree desc) / sum(n) over (), 9)::double as p from f""",
    ),
    "degrees_json": (degrees_json, f"{DEGREES_SQL} select cnt from deg"),
    "project_fields": (project_fields, "select l_orderkey, l_linenumber, l_shipdate from lineitem"),
    "eval_alias": (eval_alias, E + "select edge_id, target as source from e"),
    "eval_rand": (eval_rand, "select c_custkey as id, true as in_range from customer"),
    "filter_eq": (filter_eq, E + "select * from e where source = 7"),
    "filter_in": (filter_in, E + "select * from e where source in (1, 7, 30, 42)"),
    "filter_in_long": (filter_in_long, E + "select * from e where source < 3000 and source % 2 = 0"),
    "stats_count_by": (stats_count_by, E + "select source, count(*) as cnt from e group by source"),
    "sort_asc_limit": (
        sort_asc_limit,
        "select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice, l_orderkey, l_linenumber limit 10",
    ),
    "sort_desc": (sort_desc, "select * from orders order by o_totalprice desc, o_orderkey"),
    "union_all": (union_all, E + "select source from e union all select target from e"),
    "distinct_union": (distinct_union, E + "select source as node from e union select target from e"),
}

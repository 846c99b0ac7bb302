"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs whole, into a sink that discards the rows, twice; the shorter time counts. The
graph tables are written once before the clock starts, as they would be loaded once before any lookup.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph import fixtures
from docgraph.functions.documents import prepare_documents, source_json
from docgraph.operators import degree, graph, runs
from docgraph.plans.imports import import_csv, import_parquet
from docgraph.plans.scratch import scratch_path, write_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DIRECTIONS = ["uni", "bi"]
STARTS = 10


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("docgraph-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    vertices = write_table(fixtures.vertices(spark, SF_DIR).select("id"), "vertices")
    edges = write_table(fixtures.edges(spark, SF_DIR), "edges")
    starts = write_table(graph.random_starts(vertices, n=STARTS, seed=42), "starts")
    keys = starts.select("start")
    links = graph.prepare_links(edges)
    lineitem = fixtures.table(spark, SF_DIR, "lineitem")
    csv_path = scratch_path(spark, "csv")
    lineitem.write.options(header=True, quote='"', escape='"').csv(csv_path)
    root = scratch_path(spark, "index")
    depths = fixtures.PUBLISHED_DEPTHS
    new_index = iter(range(10**6))

    one = write_table(keys.limit(1), "one")

    def lookup(starts=keys, **settings):
        return lambda: drain(graph.graph_lookup(vertices, links, starts, **settings))

    def degrees():
        frequencies = degree.degree_frequencies(degree.degree_distribution(edges))
        drain(degree.degree_summary(frequencies))
        drain(degree.degree_log_histogram(frequencies))
        drain(degree.degree_ccdf(frequencies))

    def load_parquet():
        import_parquet(spark, f"{SF_DIR}/lineitem.parquet", root, f"p{next(new_index)}").stats.collect()

    def upsert_parquet():
        import_parquet(spark, f"{SF_DIR}/orders.parquet", root, "orders", doc_id_column="o_orderkey").stats.collect()

    def load_csv():
        import_csv(spark, csv_path, root, f"c{next(new_index)}", parse_dates=["l_shipdate"]).stats.collect()

    def documents():
        docs = prepare_documents(lineitem, "items", "l_orderkey")
        drain(docs.select("_id", source_json().alias("doc")))

    queries = {
        "prepare_links": lambda: graph.prepare_links(edges),
        "lookup_uni_depth0": lookup(max_depth=0),
        "lookup_uni_depth3": lookup(max_depth=3),
        "lookup_uni_depth50": lookup(max_depth=50),
        "lookup_bi_depth3": lookup(max_depth=3, direction="bi"),
        "lookup_bi_depth50": lookup(max_depth=50, direction="bi"),
        "one_start_uni_depth0": lookup(one, max_depth=0),
        "one_start_uni_depth3": lookup(one, max_depth=3),
        "one_start_bi_depth3": lookup(one, max_depth=3, direction="bi"),
        "depth_sweep": lambda: drain(graph.depth_sweep(vertices, links, keys, depths, DIRECTIONS)),
        "multivalue_sweep": lambda: drain(graph.multivalue_sweep(vertices, links, starts, 3, DIRECTIONS)),
        "degree_statistics": degrees,
        "documents_json": documents,
        "import_parquet": load_parquet,
        "upsert_parquet": upsert_parquet,
        "import_csv": load_csv,
        "run_summary": lambda: drain(runs.run_summary(runs.run_config_median(fixtures.runs(spark, SF_DIR)))),
    }
    seconds = {}
    for name, query in queries.items():
        taken = []
        for _ in range(2):
            start = time.perf_counter()
            query()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)

    single = STARTS * len(depths) * len(DIRECTIONS)
    multiple = STARTS * len(DIRECTIONS)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "edges": edges.agg(F.count(F.lit(1))).first()[0],
                # The sweeps answer this many lookups each; the published figures are per lookup.
                "ms_per_single_value_lookup": round(1000 * seconds["depth_sweep"] / single, 1),
                "ms_per_multi_value_lookup": round(1000 * seconds["multivalue_sweep"] / multiple, 1),
                "documents_per_second": round(lineitem.count() / seconds["import_parquet"]),
            }
        )
    )


if __name__ == "__main__":
    main()

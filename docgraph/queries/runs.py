"""Summaries of the run log that the events table is recast to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph import fixtures
from docgraph.operators import runs
from docgraph.operators.graph import random_starts
from docgraph.plans.scratch import scratch_path

DEPTHS = ", ".join(map(str, fixtures.PUBLISHED_DEPTHS))

RUNS_SQL = f"""with runs as (
 select user_id as start_value, ([{DEPTHS}])[event_id % {len(fixtures.PUBLISHED_DEPTHS)} + 1] as max_depth,
  case when event_id % 2 = 0 then 'uni' else 'bi' end as direction, event_id as run_no,
  case when event_type <> 'error' then value end as latency_ms,
  case when event_type <> 'error' then event_id % 1000 end as edge_count,
  case when event_type <> 'error' then event_id % 100 end as node_count,
  case when event_type = 'error' then 'run ' || event_id || ' failed' end as error
 from events),
 batch as (select start_value % 10 + 1 as num_start_values, * exclude (start_value, max_depth) from runs)
"""


def _medians_sql(name: str, source: str, keys: str) -> str:
    return f""", {name} as (select {keys}, coalesce(median(latency_ms), 0) as median_latency_ms,
 count(latency_ms) as successful_runs, min(run_no) as first_run,
 coalesce(arg_max(edge_count, run_no) filter (latency_ms is not null), 0) as edge_count,
 coalesce(arg_max(node_count, run_no) filter (latency_ms is not null), 0) as node_count,
 arg_max(error, run_no) filter (error is not null) as error
 from {source} group by {keys})
"""


SINGLE_SQL = RUNS_SQL + _medians_sql("medians", "runs", "start_value, max_depth, direction")
BATCH_SQL = RUNS_SQL + _medians_sql("medians", "batch", "num_start_values, direction")

SUMMARY_SQL = """select direction, max_depth, round(avg(median_latency_ms), 6) as avg_latency_ms,
 round(median(median_latency_ms), 6) as median_latency_ms, round(min(median_latency_ms), 6) as min_latency_ms,
 round(max(median_latency_ms), 6) as max_latency_ms, round(avg(edge_count), 6) as avg_edge_count,
 round(avg(node_count), 6) as avg_node_count, count(*) as num_tests from medians group by direction, max_depth"""


LATENCIES = ["avg_latency_ms", "median_latency_ms", "min_latency_ms", "max_latency_ms"]
COUNTS = ["avg_edge_count", "avg_node_count"]


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Means and medians depend on the order of additions in their last bits."""
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def _medians(spark, sf_dir) -> DataFrame:
    return runs.run_config_median(fixtures.runs(spark, sf_dir))


def run_config_median(spark, sf_dir):
    return _rounded(_medians(spark, sf_dir))


def run_batch_median(spark, sf_dir):
    return _rounded(runs.run_batch_median(fixtures.batch_runs(spark, sf_dir)))


# Pages so short that the test tables have groups with several.
PAGE_ROWS = 2


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("all_latencies_ms", F.array_join("all_latencies_ms", " "))


def run_latencies(spark, sf_dir):
    pages = runs.run_latencies(fixtures.batch_runs(spark, sf_dir), runs.BATCH, page_rows=PAGE_ROWS)
    return _as_text(pages).select(*runs.BATCH, "page", "all_latencies_ms")


def run_summary(spark, sf_dir):
    return _rounded(runs.run_summary(_medians(spark, sf_dir)))


def run_summary_multi(spark, sf_dir):
    return _rounded(runs.run_summary_multi(runs.run_batch_median(fixtures.batch_runs(spark, sf_dir))))


def _details(spark, sf_dir) -> DataFrame:
    return runs.run_details(_medians(spark, sf_dir), fixtures.runs(spark, sf_dir), page_rows=PAGE_ROWS)


def run_details(spark, sf_dir):
    return _rounded(_as_text(_details(spark, sf_dir)))


def run_details_batch(spark, sf_dir):
    log = fixtures.batch_runs(spark, sf_dir)
    ranked = random_starts(fixtures.vertices(spark, sf_dir), n=10, seed=42)
    details = runs.run_details(runs.run_batch_median(log), log, runs.BATCH, ranked)
    return _rounded(_as_text(details).withColumn("start_values", F.array_join("start_values", " "))).drop("page")


def summary_table(spark, sf_dir):
    return runs.summary_table(run_summary(spark, sf_dir), ["uni", "bi"], fixtures.PUBLISHED_DEPTHS)


def _report(spark, sf_dir) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "report")
    summary = runs.run_summary(_medians(spark, sf_dir))
    runs.json_report(summary, _details(spark, sf_dir), path, {"depths": fixtures.PUBLISHED_DEPTHS, "directions": ["uni", "bi"], "starts": 10})
    return path, summary


def json_report(spark, sf_dir):
    """The summary, read back from the written report."""
    path, summary = _report(spark, sf_dir)
    values = ", ".join(f"{c}: {t}" for c, t in summary.dtypes if c not in ("direction", "max_depth"))
    written = spark.read.schema(f"direction string, summary map<string, struct<{values}>>").json(f"{path}/summary")
    rows = written.select("direction", F.explode("summary").alias("max_depth", "value"))
    return _rounded(rows.select("direction", F.col("max_depth").cast("int"), "value.*"))


def json_report_details(spark, sf_dir):
    """The details with timestamp (presence only) and settings, read back from the written report."""
    path, _ = _report(spark, sf_dir)
    kinds = "start_value long, max_depth int, direction string, median_latency_ms double, edge_count long, node_count long, error string"
    details = spark.read.schema(f"{kinds}, page int, all_latencies_ms array<double>").json(f"{path}/details")
    head = spark.read.schema("timestamp string, config struct<depths: array<int>, starts: int>").json(f"{path}/benchmark")
    row = head.first()  # the report has one
    details = details.withColumns({"timed": F.lit(bool(row.timestamp)), "starts": F.lit(row.config.starts), "depths": F.lit(len(row.config.depths))})
    return _rounded(_as_text(details))


PAGED_SQL = f"""select {{keys}}, ((row_number() over (partition by {{keys}} order by run_no) - 1) // {PAGE_ROWS})::integer as page, run_no, latency_ms
 from {{source}} where latency_ms is not null"""


def _paged_sql(source: str, keys: str) -> str:
    return f"""select {keys}, page, string_agg(latency_ms::varchar, ' ' order by run_no) as all_latencies_ms
 from ({PAGED_SQL.format(keys=keys, source=source)}) group by {keys}, page"""


DETAILS_SQL = f"""select start_value, max_depth, direction, round(median_latency_ms, 6) as median_latency_ms, edge_count, node_count, error,
 coalesce(page, 0) as page, coalesce(all_latencies_ms, '') as all_latencies_ms
 from medians left join ({_paged_sql('runs', 'start_value, max_depth, direction')}) using (start_value, max_depth, direction)"""

STARTS_SQL = """select c_custkey as start, row_number() over (order by md5('42:' || c_custkey), c_custkey) as rank from customer"""


QUERIES = {
    "run_config_median": (run_config_median, SINGLE_SQL + "select * replace (round(median_latency_ms, 6) as median_latency_ms) from medians"),
    "run_batch_median": (run_batch_median, BATCH_SQL + "select * replace (round(median_latency_ms, 6) as median_latency_ms) from medians"),
    "run_latencies": (run_latencies, RUNS_SQL + _paged_sql("batch", "num_start_values, direction")),
    "run_summary": (run_summary, SINGLE_SQL + SUMMARY_SQL),
    "run_summary_multi": (
        run_summary_multi,
        BATCH_SQL + "select direction, num_start_values, round(median_latency_ms, 6) as median_latency_ms, edge_count, node_count from medians",
    ),
    "run_details": (run_details, SINGLE_SQL + DETAILS_SQL),
    "run_details_batch": (
        run_details_batch,
        BATCH_SQL
        + f"""select num_start_values, direction, round(median_latency_ms, 6) as median_latency_ms, edge_count, node_count, error,
 (select string_agg(start::varchar, ' ' order by rank) from ({STARTS_SQL}) s where s.rank <= num_start_values) as start_values,
 coalesce((select string_agg(latency_ms::varchar, ' ' order by run_no) from batch b where latency_ms is not null
   and b.num_start_values = medians.num_start_values and b.direction = medians.direction), '') as all_latencies_ms from medians""",
    ),
    "summary_table": (
        summary_table,
        f"""select direction, max_depth, {', '.join(f"format('{{:.2f}}', {c})::double as {c}" for c in LATENCIES)},
 {', '.join(f"format('{{:.0f}}', {c})::bigint as {c}" for c in COUNTS)}
 from ({SINGLE_SQL} {SUMMARY_SQL})""",
    ),
    "json_report": (json_report, SINGLE_SQL + SUMMARY_SQL),
    "json_report_details": (
        json_report_details,
        SINGLE_SQL + f"select *, true as timed, 10 as starts, {len(fixtures.PUBLISHED_DEPTHS)} as depths from ({DETAILS_SQL})",
    ),
}

"""Summaries of a log of query runs.

A run has its configuration (start, depth and direction, or number of starts and direction), a run
number, a latency and counts if it succeeded, and an error text if it failed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.plans.groups import collect_pages, with_median

SINGLE = ["start_value", "max_depth", "direction"]
BATCH = ["num_start_values", "direction"]


def _config_median(runs: DataFrame, keys: list[str], order: str) -> DataFrame:
    success = F.when(F.col("latency_ms").isNotNull(), F.col(order))
    found = with_median(
        runs,
        keys,
        "latency_ms",
        F.count("latency_ms").alias("successful_runs"),
        F.coalesce(F.max_by("edge_count", success), F.lit(0)).alias("edge_count"),
        F.coalesce(F.max_by("node_count", success), F.lit(0)).alias("node_count"),
        F.max_by("error", F.when(F.col("error").isNotNull(), F.col(order))).alias("error"),
        F.min(order).alias("first_run"),
    )
    return found.withColumnRenamed("median", "median_latency_ms").fillna(0.0, ["median_latency_ms"])


def run_config_median(runs: DataFrame, order: str = "run_no") -> DataFrame:
    """Per start, depth and direction: median latency over the successful runs (0 if there is none),
    counts of the last successful run, last error."""
    return _config_median(runs, SINGLE, order)


def run_batch_median(runs: DataFrame, order: str = "run_no") -> DataFrame:
    """The same per number of starts and direction."""
    return _config_median(runs, BATCH, order)


def run_latencies(runs: DataFrame, keys: list[str] = SINGLE, order: str = "run_no", page_rows: int = 10_000) -> DataFrame:
    """All latencies of a configuration in run order, in pages of bounded size."""
    done = runs.filter(F.col("latency_ms").isNotNull())
    pages = collect_pages(done, keys, F.struct(order, "latency_ms"), "_runs", page_rows)
    return pages.withColumn("all_latencies_ms", F.transform("_runs", lambda r: r["latency_ms"])).drop("_runs")


def run_summary(medians: DataFrame, exclude_failed: bool = False) -> DataFrame:
    """Per direction and depth over the configurations: latency statistics and mean counts.

    A configuration without a successful run counts with latency 0 unless ``exclude_failed``.
    """
    keys = ["direction", "max_depth"]
    if exclude_failed:
        medians = medians.filter(F.col("successful_runs") > 0)
    found = with_median(
        medians,
        keys,
        "median_latency_ms",
        F.avg("median_latency_ms").alias("avg_latency_ms"),
        F.min("median_latency_ms").alias("min_latency_ms"),
        F.max("median_latency_ms").alias("max_latency_ms"),
        F.avg("edge_count").alias("avg_edge_count"),
        F.avg("node_count").alias("avg_node_count"),
        F.count(F.lit(1)).alias("num_tests"),
    )
    return found.withColumnRenamed("median", "median_latency_ms")


def run_summary_multi(medians: DataFrame, order: str = "first_run") -> DataFrame:
    """Per direction and number of starts: latency and counts of the first record."""
    first = lambda c: F.min_by(c, order).alias(c)
    return medians.groupBy("direction", "num_start_values").agg(
        first("median_latency_ms"), first("edge_count"), first("node_count")
    )


def start_lists(ranked: DataFrame, page_rows: int = 10_000) -> DataFrame:
    """The ranked starts (``start``, ``rank`` from 1) once, for any number of batches that take the first of them: ``page`` and ``starts``,
    structs of rank and start; a page holds ``page_rows`` ranks."""
    page = F.floor((F.col("rank") - 1) / page_rows).cast("int").alias("page")
    return ranked.groupBy(page).agg(F.sort_array(F.collect_list(F.struct("rank", "start"))).alias("starts"))


def batch_starts(batches: DataFrame, lists: DataFrame, page_rows: int = 10_000) -> DataFrame:
    """``num_start_values``, ``page`` and ``start_values``: the first starts of each batch size, as pages of the lists cut at the size."""
    size = F.col("num_start_values")
    last = F.floor((size - 1) / page_rows).cast("int")
    pages = batches.select("num_start_values").distinct().filter(size > 0)
    pages = pages.select("num_start_values", F.explode(F.sequence(F.lit(0), last)).alias("page"))
    within = F.filter("starts", lambda s: s["rank"] <= size)
    return pages.join(lists, "page").select("num_start_values", "page", F.transform(within, lambda s: s["start"]).alias("start_values"))


def run_details(
    medians: DataFrame, runs: DataFrame | None = None, keys: list[str] = SINGLE, ranked: DataFrame | None = None, page_rows: int = 10_000
) -> DataFrame:
    """All records, flat.

    With the log ``runs`` also ``all_latencies_ms`` in run order, with ``ranked`` (``start``, ``rank`` from 1) also ``start_values``, the
    starts of a batch. Both come in pages: a record with more than ``page_rows`` entries has several rows, one without any an empty
    page 0, and the shorter of the two is empty on the pages it lacks.
    """
    shown = [*keys, "median_latency_ms", "edge_count", "node_count", "error"]
    details = medians.select(*shown)
    if runs is None and ranked is None:
        return details
    parts = {}
    if ranked is not None:
        starts = batch_starts(details, start_lists(ranked, page_rows), page_rows)
        parts["start_values"] = details.select(*keys).join(starts, "num_start_values").select(*keys, "page", "start_values")
    if runs is not None:
        parts["all_latencies_ms"] = run_latencies(runs, keys, page_rows=page_rows).select(*keys, "page", "all_latencies_ms")
    pages = functools.reduce(lambda a, b: a.join(b, [*keys, "page"], "full"), parts.values())
    filled = [F.coalesce(c, F.array().cast(part.schema[c].dataType)).alias(c) for c, part in parts.items()]
    return details.join(pages, keys, "left").select(*shown, F.coalesce("page", F.lit(0)).alias("page"), *filled)


def summary_table(summary: DataFrame, directions: Iterable[str], sizes: Iterable[int]) -> DataFrame:
    """The summary rounded for reading, in the configured order of directions and depths (or numbers
    of starts); what is not configured is left out."""
    size = "max_depth" if "max_depth" in summary.columns else "num_start_values"
    latencies = [c for c in summary.columns if c.endswith("_latency_ms")]
    counts = [c for c in summary.columns if c.endswith(("edge_count", "node_count"))]
    place = lambda values, c: F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c))
    return (
        summary.withColumn("_direction", place(directions, "direction"))
        .withColumn("_size", place(sizes, size))
        .filter((F.col("_direction") > 0) & (F.col("_size") > 0))
        .orderBy("_direction", "_size")
        .select(
            "direction",
            size,
            # Formatting rounds the exact value, where round() would first take its decimal text.
            *[F.call_function("format_number", F.col(c), F.lit("0.00")).cast("double").alias(c) for c in latencies],
            *[F.call_function("format_number", F.col(c), F.lit("0")).cast("long").alias(c) for c in counts],
        )
    )


def json_report(summary: DataFrame, details: DataFrame, path: str, config: dict | None = None) -> None:
    """The report of a benchmark as JSON files: timestamp and settings of the benchmark, the summary nested by direction and depth (or
    number of starts), and all details."""
    spark = summary.sparkSession
    size = "max_depth" if "max_depth" in summary.columns else "num_start_values"
    values = F.struct(*[c for c in summary.columns if c not in ("direction", size)])
    entry = F.struct(F.col(size).cast("string").alias("key"), values.alias("value"))
    (
        summary.groupBy("direction")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("summary"))
        .write.mode("overwrite")
        .json(f"{path}/summary")
    )
    details.write.mode("overwrite").json(f"{path}/details")
    settings = [F.lit(value).alias(name) for name, value in (config or {}).items()]
    head = [F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), *[F.struct(*settings).alias("config")] * bool(settings)]
    spark.range(1).select(*head).write.mode("overwrite").json(f"{path}/benchmark")

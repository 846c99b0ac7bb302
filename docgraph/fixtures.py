"""Tables derived from the test tables, in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Traversal depths of the published single-value figures.
PUBLISHED_DEPTHS = [0, 1, 3, 5, 10, 30, 50]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is a vertex."""
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order points to the next one by key: an edge between the two customers."""
    orders = table(spark, sf_dir, "orders")
    following = orders.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("target"))
    return orders.join(following, "o_orderkey").select(
        F.col("o_orderkey").alias("edge_id"),
        F.col("o_orderdate").alias("creationDate"),
        F.col("o_custkey").alias("source"),
        "target",
    )


def seeded_order(column: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events recast as the log of single-value query runs; an error event is a failed run."""
    events = table(spark, sf_dir, "events")
    depth = F.array(*[F.lit(d) for d in PUBLISHED_DEPTHS])
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("user_id").alias("start_value"),
        F.element_at(depth, (F.col("event_id") % len(PUBLISHED_DEPTHS) + 1).cast("int")).alias("max_depth"),
        F.when(F.col("event_id") % 2 == 0, "uni").otherwise("bi").alias("direction"),
        F.col("event_id").alias("run_no"),
        F.when(~failed, F.col("value")).alias("latency_ms"),
        F.when(~failed, F.col("event_id") % 1000).alias("edge_count"),
        F.when(~failed, F.col("event_id") % 100).alias("node_count"),
        F.when(failed, F.concat(F.lit("run "), F.col("event_id").cast("string"), F.lit(" failed"))).alias("error"),
    )


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log for batch queries: the number of start values in place of start and depth."""
    return runs(spark, sf_dir).select(
        (F.col("start_value") % 10 + 1).alias("num_start_values"),
        "direction",
        "run_no",
        "latency_ms",
        "edge_count",
        "node_count",
        "error",
    )

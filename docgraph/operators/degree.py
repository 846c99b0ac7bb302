"""Degree distribution of an edge table, taken as undirected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table


def degree_distribution(edges: DataFrame, to_field: str = "source", from_field: str = "target") -> DataFrame:
    """Degree ``cnt`` of each vertex, highest first.

    A self-loop counts twice, vertices without edges are absent, null ends are dropped.
    """
    ends = edges.select(F.explode(F.array(to_field, from_field)).alias(to_field)).filter(F.col(to_field).isNotNull())
    return ends.groupBy(to_field).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), to_field)


def degree_frequencies(degrees: DataFrame) -> DataFrame:
    """Number of vertices per degree, written once: it has few rows and all statistics read it."""
    counted = degrees.groupBy(F.col("cnt").alias("degree")).agg(F.count(F.lit(1)).alias("vertices"))
    return write_table(counted, "degrees")


def degree_summary(frequencies: DataFrame) -> DataFrame:
    """Vertices, least, greatest, mean and median degree."""
    total = F.sum("vertices")
    return frequencies.agg(
        total.alias("vertices"),
        F.min("degree").alias("min_degree"),
        F.max("degree").alias("max_degree"),
        (F.sum(F.col("degree") * F.col("vertices")) / total).alias("mean_degree"),
        F.percentile("degree", 0.5, F.col("vertices")).alias("median_degree"),
    )


def degree_log_histogram(frequencies: DataFrame, bins: int = 49) -> DataFrame:
    """Vertices per logarithmic bin; the edges are ``(max + 1) ** (k / bins)``."""
    top = frequencies.agg(F.max("degree")).first()[0]
    if top is None:
        return frequencies.selectExpr("0 AS bin", "0D AS lo", "0D AS hi", "vertices").limit(0)
    limits = [float(top + 1) ** (k / bins) for k in range(bins + 1)]
    edges = F.array(*[F.lit(x) for x in limits])
    placed = frequencies.withColumn("bin", F.size(F.filter(edges, lambda x: x <= F.col("degree"))) - 1)
    counted = placed.groupBy("bin").agg(F.sum("vertices").alias("vertices"))
    table = frequencies.sparkSession.createDataFrame(
        [(k, limits[k], limits[k + 1]) for k in range(bins)], "bin int, lo double, hi double"
    )
    return table.join(counted, "bin", "left").fillna(0, ["vertices"])


def degree_ccdf(frequencies: DataFrame) -> DataFrame:
    """P(X >= degree), one row per degree that occurs."""
    # The window runs over one row per degree, not per vertex.
    from_top = Window.orderBy(F.desc("degree")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.sum("vertices").over(from_top) / F.sum("vertices").over(everything)
    return frequencies.select("degree", share.alias("p"))


def degrees_json(degrees: DataFrame, path: str) -> None:
    """The degrees, highest first, as JSON lines in ordered part files."""
    # The vertex as second key keeps a degree that many vertices share from becoming one sort task.
    ties = [c for c in degrees.columns if c != "cnt"]
    degrees.orderBy(F.desc("cnt"), *ties).select("cnt").write.mode("overwrite").json(path)

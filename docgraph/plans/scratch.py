"""Tables written to the shared folder, used to cut lineage between rounds of an iterative job.

Written files survive a lost executor, carry real sizes (so Catalyst can choose broadcast joins on
its own) and can be bucketed, none of which holds for a checkpointed RDD under adaptive execution.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows of a narrow table that one bucket should hold at most (some tens of MB once encoded), and at least while there are
# fewer buckets than shuffle partitions.
ROWS_PER_BUCKET = 1_000_000
LEAST_PER_BUCKET = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, with its file system; every executor must reach it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # Without a scheme it belongs to the default file system, whoever opens it.
    path = spark._jvm.org.apache.hadoop.fs.Path(named)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/docgraph/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application has written; frames that still read it become invalid."""
    remove_path(spark, _own_folder(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads the files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, label: str, told: Column) -> tuple[DataFrame, int]:
    """Write ``df`` once; returns a frame that reads the files, and the aggregate ``told`` of its rows, from the same job."""
    seen = Observation()
    return write_table(df.observe(seen, told.alias("told")), label), seen.get["told"]


def write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` and return its row count, counted by the same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get["rows"]


def write_bucketed(df: DataFrame, keys: list[str], rows: int, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` hash-bucketed and sorted on ``keys``; joins on ``keys`` then leave it in place.

    The number of buckets follows the row count and the parallelism; it is also returned. The table name is only needed while writing: the
    entry is dropped from the catalog at once and the returned frame keeps reading the files.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    parallel = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // LEAST_PER_BUCKET))
    buckets = min(most, max(1, -(-rows // ROWS_PER_BUCKET), parallel))
    # Bucketed tables belong to the session catalog, whatever the default catalog is.
    name = f"spark_catalog.default.docgraph_{label}_{uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", scratch_path(spark, label))
        .saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table, buckets

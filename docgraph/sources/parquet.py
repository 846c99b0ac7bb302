"""Parquet files to tables, with the place of each row where an import needs an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Place of a row: its file's position in the caller's list, its file, and its number there.
POSITION = ["_listed", "_file", "_row"]


def read_parquet(spark: SparkSession, paths: str | list[str], position: bool = False) -> DataFrame:
    """The rows of all listed files, folders and globs; what is listed twice is read twice."""
    frames = []
    for number, path in enumerate([paths] if isinstance(paths, str) else paths):
        rows = spark.read.parquet(path)
        place = [F.lit(number).alias("_listed"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
        frames.append(rows.select("*", *place) if position else rows)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result

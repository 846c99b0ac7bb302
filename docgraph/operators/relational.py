"""The plain query commands: fields, eval, where, stats, sort, head, multisearch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def project_fields(df: DataFrame, *fields: str) -> DataFrame:
    return df.select(*fields)


def eval_alias(df: DataFrame, new: str, old: str) -> DataFrame:
    return df.withColumn(new, F.col(old))


def eval_rand(df: DataFrame, name: str, seed: int | None = None) -> DataFrame:
    """A random number from 0 (included) to 1 (excluded) in each row."""
    return df.withColumn(name, F.rand(seed))


def filter_eq(df: DataFrame, field: str, value) -> DataFrame:
    return df.filter(F.col(field) == F.lit(value))


def filter_in(df: DataFrame, field: str, values: Iterable) -> DataFrame:
    """Rows whose field equals one of the values, however many these are; texts are read as the field's type.

    Null, and a text that the type does not allow, equal nothing.
    """
    values = [v for v in values if v is not None]
    kind = df.schema[field].dataType
    if len({type(v) for v in values}) > 1 and any(isinstance(v, str) for v in values):
        values = [str(v) for v in values]
    spark = df.sparkSession
    given = spark.createDataFrame([(v,) for v in values], ["_value"] if values else StructType([StructField("_value", kind)]))
    if isinstance(given.schema["_value"].dataType, StringType):
        given = given.select(F.col("_value").try_cast(kind).alias("_value"))
    # What the scan can skip by its own statistics; the join decides.
    least, most = given.agg(F.min("_value"), F.max("_value")).first()
    if least is not None:
        df = df.filter((df[field] >= F.lit(least)) & (df[field] <= F.lit(most)))
    return df.join(given, df[field] == given["_value"], "left_semi")


def stats_count_by(df: DataFrame, by: str, as_field: str = "cnt") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(as_field))


def sort_limit(df: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(by, *ties).limit(n)


def sort_desc(df: DataFrame, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *ties)


def union_all(*searches: DataFrame) -> DataFrame:
    result = searches[0]
    for search in searches[1:]:
        result = result.unionByName(search)
    return result


def distinct_union(df: DataFrame, *fields: str, as_field: str = "node") -> DataFrame:
    """The set of all non-null values of several columns."""
    values = df.select(F.explode(F.array(*fields)).alias(as_field))
    return values.filter(F.col(as_field).isNotNull()).distinct()

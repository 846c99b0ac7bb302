"""A look at a table before it is imported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _per_column(df: DataFrame, counts: list, as_field: str) -> DataFrame:
    """One aggregate over the table, turned into a row per column."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("column"), count.alias(as_field)) for name, count in zip(df.columns, counts)]
    )
    return df.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def profile_dtypes(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = [F.count(_quoted(name)) for name in df.columns]
    return _per_column(df, counts, "non_null").withColumn("dtype", types[F.col("column")])


def profile_head(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)


def profile_nulls(df: DataFrame) -> DataFrame:
    """Missing values per column; NaN counts as missing."""

    def missing(field):
        column = _quoted(field.name)
        if isinstance(field.dataType, (DoubleType, FloatType)):
            return F.count_if(column.isNull() | F.isnan(column))
        return F.count_if(column.isNull())

    return _per_column(df, [missing(field) for field in df.schema], "nulls")

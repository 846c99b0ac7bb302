"""Aggregates that need all values of a group, without putting a large group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table


# Entries of a quantile sketch: its ranks are wrong by a share of 1 / SKETCH at most. Half the width of a bracket, as a share of the group.
SKETCH = 10_000
BRACKET = 4 / SKETCH


def _on(keys: list[str], other: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"{other}{key}"))
    return condition


def with_median(df: DataFrame, keys: list[str], value: str, *aggregates: Column) -> DataFrame:
    """``keys``, the ``aggregates``, and the exact ``median`` of the non-null values as a double (mean of the middle two if even; null without values).

    A quantile sketch, merged from the tasks' own, gives each group a bracket that holds the middle. A second pass counts what lies below it, and
    the copies of each value inside, before anything is shuffled; only values inside are ranked. So no group is sorted, whatever its size.
    """
    # The sketch is one of doubles, which may be the same for different values but keep their order; NaN is the largest value.
    near = F.nanvl(F.col(value).cast("double"), F.lit(float("inf")))
    bracket = F.percentile_approx(near, [0.5 - BRACKET, 0.5 + BRACKET], SKETCH).alias("_bracket")
    groups = df.groupBy(*keys).agg(*aggregates, bracket, F.count(value).alias("_total"))
    brackets = groups.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_bracket", "_total")
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), near.alias("_near"))
    inside = values.join(brackets, _on(keys, "_of_")).filter(F.col("_near") <= F.col("_bracket")[1])
    inside = inside.withColumn("_value", F.when(F.col("_near") >= F.col("_bracket")[0], F.col("_value")))
    counted = inside.groupBy(*keys, "_total", "_value").agg(F.count(F.lit(1)).alias("_copies"))
    # Null stands for all values below, and comes first.
    upto = Window.partitionBy(*keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_last", F.sum("_copies").over(upto)).withColumn("_first", F.col("_last") - F.col("_copies") + 1)
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    holds = lambda rank: (F.col("_first") <= rank) & (rank <= F.col("_last"))
    lowest = F.max(F.when(holds(low), F.col("_value"))).cast("double")
    highest = F.max(F.when(holds(high), F.col("_value"))).cast("double")
    # Halved first: the sum of two large values need not fit.
    medians = ranked.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg((lowest / 2 + highest / 2).alias("median"))
    shown = [c for c in groups.columns if c not in ("_bracket", "_total")]
    return groups.join(medians, _on(keys, "_of_"), "left").select(*shown, "median")


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and the exact ``median`` of the groups that have a value."""
    return with_median(df.filter(F.col(value).isNotNull()), keys, value)


def collect_pages(df: DataFrame, keys: list[str], item: Column, as_field: str, page_rows: int) -> DataFrame:
    """The items of each group in their order, as arrays of ``page_rows`` entries (fewer on the last page) numbered by ``page``.

    Items are range-partitioned by group and value, so a large group is spread over many tasks; their ranks come from the counts of the
    pieces before.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = df.select(*keys, item.alias("_item")).repartitionByRange(partitions, *keys, "_item")
    items = write_table(items.withColumn("_piece", F.spark_partition_id()), "pages")
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per group and partition here.
    offsets = items.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_in_piece"))
    offsets = offsets.withColumn("_before", F.coalesce(F.sum("_in_piece").over(earlier), F.lit(0)))
    offsets = offsets.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_piece").alias("_of_piece"), "_before")
    within = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy("_item"))
    ranked = items.join(offsets, _on(keys, "_of_") & (F.col("_piece") == F.col("_of_piece")))
    dealt = ranked.withColumn("page", F.floor((F.col("_before") + within - 1) / page_rows).cast("int"))
    return dealt.groupBy(*keys, "page").agg(F.sort_array(F.collect_list("_item")).alias(as_field))

"""Which rows a classifier may learn from: the folds, and samples of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; rows of fold 2 are held out."""
    return F.crc32(doc_id.cast("string")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def sample_per_class(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class (all, if there are fewer), chosen by a hash of ``doc_id``.

    One count per class and a filter; no row is sorted or moved. The number of rows kept of a class is binomial
    around ``per_class``, so it exceeds that by more than 6 of its square roots with negligible probability.
    """
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    counts = write_table(rows.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_of")), "classes")
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.col("_of")) < per_class
    return rows.join(counts, rows[label] == counts["_class"]).filter(chosen).drop("_class", "_of")

"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with fewer rows than this is never split, however small the table is.
MIN_SPLIT_ROWS = 500_000

SALT = "_salt"


@dataclass
class HotKeys:
    """Keys that hold more than one fair partition share of a table, with the pieces each needs.

    A key is hot only above ``rows / partitions``, so there are fewer hot keys than shuffle
    partitions. That bound is what allows to collect them and to broadcast them.
    """

    rows: int
    splits: list[tuple] = field(default_factory=list)
    key_type: str = "bigint"

    @property
    def salted(self) -> bool:
        return bool(self.splits)

    def _table(self, df: DataFrame, key: str) -> DataFrame:
        table = df.sparkSession.createDataFrame(self.splits, f"_hot {self.key_type}, _pieces int")
        return df.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("_hot")), "left")

    def scatter(self, df: DataFrame, key: str, by: str) -> DataFrame:
        """Give each row of the large side a piece number, from the column ``by``.

        ``by`` should differ between the rows of a hot key, and must be the same whenever a lost
        task is run again: a field of the row or a number that was written with it.
        """
        if not self.salted:
            return df
        piece = F.pmod(F.xxhash64(by), F.col("_pieces").cast("long"))
        return self._table(df, key).withColumn(SALT, F.coalesce(piece, F.lit(0)).cast("int")).drop("_hot", "_pieces")

    def copy(self, df: DataFrame, key: str) -> DataFrame:
        """Repeat each row of the small side once per piece of its key."""
        if not self.salted:
            return df
        pieces = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
        return self._table(df, key).withColumn(SALT, F.explode(pieces)).drop("_hot", "_pieces")

    def keys(self, *names: str) -> list[str]:
        return [*names, SALT] if self.salted else list(names)


def find_hot_keys(df: DataFrame, key: str, min_split_rows: int | None = None, rows: Column | None = None) -> HotKeys:
    """Count rows per key (partial counts before the shuffle) and keep the keys worth splitting.

    ``rows`` is the number of rows that a row stands for, if not 1.
    """
    weight = F.count(F.lit(1)) if rows is None else F.sum(rows)
    counts = df.groupBy(F.col(key).alias("_hot")).agg(weight.alias("_rows"))
    total, top = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    key_type = df.schema[key].dataType.simpleString()
    if not total:
        return HotKeys(0, key_type=key_type)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(MIN_SPLIT_ROWS if min_split_rows is None else min_split_rows, total // partitions)
    if top <= share:
        return HotKeys(total, key_type=key_type)
    hot = counts.filter(F.col("_rows") > share)
    pieces = F.ceil(F.col("_rows") / F.lit(share)).cast("int")
    return HotKeys(total, [tuple(row) for row in hot.select("_hot", pieces).collect()], key_type)


def join_skewed(large: DataFrame, small: DataFrame, key: str, hot: HotKeys, by: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` with the large side's hot keys split into pieces by the column ``by``.

    Both sides name the key ``key``; ``how`` is a join type that keeps rows of the large side:
    inner, left or left_semi.
    """
    keys = hot.keys(key)
    return hot.scatter(large, key, by).join(hot.copy(small, key), keys, how).drop(SALT)

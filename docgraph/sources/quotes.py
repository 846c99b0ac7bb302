"""Records of delimited files whose quoted fields may hold line breaks, read by all cores: a quote-state scan over the lines.

A line break ends a record unless it stands inside quotes, which depends on all lines before. So each line is first told what it does to the
state (``KEEPS``, ``CLOSES``, ``OPENS`` or ``SWAPS`` it), whatever the state is when it begins. Per input split these compose to what the split does to
either state; a prefix scan over the splits of a file, one row each, gives the state each split really begins with. Splits in which no field is ever
open over a line break, the usual case, need nothing else: their lines are records. In the others the state before each line follows from a window over the
split, lines of one record are joined, and a record that crosses splits is put together from its pieces.

A quote that is never closed must not swallow the rest of its file. The last record that begins, if it does not end, is taken for the culprit: from there
on each line is a record of its own, so the reader can reject the culprit and keep what follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table

KEEPS, CLOSES, OPENS, SWAPS = 0, 1, 2, 3

_SPLIT = ["_file", "_split"]


def turn(line: Column, quote: str, opens: str, stays: str) -> Column:
    """What a line does to the state; ``opens`` and ``stays`` are patterns of lines that end inside quotes if they begin outside or inside."""
    out, inside = line.rlike(opens), line.rlike(stays)
    told = F.when(out & inside, OPENS).when(out, SWAPS).when(inside, KEEPS).otherwise(CLOSES)
    return F.when(~F.contains(line, F.lit(quote)), KEEPS).otherwise(told)


def _state_before(rows: DataFrame, window: Window, fixed: Column, flips: Column, start: Column) -> Column:
    """The state (1 inside quotes) before each row: that of the last row with a ``fixed`` outcome, or ``start``, turned by the ``flips`` since."""
    before = F.coalesce(F.sum(flips).over(window), F.lit(0))
    known = F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), F.col("_flips").alias("flips"))), ignorenulls=True).over(window)
    rows = rows.withColumn("_flips", before).withColumn("_known", known)
    since = F.when(F.col("_known").isNotNull(), F.col("_known.state") + F.col("_flips") - F.col("_known.flips"))
    return rows.withColumn("_before", F.coalesce(since, start + F.col("_flips")) % 2).drop("_flips", "_known")


def _earlier(*keys: str, order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def split_states(lines: DataFrame) -> DataFrame:
    """For each split the state it begins (``_start``) and ends with (``_end``), and whether a record of it may cross a line break (``_dirty``)."""
    turning = lines.filter(F.col("_turn") != KEEPS).select(*_SPLIT, "_at", "_turn")
    last = turning.filter(F.col("_turn") != SWAPS).groupBy(*_SPLIT).agg(F.max(F.struct("_at", "_turn")).alias("_last"))
    swaps = turning.filter(F.col("_turn") == SWAPS).join(last, _SPLIT, "left")
    swaps = swaps.filter(F.col("_last").isNull() | (F.col("_at") > F.col("_last._at"))).groupBy(*_SPLIT).agg((F.count(F.lit(1)) % 2).alias("_odd"))
    splits = lines.groupBy(*_SPLIT).agg(F.max(F.col("_turn") >= OPENS).alias("_opens")).join(last, _SPLIT, "left").join(swaps, _SPLIT, "left")
    splits = splits.withColumn("_odd", F.coalesce("_odd", F.lit(0)))
    # One row per split from here on.
    fixed = F.when(F.col("_last").isNotNull(), (F.when(F.col("_last._turn") == OPENS, 1).otherwise(0) + F.col("_odd")) % 2)
    flips = F.when(F.col("_last").isNull(), F.col("_odd")).otherwise(0)
    splits = _state_before(splits, _earlier("_file", order="_split"), fixed, flips, F.lit(0)).withColumnRenamed("_before", "_start")
    end = F.coalesce(fixed, (F.col("_start") + F.col("_odd")) % 2).alias("_end")
    return splits.select(*_SPLIT, "_start", end, (F.col("_opens") | (F.col("_start") == 1)).alias("_dirty"))


def _told(lines: DataFrame, dirty: DataFrame) -> DataFrame:
    """Lines of the dirty splits with the state before them."""
    fixed = F.when(F.col("_turn") == OPENS, 1).when(F.col("_turn") == CLOSES, 0)
    flips = F.when(F.col("_turn") == SWAPS, 1).otherwise(0)
    lines = lines.join(dirty.select(*_SPLIT, "_start"), _SPLIT)
    return _state_before(lines, _earlier(*_SPLIT, order="_at"), fixed, flips, F.col("_start")).drop("_start")


def _begun(lines: DataFrame, culprits: DataFrame) -> DataFrame:
    """Whether each line begins a record (``_begins``), and whether it is all of it (``_whole``)."""
    lines = lines.join(culprits, "_file", "left")
    alone = F.coalesce(F.struct("_split", "_at") >= F.col("_culprit"), F.lit(False))
    after = F.when(F.col("_turn") == KEEPS, F.col("_before")).when(F.col("_turn") == SWAPS, 1 - F.col("_before")).otherwise(F.col("_turn") - CLOSES)
    begins = alone | (F.col("_before") == 0)
    return lines.withColumn("_begins", begins).withColumn("_whole", begins & (alone | (after == 0))).drop("_culprit", "_before", "_turn")


def joined_records(lines: DataFrame) -> DataFrame:
    """Records (``value``, and ``_file``, ``_split``, ``_at`` of their first line) from the lines of files with their ``_turn``.

    ``_at`` rises within a split; ``lines`` is read several times, so it should be a written table.
    """
    splits = write_table(split_states(lines), "splits")
    dirty = splits.filter("_dirty")
    place = [*_SPLIT, "_at"]
    narrow = _told(lines.select(*place, "_turn"), dirty)
    open_files = splits.groupBy("_file").agg(F.max_by("_end", "_split").alias("_end")).filter("_end = 1").select("_file")
    culprits = narrow.filter("_before = 0").join(open_files, "_file").groupBy("_file").agg(F.max(F.struct("_split", "_at")).alias("_culprit"))
    # The record that a split begins in the middle of is the last one that has begun in an earlier split.
    begun = _begun(narrow, culprits).groupBy(*_SPLIT).agg(F.count_if("_begins").alias("_records"))
    last = F.last(F.when(F.col("_records") > 0, F.struct("_split", F.col("_records").alias("record"))), ignorenulls=True)
    owners = begun.select(*_SPLIT, last.over(_earlier("_file", order="_split")).alias("_owner"))

    told = _begun(_told(lines, dirty), culprits)
    upto = Window.partitionBy(*_SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    told = told.withColumn("_record", F.sum(F.col("_begins").cast("long")).over(upto))
    pieces = told.filter(~F.col("_whole")).join(owners, _SPLIT, "left")
    own = F.struct(F.col("_split"), F.col("_record").alias("record"))
    pieces = pieces.select("_file", F.when(F.col("_record") > 0, own).otherwise(F.col("_owner")).alias("_owner"), F.struct("_split", "_at", "value").alias("_piece"))
    records = pieces.groupBy("_file", "_owner").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    text = F.array_join(F.transform("_pieces", lambda p: p["value"]), "\n").alias("value")
    records = records.select(text, "_file", F.col("_pieces")[0]["_split"].alias("_split"), F.col("_pieces")[0]["_at"].alias("_at"))
    clean = lines.join(dirty.select(*_SPLIT), _SPLIT, "left_anti")
    return clean.select("value", *place).union(told.filter("_whole").select("value", *place)).union(records)

"""Membership of timestamps in sets of intervals, both ends included, without a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.schema import SERIES

#: Width of the time bins by which points and intervals meet, in ms: a quarter of a year of candles.
BIN_MS = 90 * 86_400_000


def in_intervals(rows: DataFrame, intervals: DataFrame, keys: list[str] | None = None, bin_ms: int = BIN_MS) -> DataFrame:
    """Rows whose ``ts`` lies in an interval of their key.

    Intervals are cut at the edges of time bins. Within (key, bin) rows and pieces are ordered together, and a row is in an
    interval if the furthest end of the pieces that begin at or before it is not before it: one sort, however many
    intervals there are and however they overlap. Rows come back once each, with their columns; null keys are in none.
    """
    keys = SERIES if keys is None else keys
    bins = F.sequence(F.floor(F.col("start_ts") / bin_ms), F.floor(F.col("end_ts") / bin_ms))
    pieces = intervals.where("start_ts <= end_ts").select(*keys, "start_ts", F.col("end_ts").alias("_end"), F.explode(bins).alias("_bin"))
    marks = pieces.select(*keys, "_bin", F.greatest(F.col("start_ts"), F.col("_bin") * bin_ms).alias("_at"), F.lit(0).alias("_kind"), "_end", F.lit(None).cast(rows.schema).alias("_row"))
    points = rows.dropna(subset=[*keys, "ts"]).select(*keys, F.floor(F.col("ts") / bin_ms).alias("_bin"), F.col("ts").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_end"), F.struct(*rows.columns).alias("_row"))
    order = Window.partitionBy(*keys, "_bin").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    reached = marks.unionByName(points).withColumn("_reach", F.max("_end").over(order))
    return reached.where((F.col("_kind") == 1) & (F.col("_reach") >= F.col("_at"))).select("_row.*")


def near_intervals(rows: DataFrame, intervals: DataFrame, interval_ms: int, keys: list[str] | None = None) -> DataFrame:
    """Rows in intervals widened by two target intervals on either side, as an incremental roll-up reads them."""
    wide = intervals.withColumn("start_ts", F.col("start_ts") - 2 * interval_ms).withColumn("end_ts", F.col("end_ts") + 2 * interval_ms)
    return in_intervals(rows, wide, keys)


def last_at_or_before(rows: DataFrame, slots: DataFrame, keys: list[str] | None = None, value: str = "slot_start", bin_ms: int = BIN_MS) -> DataFrame:
    """As-of join: each row with the last slot start at or before its ``ts``, for slot lists without a grid.

    Slots and rows are ordered together within (key, time bin); a bin without an earlier slot takes the last one of
    the bins before, from the bins' last slots alone.
    """
    keys = SERIES if keys is None else keys
    bin_of = F.floor(F.col("_at") / bin_ms)
    marks = slots.select(*keys, F.col(value).alias("_at"), F.col(value).alias("_slot"), F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema).alias("_row"))
    points = rows.select(*keys, F.col("ts").alias("_at"), F.lit(None).cast("long").alias("_slot"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    both = marks.unionByName(points).withColumn("_bin", bin_of)
    order = Window.partitionBy(*keys, "_bin").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_here", F.max("_slot").over(order))
    ends = both.groupBy(*keys, "_bin").agg(F.max("_slot").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_before", F.max("_last").over(before)).drop("_last")
    return found.where("_kind = 1").join(ends, [*keys, "_bin"]).select("_row.*", F.coalesce("_here", "_before").alias(value))

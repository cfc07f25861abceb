"""Roll-up of candles to longer timeframes, with slots that count from the UTC day or year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.time import period_end, slot_end, slot_start
from candlewright.schema import DAY_MS, KEY, MINUTE_MS, PRICES, SERIES, as_candles
from candlewright.sources.files import written

KEYS = SERIES[:3]


def first_of_key(candles: DataFrame, arrival: Column | None = None) -> DataFrame:
    """One candle for each key: the first by ``arrival``, or without one the smallest, so that reruns agree."""
    order = F.struct(arrival, *PRICES) if arrival is not None else F.struct(*PRICES)
    return candles.groupBy(*KEY).agg(F.min_by(F.struct(*PRICES), order).alias("_c")).select(*KEY, "_c.*")


def rollup(candles: DataFrame, source_minutes: int, target_minutes: int, now_ms: int | None = None, dedup: bool = True, reach_of: DataFrame | None = None) -> DataFrame:
    """Candles of ``target_minutes`` from those of ``source_minutes``.

    A slot has the first open, highest high, lowest low, last close and summed volume of its candles; slots without
    candles do not appear, gaps inside a slot are no matter, and a slot appears only when the source has reached its
    end (and ``now``, if given). The short slot at the end of a day or year ends there. ``reach_of`` has the source's
    timestamps where ``candles`` are only a part of it. ``dedup`` makes the source unique first, for which every candle is
    shuffled; candles of a store are unique already, and without it slots are summed up before the shuffle.
    """
    if target_minutes <= 0 or source_minutes <= 0:
        return as_candles(candles.limit(0))
    source = candles.where(F.col("timeframe_minutes") == source_minutes)
    minutes = F.lit(target_minutes)
    slotted = source.withColumn("_slot", slot_start(F.col("ts"), minutes))
    if dedup:
        # Dealt out by slot once, candles are made unique and rolled up without another shuffle.
        keyed = slotted.repartition(*KEYS, "_slot").groupBy(*KEYS, "_slot", "ts")
        slotted = keyed.agg(F.min_by(F.struct(*PRICES), F.struct(*PRICES)).alias("_c")).select(*KEYS, "_slot", "ts", "_c.*")
    made = slotted.groupBy(*KEYS, "_slot").agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume")
    )
    # Only the last slot of a series can be open; its series' last candle tells.
    stamps = source if reach_of is None else reach_of.where(F.col("timeframe_minutes") == source_minutes)
    reach = stamps.groupBy(*KEYS).agg((F.max("ts") + source_minutes * MINUTE_MS).alias("_reach"))
    if now_ms is not None:
        reach = reach.withColumn("_reach", F.least("_reach", F.lit(now_ms)))
    closed = made.join(reach, KEYS).where(slot_end(F.col("_slot"), minutes) <= F.col("_reach"))
    return as_candles(closed.withColumn("timeframe_minutes", minutes).withColumnRenamed("_slot", "ts"))


def rollup_many(candles: DataFrame, targets: list[tuple[int, int]], now_ms: int | None = None, dedup: bool = True) -> DataFrame:
    """Roll-ups (source, target) in dependency order: a target may be the source of later ones. The results together.

    Each level is a table in the shared folder that the next ones read, so the plan of a level does not hold those of the
    levels above, and each of these is computed once. This runs a job for each level.
    """
    have: dict[int, DataFrame] = {}
    for source, target in layers(targets):
        above = have.get(source)
        have[target], _ = written(rollup(candles if above is None else above, source, target, now_ms, dedup and above is None), f"rollup-{target}")
    made = list(have.values())
    out = made[0] if made else as_candles(candles.limit(0))
    for df in made[1:]:
        out = out.unionByName(df)
    return out


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt to as many tasks as shuffles have, for few rows of which many are made.

    A number that is given stays; without one, Spark merges small partitions and one task would make all.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def layers(targets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(source, target) pairs sorted so that a target comes before what is made from it; cycles raise."""
    made = {t: s for s, t in targets}
    level: dict[int, int] = {}

    def depth(t: int, seen: tuple[int, ...] = ()) -> int:
        if t in seen:
            raise ValueError(f"timeframes {seen} are made from each other")
        if t not in level:
            level[t] = 0 if made[t] not in made else 1 + depth(made[t], (*seen, t))
        return level[t]

    return [(made[t], t) for t in sorted(made, key=lambda t: (depth(t), t))]


def incremental_rollup(candles: DataFrame, source_minutes: int, target_minutes: int, start_ts: int, end_ts: int, now_ms: int | None = None, dedup: bool = True) -> DataFrame:
    """Slots that begin in [start_ts, end_ts], from only the candles that those slots can hold.

    The bounds are literals, so they reach the scan as pushed filters; whether the last slot is closed takes the
    newest timestamp of the source besides, which reads that column alone.
    """
    if end_ts < start_ts:
        return as_candles(candles.limit(0))
    high = end_ts + target_minutes * MINUTE_MS
    part = candles.where((F.col("ts") >= start_ts) & (F.col("ts") < high))
    # A slot that began before start_ts is cut off on the left and goes.
    return rollup(part, source_minutes, target_minutes, now_ms, dedup, reach_of=candles).where(F.col("ts").between(start_ts, end_ts))


def touched_slots(changes: DataFrame, source: DataFrame, built: DataFrame, target_minutes: int) -> DataFrame:
    """(series, start_ts, end_ts): what a target has to be built from anew, of source series of which ``changes`` has intervals.

    ``source`` and ``built`` are watermarks (series, min_ts, max_ts) of both timeframes. All slots that an interval reaches into, and of a series
    with changes the slots that may have been open: from the end of the last one built, or from its first candle.
    """
    minutes = F.lit(target_minutes)

    def end(at: Column) -> Column:
        return slot_end(slot_start(at, minutes), minutes) - 1

    hit = changes.select(*SERIES, slot_start(F.col("start_ts"), minutes).alias("start_ts"), end(F.col("end_ts")).alias("end_ts"))
    done = built.where(F.col("timeframe_minutes") == target_minutes).select(*KEYS, F.col("max_ts").alias("_built"))
    late = source.join(changes.select(*SERIES).distinct(), SERIES).join(done, KEYS, "left")
    late = late.select(*SERIES, F.coalesce(end(F.col("_built")) + 1, slot_start(F.col("min_ts"), minutes)).alias("start_ts"), F.col("max_ts").alias("end_ts"))
    return hit.unionByName(late.where("start_ts <= end_ts"))


def read_bounds(bounds: DataFrame, targets: list[int]) -> DataFrame:
    """(keys, first_ts, end_ts): the source range that holds all slots of several targets between each row's bounds.

    One read of a source serves all that is made from it; rows without a slot to build have no range.
    """
    made = None
    for minutes in targets:
        slots = slot_series(bounds, minutes).select(*KEYS, "slot_start", "slot_end")
        made = slots if made is None else made.unionByName(slots)
    if made is None:
        return bounds.select(*KEYS, F.col("start_ts").alias("first_ts"), F.col("end_ts")).limit(0)
    return made.groupBy(*KEYS).agg(F.min("slot_start").alias("first_ts"), F.max("slot_end").alias("end_ts"))


def slot_series(bounds: DataFrame, minutes: int, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """The columns of ``bounds`` and slot_start, slot_end of every slot closed by ``end``.

    Slots begin with the day or year that holds ``start``. A period's slots are a sequence of the interval; its short
    last slot comes along because the sequence ends before the period does.
    """
    unit, width = F.lit(minutes), minutes * MINUTE_MS
    periods = bounds.where(F.col(start) <= F.col(end))
    if minutes <= 1440:
        first, last = F.col(start) - F.pmod(F.col(start), F.lit(DAY_MS)), F.col(end) - F.pmod(F.col(end), F.lit(DAY_MS))
        periods = periods.withColumn("_p", F.explode(F.sequence(first, last, F.lit(DAY_MS))))
    else:
        years = F.sequence(F.year(F.timestamp_millis(F.col(start))), F.year(F.timestamp_millis(F.col(end))))
        periods = periods.withColumn("_y", F.explode(years)).withColumn("_p", F.unix_millis(F.make_timestamp(F.col("_y"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))).drop("_y")
    slots = spread(periods, *[c for c in KEYS if c in periods.columns], "_p").withColumn("slot_start", F.explode(F.sequence(F.col("_p"), period_end(F.col("_p"), unit) - 1, F.lit(width))))
    slots = slots.withColumn("slot_end", F.least(F.col("slot_start") + width, period_end(F.col("_p"), unit)))
    return slots.where(F.col("slot_end") <= F.col(end)).drop("_p")

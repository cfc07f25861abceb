"""Missing candles: expected timestamps, what is absent of them, and intervals of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions.time import floored
from candlewright.operators.rollup import KEYS, slot_series, spread
from candlewright.schema import MINUTE_MS, SERIES
from candlewright.session import ship

#: Candles of a bucket whose breaks are found together, and bits of a bitmap, as Spark's aggregate makes them.
BUCKET, BITS = 8192, 32_768


def expected(bounds: DataFrame, minutes: int, custom: bool = False) -> DataFrame:
    """(series, ts) of all candles from start_ts to end_ts, both included; custom timeframes go by slots.

    A long range is exploded by blocks first, so that its rows are made by many tasks.
    """
    if custom:
        # A slot counts when it is closed at the end of the candle that begins at end_ts.
        ends = bounds.withColumn("_end", F.col("end_ts") + minutes * MINUTE_MS)
        slots = slot_series(ends.withColumnRenamed("_end", "_until"), minutes, "start_ts", "_until")
        return slots.where("slot_start >= start_ts AND slot_start <= end_ts").select(*KEYS, F.lit(minutes).alias("timeframe_minutes"), F.col("slot_start").alias("ts"))
    step = minutes * MINUTE_MS
    first = F.col("start_ts") - F.pmod(F.col("start_ts"), F.lit(step))
    rows = bounds.where("start_ts <= end_ts").select(*KEYS, first.alias("_lo"), F.col("end_ts").alias("_hi"))
    blocks = rows.withColumn("_b", F.explode(F.sequence("_lo", "_hi", F.lit(step * BUCKET))))
    blocks = spread(blocks, *KEYS, "_b")
    return blocks.select(*KEYS, F.lit(minutes).alias("timeframe_minutes"), F.explode(F.sequence("_b", F.least(F.col("_b") + step * (BUCKET - 1), F.col("_hi")), F.lit(step))).alias("ts"))


def missing(expected_ts: DataFrame, candles: DataFrame) -> DataFrame:
    """Expected timestamps without a candle."""
    return expected_ts.join(candles.select(*SERIES, "ts"), [*SERIES, "ts"], "left_anti")


def missing_intervals(bounds: DataFrame, candles: DataFrame, minutes: int, custom: bool = False) -> DataFrame:
    """(series, start_ts, end_ts, n) without candles between each series' bounds: the scan that ingestion goes by."""
    return merge_intervals(missing(expected(bounds, minutes, custom), candles), minutes)


def merge_intervals(missing_ts: DataFrame, minutes: int) -> DataFrame:
    """(series, start_ts, end_ts, n): runs of timestamps no further apart than the interval, both ends included.

    Runs are found within time buckets. Only the first and last run of a bucket can go on in another one, so a series
    is in one window with at most two runs for each of its buckets, however many it has.
    """
    step = minutes * MINUTE_MS
    rows = missing_ts.withColumn("_bucket", F.col("ts") - F.pmod(F.col("ts"), F.lit(step * BUCKET)))
    bucket = [*SERIES, "_bucket"]
    parts = _islands(rows.withColumn("_s", F.col("ts")).withColumn("_e", F.col("ts")).withColumn("_n", F.lit(1).cast("long")), bucket, step)
    own = Window.partitionBy(*bucket)
    edge = (F.col("_s") == F.min("_s").over(own)) | (F.col("_s") == F.max("_s").over(own))
    return _merged(parts.withColumn("_edge", edge), step)


def _merged(parts: DataFrame, step: int) -> DataFrame:
    """(series, start_ts, end_ts, n) from runs of parts of a series, of which only those marked can go on in another part."""
    whole = _islands(parts.where("_edge"), SERIES, step).unionByName(parts.where("NOT _edge").select(*SERIES, "_s", "_e", "_n"))
    return whole.select(*SERIES, F.col("_s").alias("start_ts"), F.col("_e").alias("end_ts"), F.col("_n").alias("n"))


def _islands(rows: DataFrame, by: list[str], step: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("_s")
    broken = rows.withColumn("_new", (F.col("_s") - F.lag("_e").over(order) > step).cast("int"))
    numbered = broken.withColumn("_i", F.sum(F.coalesce("_new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_i").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("_n")).drop("_i")


def presence(candles: DataFrame, range_bars: int) -> list[Column]:
    """The columns that place a candle in presence bitmaps: its range, the bitmap in it, and its bit there (null off the grid)."""
    width = _step()
    bar = F.floor(F.col("ts") / width)
    within = bar - F.floor(bar / range_bars) * range_bars
    return [F.floor(bar / range_bars).cast("long").alias("range"), F.floor(within / BITS).cast("int").alias("part"), F.when(F.col("ts") % width == 0, (within % BITS).cast("long")).alias("bit")]


def missing_from_bitmaps(bounds: DataFrame, bitmaps: DataFrame, minutes: int, range_bars: int) -> DataFrame:
    """The same as ``missing_intervals`` from bitmaps (series, range, part, bits) of what is there: no candle is read.

    A row for each bitmap's worth of bars between the bounds meets its bitmap, and gives its runs of zeros; only the runs at its ends
    can go on in the next one. Where there is no bitmap there are no candles.
    """
    step, parts = minutes * MINUTE_MS, -(-range_bars // BITS)
    rows = bounds.where("start_ts <= end_ts").select(*KEYS, F.floor(F.col("start_ts") / step).alias("_a"), F.floor(F.col("end_ts") / step).alias("_z"))
    rows = spread(rows.withColumn("range", F.explode(F.sequence(F.floor(F.col("_a") / range_bars), F.floor(F.col("_z") / range_bars)))), *KEYS, "range")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("_from", F.col("range") * range_bars + F.col("part") * BITS)
    rows = rows.withColumn("_lo", F.greatest("_a", "_from")).withColumn("_hi", F.least(F.col("_z"), F.col("_from") + BITS - 1, (F.col("range") + 1) * range_bars - 1)).where("_lo <= _hi")
    rows = rows.withColumn("timeframe_minutes", F.lit(minutes)).select(*SERIES, "range", "part", "_from", "_lo", "_hi")
    met = rows.join(bitmaps.select(*SERIES, "range", "part", "bits"), [*SERIES, "range", "part"], "left").select(*SERIES, "_from", "_lo", "_hi", "bits")
    ship(bounds.sparkSession)

    def zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, last = [], [], []
            for i, (start, lo, hi, bits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_from", "_lo", "_hi", "bits")), strict=True)):
                here = np.zeros(BITS, np.uint8) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
                edge = np.flatnonzero(np.diff(here[lo - start : hi - start + 1], prepend=1, append=1))
                first.append(lo + edge[::2])
                last.append(lo + edge[1::2] - 1)
                row.append(np.full(len(edge) // 2, i))
            if not row:
                continue
            at, a, z = (np.concatenate(x).astype(np.int64) for x in (row, first, last))
            ends = (a == batch.column("_lo").to_numpy()[at]) | (z == batch.column("_hi").to_numpy()[at])
            series = [batch.column(c).take(pa.array(at)) for c in SERIES]
            yield pa.RecordBatch.from_arrays([*series, pa.array(a * step), pa.array(z * step), pa.array(z - a + 1), pa.array(ends)], names=[*SERIES, "_s", "_e", "_n", "_edge"])

    head = ", ".join(f"{c} {met.schema[c].dataType.simpleString()}" for c in SERIES)
    runs = met.mapInArrow(zeros, f"{head}, _s long, _e long, _n long, _edge boolean")
    return _merged(runs, step)


def missing_count(intervals: DataFrame, minutes: int) -> DataFrame:
    """(series, n_missing) of intervals with both ends included; inverted intervals count 0."""
    step = minutes * MINUTE_MS
    n = F.greatest(F.lit(0).cast("long"), F.floor((F.col("end_ts") - F.col("start_ts")) / step) + 1)
    return intervals.groupBy(*SERIES).agg(F.sum(n).cast("long").alias("n_missing"))


def _in_buckets(candles: DataFrame) -> DataFrame:
    """(series, bucket, ts, n, next_ts): distinct timestamps, how often each comes, and the next one of its bucket, by one shuffle."""
    place = [*SERIES, "_bucket"]
    width = F.col("timeframe_minutes").cast("long") * MINUTE_MS * BUCKET
    rows = candles.select(*SERIES, "ts", floored(F.col("ts"), width).alias("_bucket")).repartition(*place)
    per_ts = rows.groupBy(*place, "ts").agg(F.count("*").alias("_n"))
    return per_ts.withColumn("next_ts", F.lead("ts").over(Window.partitionBy(*place).orderBy("ts")))


def _edges(buckets: DataFrame) -> DataFrame:
    """Buckets (series, bucket, first, last, ...) with ``after``: where the series goes on in a later one."""
    return buckets.withColumn("_after", F.lead("_first").over(Window.partitionBy(*SERIES).orderBy("_bucket")))


def breaks(candles: DataFrame) -> DataFrame:
    """(series, ts, next_ts): neighbours further apart than the interval. Repeated timestamps are one.

    Neighbours meet within time buckets; between buckets only the first and last of each do.
    """
    rows = _in_buckets(candles)
    inside = rows.where("next_ts IS NOT NULL").select(*SERIES, "ts", "next_ts")
    edges = _edges(rows.groupBy(*SERIES, "_bucket").agg(F.min("ts").alias("_first"), F.max("ts").alias("_last")))
    both = inside.unionByName(edges.where("_after IS NOT NULL").select(*SERIES, F.col("_last").alias("ts"), F.col("_after").alias("next_ts")))
    return both.where(F.col("next_ts") - F.col("ts") > _step())


def _step() -> Column:
    return F.col("timeframe_minutes").cast("long") * MINUTE_MS


def overview(candles: DataFrame) -> DataFrame:
    """Per series: total, distinct and duplicate candles, first and last, expected, missing and the number of gaps."""
    step = _step()
    buckets = _in_buckets(candles).groupBy(*SERIES, "_bucket").agg(
        F.sum("_n").alias("_total"), F.count("*").alias("_distinct"), F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count_if(F.col("next_ts") - F.col("ts") > step).alias("_gaps")
    )
    apart = F.coalesce((F.col("_after") - F.col("_last") > step).cast("long"), F.lit(0))
    out = _edges(buckets).groupBy(*SERIES).agg(F.sum("_total").alias("total"), F.sum("_distinct").alias("n_distinct"), F.min("_first").alias("min_ts"), F.max("_last").alias("max_ts"), F.sum(F.col("_gaps") + apart).alias("n_gaps"))
    out = out.withColumn("expected", (F.floor((F.col("max_ts") - F.col("min_ts")) / step) + 1).cast("long"))
    return out.select(*SERIES, "total", "n_distinct", (F.col("total") - F.col("n_distinct")).alias("n_dup"), "min_ts", "max_ts", "expected", (F.col("expected") - F.col("n_distinct")).alias("missing"), F.col("n_gaps").cast("long").alias("n_gaps"))


def top_gaps(candles: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` widest gaps of all series, with how many candles each lacks; ties to the earlier one."""
    step = _step()
    gap = F.col("next_ts") - F.col("ts")
    rows = breaks(candles).select(*SERIES, "ts", "next_ts", gap.alias("gap_ms"), (F.floor(gap / step) - 1).cast("long").alias("n_missing"))
    return rows.orderBy(F.desc("gap_ms"), "ts", *SERIES).limit(k)

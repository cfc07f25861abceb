"""Bars of a series by number.

A series may hold a third of all rows, so nothing collects one. Bar numbers come from counts of time buckets: each
bucket is numbered on its own and starts at the count of the buckets before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions.time import floored
from candlewright.schema import MINUTE_MS, SERIES

#: Bars of a bucket at most.
BUCKET_BARS = 8192


def numbered(candles: DataFrame) -> DataFrame:
    """``candles`` with ``bar``: 0, 1, ... by time within each series. Keys must be unique."""
    width = F.col("timeframe_minutes").cast("long") * MINUTE_MS * BUCKET_BARS
    rows = candles.withColumn("_bucket", floored(F.col("ts"), width))
    counts = rows.groupBy(*SERIES, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*SERIES).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy(*SERIES, "_bucket").orderBy("ts")
    rows = rows.withColumn("_own", F.row_number().over(own) - 1).join(counts, [*SERIES, "_bucket"])
    return rows.withColumn("bar", (F.col("_base") + F.col("_own")).cast("long")).drop("_bucket", "_own", "_base")

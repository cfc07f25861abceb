"""Candles from the test tables: ticks that carry a symbol, a time, a price and a quantity."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.time import millis, slot_start
from candlewright.schema import as_candles


def tick_order(at_us: Column, tie: Column) -> Column:
    """One number that orders by time in microseconds, then by a whole number.

    It has a fixed width, so first and last prices aggregate by hashing; a struct would make Spark sort all ticks.
    """
    return at_us.cast("decimal(18,0)") * F.lit(Decimal(10**20)).cast("decimal(21,0)") + tie.cast("decimal(20,0)")


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp without zone, read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def candles_from_ticks(ticks: DataFrame, symbol: Column, ts_ms: Column, price: Column, quantity: Column, order: Column, minutes: int) -> DataFrame:
    """One candle for each symbol and slot that has ticks. ``order`` is a total order of ticks, best one number."""
    rows = ticks.select(symbol.alias("symbol"), ts_ms.alias("_ts"), price.cast("double").alias("_p"), quantity.cast("double").alias("_q"), order.alias("_o"))
    made = rows.groupBy("symbol", slot_start(F.col("_ts"), F.lit(minutes)).alias("ts")).agg(
        F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"), F.min("_p").alias("low"), F.max_by("_p", "_o").alias("close"), F.sum("_q").alias("volume")
    )
    return as_candles(made, timeframe_minutes=minutes)


def event_candles(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return candles_from_ticks(e, F.col("event_type"), millis(F.col("ts")), F.col("value"), F.lit(1), tick_order(micros(F.col("ts")), F.col("event_id")), minutes)


def lineitem_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by the time they ship, then by order, line and part: one number of 13, 12, 2 and 11 digits."""
    e = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order: Column | None = None
    for column, digits, after in ((millis(F.col("l_shipdate")), 13, 25), (F.col("l_orderkey"), 12, 13), (F.col("l_linenumber"), 2, 11), (F.col("l_partkey"), 11, 0)):
        part = column.cast(f"decimal({digits},0)") * F.lit(Decimal(10**after)).cast(f"decimal({after + 1},0)")
        order = part if order is None else order + part
    return candles_from_ticks(e, F.col("l_returnflag"), millis(F.col("l_shipdate")), F.col("l_extendedprice"), F.col("l_quantity"), order, 1440)


def order_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return candles_from_ticks(e, F.col("o_orderstatus"), millis(F.col("o_orderdate")), F.col("o_totalprice"), F.lit(1), tick_order(micros(F.col("o_orderdate")), F.col("o_orderkey")), 1440)

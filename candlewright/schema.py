"""The candle schema. ``ts`` is the slot start in milliseconds since 1970 UTC and always an integer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

SERIES = ["market", "category", "symbol", "timeframe_minutes"]
KEY = [*SERIES, "ts"]
PRICES = ["open", "high", "low", "close", "volume"]
DAY_MS, MINUTE_MS = 86_400_000, 60_000

CANDLES = StructType(
    [StructField(c, StringType()) for c in SERIES[:3]] + [StructField("timeframe_minutes", IntegerType()), StructField("ts", LongType())] + [StructField(c, DoubleType()) for c in PRICES]
)
INTERVALS = StructType([StructField("start_ts", LongType()), StructField("end_ts", LongType())])


def as_candles(df: DataFrame, market: str = "synthetic", category: str = "test", timeframe_minutes: int | None = None) -> DataFrame:
    """``df`` with the columns of a candle in order and type; missing series columns get the given constants."""
    for name, value in (("market", market), ("category", category), ("timeframe_minutes", timeframe_minutes)):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANDLES.fields])

"""Exchange payloads in JSON text as candle rows. What cannot be read gives no rows and no error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.time import normalised
from candlewright.schema import PRICES

FIELDS = ["timestamp", *PRICES]


def _rows(df: DataFrame, values: dict[str, Column], multiplier: int, volume_default: float | None) -> DataFrame:
    number = {k: F.expr("CAST(NULL AS DOUBLE)") if v is None else v.try_cast("double") for k, v in values.items()}
    volume = number["volume"] if volume_default is None else F.when(values["volume"].isNull(), F.lit(volume_default)).otherwise(number["volume"])
    keep = [c for c in df.columns if c not in ("_item", *FIELDS, "ts")]
    made = df.select(*keep, number["timestamp"].cast("long").alias("_ts"), *[number[c].alias(c) for c in PRICES[:4]], volume.alias("volume"))
    whole = made.where(F.col("_ts").isNotNull() & F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull() & F.col("volume").isNotNull())
    return whole.select(*keep, normalised(F.col("_ts"), multiplier).alias("ts"), *PRICES)


def parse_arrays(df: DataFrame, payload: str = "payload", mapping: dict[str, int] | None = None, multiplier: int = 1) -> DataFrame:
    """Rows of ``[[timestamp, open, ...], ...]``, fields by index, numbers also as strings.

    A row that lacks a field or has one that is no number is dropped; timestamps are normalised in every row.
    The other columns of ``df`` stay beside each row.
    """
    mapping = mapping or {k: i for i, k in enumerate(FIELDS)}
    items = F.from_json(F.col(payload), "array<array<string>>")
    rows = df.withColumn("_item", F.explode(items)).drop(payload)
    return _rows(rows, {k: F.get(F.col("_item"), i) for k, i in mapping.items()}, multiplier, None)


def parse_objects(df: DataFrame, payload: str = "payload", path: tuple[str, ...] = ("data", "ohlc"), mapping: dict[str, str] | None = None, multiplier: int = 1) -> DataFrame:
    """Rows of a list of objects under ``path``; a single object counts as a list of one.

    An object that lacks timestamp, open, high, low or close is dropped, one without volume has volume 0.
    """
    mapping = mapping or {k: k for k in FIELDS}
    inner = F.get_json_object(F.col(payload), "$" + "".join(f".{p}" for p in path))
    as_list = F.when(F.substring(F.ltrim(inner), 1, 1) == "[", inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    rows = df.withColumn("_item", F.explode(F.from_json(as_list, "array<map<string,string>>"))).drop(payload)
    return _rows(rows, {k: F.try_element_at(F.col("_item"), F.lit(name)) for k, name in mapping.items()}, multiplier, 0.0)


def parse(df: DataFrame, response_type: str, payload: str = "payload", multiplier: int = 1, path: tuple[str, ...] = ("data", "ohlc")) -> DataFrame:
    """By the exchange's response type; an unknown type raises."""
    if response_type == "array":
        return parse_arrays(df, payload, multiplier=multiplier)
    if response_type == "object":
        return parse_objects(df, payload, path, multiplier=multiplier)
    raise ValueError(f"no payloads of type {response_type!r}")

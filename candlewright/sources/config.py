"""Configuration as small tables: timeframes, symbols and exchanges, with their filters and checks."""

from __future__ import annotations

import json
import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIMEFRAMES = "name string, minutes int, seconds int, hours int, active boolean, active_featured boolean"
CUSTOM = "name string, minutes int, source string, active boolean, active_featured boolean"
SYMBOLS = "market string, category string, symbol string, variants array<string>, market_active boolean, category_active boolean, symbol_active boolean"
EXCHANGES = "name string, active boolean, api_url string, timestamp_format string, timeframe_format string, timestamp_multiplier long, response_type string, position int"

#: The standard timeframes, in minutes.
STANDARD_MINUTES = {"1m": 1, "3m": 3, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "3h": 180, "4h": 240, "6h": 360, "8h": 480, "12h": 720, "1d": 1440}
#: The custom timeframes that come as defaults: minutes and the timeframe they are made from.
CUSTOM_MINUTES = {"11m": (11, "1m"), "22m": (22, "1m"), "45m": (45, "15m"), "90m": (90, "30m"), "3h": (180, "1h"), "6h": (360, "3h"), "8h": (480, "1h"), "2d": (2880, "1d"), "3d": (4320, "1d"), "8d": (11520, "1d")}
KEY_PATTERN = re.compile(r"^\d+[mhdwM]$")


def load_json(path: str) -> dict:
    """A JSON object from a file on the driver; a missing file raises."""
    return json.loads(Path(path).read_text())


def load_config(path: str) -> dict:
    """An object from a JSON or, by its ending, a YAML file on the driver; YAML needs PyYAML."""
    if Path(path).suffix not in (".yaml", ".yml"):
        return load_json(path)
    try:
        import yaml
    except ImportError as e:
        raise ImportError(f"{path}: PyYAML is not installed; use JSON") from e
    return yaml.safe_load(Path(path).read_text()) or {}


def save_json(value: dict, path: str) -> None:
    """Write aside, flush to disk, rename: readers see the old or the new file."""
    handle, aside = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(handle, "w") as out:
        json.dump(value, out, indent=2)
        out.flush()
        os.fsync(out.fileno())
    os.replace(aside, path)


def timeframes(spark: SparkSession, config: dict[str, dict]) -> DataFrame:
    """Standard timeframes from {name: {minutes, seconds, hours, active, active_featured}}; flags default to false."""
    rows = [(k, v.get("minutes"), v.get("seconds"), v.get("hours"), bool(v.get("active")), bool(v.get("active_featured"))) for k, v in config.items()]
    return spark.createDataFrame(rows, TIMEFRAMES)


def custom_timeframes(spark: SparkSession, config: dict) -> DataFrame:
    """Custom timeframes from {enable, custom_intervals: {name: {minutes or hours, source, ...}}}; none unless enabled."""
    items = config.get("custom_intervals", {}).items() if config.get("enable") else ()
    rows = [(k, v.get("minutes", v.get("hours", 0) * 60), v.get("source"), bool(v.get("active")), bool(v.get("active_featured"))) for k, v in items]
    return spark.createDataFrame(rows, CUSTOM)


def symbols(spark: SparkSession, config: dict) -> DataFrame:
    """One row for each symbol of {market: {active, symbols_config: {category: {active, symbols: {name: {...}}}}}}.

    Variants are those that are not switched off, in order.
    """
    rows = []
    for market, m in config.items():
        for category, c in m.get("symbols_config", {}).items():
            for name, s in c.get("symbols", {}).items():
                variants = [v for v, d in s.get("variants", {}).items() if isinstance(d, dict) and d.get("active", True)]
                rows.append((market, category, name, variants, bool(m.get("active")), bool(c.get("active")), bool(s.get("active"))))
    return spark.createDataFrame(rows, SYMBOLS)


def exchanges(spark: SparkSession, config: dict[str, dict]) -> DataFrame:
    rows = [
        (k, bool(v.get("active")), v.get("api_url"), v.get("timestamp_format", "milliseconds"), v.get("timeframe_format", "default"), int(v.get("format", {}).get("timestamp_multiplier", 1)), v.get("format", {}).get("response_type"), i)
        for i, (k, v) in enumerate(config.items())
    ]
    return spark.createDataFrame(rows, EXCHANGES)


def active_symbols(dim: DataFrame) -> DataFrame:
    """A symbol counts where market, category and symbol are active."""
    return dim.where("market_active AND category_active AND symbol_active").select("market", "category", "symbol")


def active_timeframes(dim: DataFrame, featured: bool = True) -> DataFrame:
    """(name, minutes): active ones, and for reading those that are featured too."""
    return dim.where("active AND active_featured" if featured else "active").select("name", "minutes")


def read_timeframes(standard: DataFrame, custom: DataFrame) -> DataFrame:
    """(name, minutes) to read: active and featured of both kinds; of one name in both, the custom one."""
    both = active_timeframes(standard).withColumn("_k", F.lit(0)).unionByName(active_timeframes(custom).withColumn("_k", F.lit(1)))
    return both.groupBy("name").agg(F.max_by("minutes", "_k").alias("minutes"))


def build_tasks(custom: DataFrame, standard: DataFrame, fetched: DataFrame) -> DataFrame:
    """(name, minutes, source) of custom timeframes to build.

    One is skipped where an active standard timeframe of the same name got data (``fetched``: name, has_data).
    """
    covered = active_timeframes(standard, featured=False).join(fetched.where("has_data"), "name").select("name")
    return custom.where("active").select("name", "minutes", "source").join(covered, "name", "left_anti")


def minutes_of(names: DataFrame, standard: DataFrame, custom: DataFrame) -> DataFrame:
    """``names`` (name) with minutes: the standard table's, else the custom one's, else 0."""
    s = standard.select("name", F.col("minutes").alias("_s"))
    c = custom.select("name", F.col("minutes").alias("_c"))
    return names.join(s, "name", "left").join(c, "name", "left").withColumn("minutes", F.coalesce("_s", "_c", F.lit(0))).drop("_s", "_c")


def tried_variants(variants: Column, last_good: Column | None = None) -> Column:
    """Symbol names in the order to try: the last that worked, the active variants, then their other cases, each once."""
    cases = F.flatten(F.transform(variants, lambda v: F.array(F.upper(v), F.lower(v))))
    order = F.concat(variants, cases)
    if last_good is not None:
        order = F.concat(F.filter(F.array(last_good), lambda v: v.isNotNull()), order)
    return F.array_distinct(order)


def chosen_exchange(dim: DataFrame) -> DataFrame:
    """The first active exchange, as configured."""
    return dim.where("active").orderBy("position").limit(1)


def dimension_series(candles: DataFrame, active: DataFrame, frames: DataFrame, start_ts: int | None = None) -> DataFrame:
    """Candles of active symbols in active timeframes, from ``start_ts`` on unless that is None.

    Combinations without candles have no rows. The dimensions are as small as the configuration and are hinted so.
    """
    wanted = candles if start_ts is None else candles.where(F.col("ts") >= start_ts)
    frames = frames.select(F.col("minutes").cast("int").alias("timeframe_minutes")).distinct()
    return wanted.join(active, ["market", "category", "symbol"], "left_semi").join(frames, "timeframe_minutes", "left_semi").select(*candles.columns)


def problems(standard: dict[str, dict], custom: dict[str, dict]) -> list[str]:
    """What is wrong with timeframe configuration; an empty list if nothing is."""
    out = [f"timeframe '{k}': not like 15m, 1h, 3d, 1w or 1M" for k in [*standard, *custom] if not KEY_PATTERN.match(k)]
    out += [f"timeframe '{k}': no minutes" for k, v in standard.items() if "minutes" not in v]
    for k, v in custom.items():
        source = v.get("source")
        if source not in standard:
            out.append(f"custom timeframe '{k}': no source '{source}'")
        elif v.get("minutes", 0) % standard[source].get("minutes", 1):
            out.append(f"custom timeframe '{k}': not a multiple of '{source}'")
    return out

"""Candles and indicators of streams: the same rows as in batch, as far as slots are closed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from candlewright.functions.time import millis, slot_start
from candlewright.operators.indicators import DEFAULT_ENGINES, Engine, Stepper
from candlewright.schema import SERIES, as_candles
from candlewright.session import ship
from candlewright.sources.store import CandleStore


def stream_candles(ticks: DataFrame, symbol: Column, at: Column, price: Column, quantity: Column, order: Column, minutes: int, lateness: str = "0 seconds") -> DataFrame:
    """Candles of a stream of ticks, each once, when it is closed: append mode.

    The watermark goes by slot starts. It trails by one interval and ``lateness``, so a slot leaves the state once a
    tick is that far behind its end; later ticks belong to a backfill. Slots may be of any length, as in batch, and
    ``order`` is a total order of ticks, best one number (``tick_order``).
    """
    ms = millis(at)
    rows = ticks.select(symbol.alias("symbol"), F.timestamp_millis(slot_start(ms, F.lit(minutes))).alias("slot"), price.cast("double").alias("_p"), quantity.cast("double").alias("_q"), order.alias("_o"))
    made = rows.withWatermark("slot", f"{minutes} minutes {lateness}").groupBy("symbol", "slot").agg(
        F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"), F.min("_p").alias("low"), F.max_by("_p", "_o").alias("close"), F.sum("_q").alias("volume")
    )
    return as_candles(made.withColumn("ts", F.unix_millis("slot")), timeframe_minutes=minutes)


def upsert_into(store: CandleStore, after: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: a batch replaces the store's candles of its keys, so a repeated batch does no harm."""

    def write(batch: DataFrame, epoch: int) -> None:
        store.write(batch)
        if after is not None:
            after(batch, epoch)

    return write


def start(df: DataFrame, store: CandleStore, checkpoint: str, every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Run a stream into a store: once over what is there (``every`` None), or again and again."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(upsert_into(store))
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def until_complete(missing_count: Callable[[], int], fill: Callable[[], None], most: int = 20) -> int:
    """Fill gaps until nothing is missing or the number no longer falls; returns what is missing then."""
    left = missing_count()
    for _ in range(most):
        if not left:
            break
        fill()
        now = missing_count()
        if now >= left:
            return now
        left = now
    return left


def live_features(candles: DataFrame, engines: tuple[Engine, ...] = DEFAULT_ENGINES, hold_ms: int = 0) -> DataFrame:
    """(series, ts, late, the engines' sources and columns) of a stream of closed candles.

    The state of a series is that of its engines, a few hundred numbers whatever its age, and the candles that it holds back:
    a candle goes on when its series has one that is ``hold_ms`` newer, so those that come up to that much out of order leave in the
    order of time. One that is no newer than a candle that has left already comes too late for the indicators, which would be
    wrong from there on: it leaves with ``late`` true and without any, for a backfill in batch. Repeated times within what is
    held back are one candle, the last to come. A candle without a finite source after one with one ends the recursive
    averages of its series, as in batch. A task holds what a batch brings of one series: bound it by the source (``maxFilesPerTrigger``).
    """
    ship(candles.sparkSession)
    names = [n for e in engines for n in e.names()]
    sources = list(dict.fromkeys(e.source for e in engines))

    def apply(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, flat, held = (None, None, []) if not state.exists else state.get
        stepper = Stepper(engines, flat)
        waiting = pd.DataFrame(np.array(held, float).reshape(-1, 1 + len(sources))[:, 1:], columns=sources)
        waiting.insert(0, "ts", np.array(held, float).reshape(-1, 1 + len(sources))[:, 0].astype("int64"))
        for part in parts:
            rows = part[["ts", *sources]].astype({"ts": "int64", **dict.fromkeys(sources, "float64")})
            late = rows["ts"] <= done if done is not None else pd.Series(False, index=rows.index)
            if late.any():
                yield frame(key, rows[late], True)
            waiting = pd.concat([waiting, rows[~late]], ignore_index=True).drop_duplicates("ts", keep="last")
        ready = waiting["ts"] <= waiting["ts"].max() - hold_ms
        out = waiting[ready].sort_values("ts")
        if len(out):
            done = int(out["ts"].iloc[-1])
            values = {s: np.where(np.isfinite(out[s]), out[s], np.nan) for s in sources}
            yield frame(key, out, False, stepper.step(values))
        rest = waiting[~ready]
        state.update((done, stepper.flat(), [float(v) for row in rest.itertuples(index=False) for v in row]))

    def frame(key: tuple, rows: pd.DataFrame, late: bool, columns: dict[str, np.ndarray] | None = None) -> pd.DataFrame:
        made = {c: [k] * len(rows) for c, k in zip(SERIES, key, strict=True)} | {"ts": rows["ts"].to_numpy(), "late": late} | {s: rows[s].to_numpy() for s in sources}
        return pd.DataFrame(made | {n: np.full(len(rows), np.nan) if columns is None else columns[n] for n in names})

    out = "market string, category string, symbol string, timeframe_minutes int, ts long, late boolean, " + ", ".join(f"{n} double" for n in [*sources, *names])
    return candles.groupBy(*SERIES).applyInPandasWithState(apply, out, "done long, state array<double>, held array<double>", "append", GroupStateTimeout.NoTimeout)

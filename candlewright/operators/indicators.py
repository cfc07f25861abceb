"""Indicators as columns that follow the candle's own, which stay as they are.

Bars are dealt to buckets of time, once, by (series, bucket), and no bucket sees the bars of another. An engine goes over a run of
bars from a state, which is a few numbers, to the next state. What a long run does to the state of recursive averages is an affine
map, whose coefficients need no state: sums of the bars with falling weights. So every bucket is summed up on its own, as a
few bars at its ends and a map of those between; a pass over the summaries of each series, one row a bucket, composes them into
the state that each bucket begins with; and each bucket then steps from there. Series of one bucket go through the loop
bar by bar, to its last bit; later buckets differ from it by rounding only. Streams step the same engines with the same state.

A bar of a recursive average needs a finite source; bars before the first one are warm-up. After that the first bar without a finite
source ends every recursive average of its series, in whatever bucket later bars lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from candlewright.functions.moving import check_length
from candlewright.functions.runs import run_starts, runs
from candlewright.functions.time import floored
from candlewright.operators.series import BUCKET_BARS, numbered
from candlewright.schema import KEY, MINUTE_MS, PRICES, SERIES
from candlewright.session import ship

#: How many values an average has seen, up to its length, their sum, and the average.
AVERAGE = [0.0, 0.0, 0.0]
#: Stands for a null name of a series.
NO_NAME = "\0"
Columns = dict[str, np.ndarray]


def averaged(values: np.ndarray, length: int, alpha: float, state: list[float]) -> tuple[np.ndarray, list[float]]:
    """The mean of the first ``length`` values, then alpha * x + (1 - alpha) * last; NaN before. Goes on from ``state``."""
    seen, total, y = int(state[0]), state[1], state[2]
    out = np.full(len(values), np.nan)
    rest = values.tolist()
    need = length - seen
    if need > 0:
        for v in rest[:need]:
            total += v
        seen = min(length, seen + len(rest))
        if len(rest) < need:
            return out, [float(seen), total, y]
        y = total / length
        out[need - 1] = y
        rest = rest[need:]
    made, keep = [], 1 - alpha
    for v in rest:
        y = v * alpha + y * keep
        made.append(y)
    out[len(values) - len(made) :] = made
    return out, [float(length), total, y]


def weighted(values: np.ndarray, alpha: float) -> float:
    """What a run of values adds to an average that they find full."""
    return float(values @ (alpha * (1 - alpha) ** np.arange(len(values) - 1, -1, -1)))


def _leapt(state: list[float], alpha: float, n: int, added: float) -> list[float]:
    return [state[0], state[1], (1 - alpha) ** n * state[2] + added]


def rolling(x: np.ndarray, length: int, ring: list[float]) -> tuple[np.ndarray, list[float]]:
    """Windows of ``length`` values that end at each of ``x``, NaN where there are fewer, and the last values for what follows."""
    whole = np.concatenate([np.full(length - 1 - len(ring), np.nan), ring, x])
    return np.lib.stride_tricks.sliding_window_view(whole, length) if len(x) else np.zeros((0, length)), whole[len(whole) - length + 1 :].tolist()


class Engine(Protocol):
    """One kind of indicator over a source column.

    ``run`` makes the columns of a run of bars from a state. ``holes``: bars may be NaN; else runs have only finite bars. After
    ``warm`` bars, ``leap`` takes a state over ``n`` bars that ``mapped`` has summed up, given the one before them. What it leaves open is
    settled by the next ``tail`` bars.
    """

    source: str
    holes: bool

    def names(self) -> list[str]: ...
    def start(self) -> list[float]: ...
    def warm(self) -> int: ...
    def tail(self) -> int: ...
    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]: ...
    def mapped(self, before: float, x: np.ndarray) -> list[float]: ...
    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]: ...


@dataclass(frozen=True)
class EmaFan:
    lengths: tuple[int, ...] = (9, 26, 50, 100, 200)
    source: str = "close"
    holes = False

    def __post_init__(self) -> None:
        for n in self.lengths:
            check_length(n)

    def names(self) -> list[str]:
        return [f"ema_{n}" for n in self.lengths]

    def start(self) -> list[float]:
        return AVERAGE * len(self.lengths)

    def warm(self) -> int:
        return max(self.lengths, default=0)

    def tail(self) -> int:
        return 0

    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]:
        columns, after = {}, []
        for i, n in enumerate(self.lengths):
            columns[f"ema_{n}"], own = averaged(x, n, 2.0 / (n + 1), state[3 * i : 3 * i + 3])
            after += own
        return columns, after

    def mapped(self, before: float, x: np.ndarray) -> list[float]:
        return [weighted(x, 2.0 / (n + 1)) for n in self.lengths]

    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]:
        return [v for i, (k, b) in enumerate(zip(self.lengths, added, strict=True)) for v in _leapt(state[3 * i : 3 * i + 3], 2.0 / (k + 1), n, b)]


@dataclass(frozen=True)
class Rma:
    """Wilder's average."""

    length: int = 14
    source: str = "close"
    holes = False

    def __post_init__(self) -> None:
        check_length(self.length)

    def names(self) -> list[str]:
        return [f"rma_{self.length}"]

    def start(self) -> list[float]:
        return list(AVERAGE)

    def warm(self) -> int:
        return self.length

    def tail(self) -> int:
        return 0

    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]:
        column, after = averaged(x, self.length, 1.0 / self.length, state)
        return {f"rma_{self.length}": column}, after

    def mapped(self, before: float, x: np.ndarray) -> list[float]:
        return [weighted(x, 1.0 / self.length)]

    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]:
        return _leapt(state, 1.0 / self.length, n, added[0])


@dataclass(frozen=True)
class Macd:
    fast: int = 12
    slow: int = 26
    signal: int = 9
    source: str = "close"
    holes = False

    def __post_init__(self) -> None:
        for n in (self.fast, self.slow, self.signal):
            check_length(n)

    def _alphas(self) -> list[float]:
        return [2.0 / (n + 1) for n in (self.fast, self.slow, self.signal)]

    def names(self) -> list[str]:
        return ["macd", "macd_signal", "macd_hist"]

    def start(self) -> list[float]:
        return AVERAGE * 3

    def warm(self) -> int:
        return max(self.fast, self.slow) + self.signal

    def tail(self) -> int:
        return 0

    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]:
        fast, slow, signal = self._alphas()
        a, first = averaged(x, self.fast, fast, state[:3])
        b, second = averaged(x, self.slow, slow, state[3:6])
        macd = a - b
        # The signal has its own warm-up, from the first bar that has a macd.
        begun = int(np.isnan(macd).sum())
        line, third = averaged(macd[begun:], self.signal, signal, state[6:])
        line = np.concatenate([np.full(begun, np.nan), line])
        return {"macd": macd, "macd_signal": line, "macd_hist": macd - line}, first + second + third

    def mapped(self, before: float, x: np.ndarray) -> list[float]:
        """What the bars add to each average. The signal of an average is the bars weighed by both one after the other."""
        fast, slow, signal = self._alphas()
        ages = np.arange(len(x) - 1, -1, -1)
        both = [signal * a * _series(1 - signal, 1 - a, ages + 1) for a in (fast, slow)]
        return [weighted(x, fast), weighted(x, slow), float(x @ (both[0] - both[1]))]

    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]:
        fast, slow, signal = self._alphas()
        old = [signal * (1 - a) * float(_series(1 - signal, 1 - a, np.array([n]))[0]) * state[i] for a, i in ((fast, 2), (slow, 5))]
        return _leapt(state[:3], fast, n, added[0]) + _leapt(state[3:6], slow, n, added[1]) + _leapt(state[6:], signal, n, added[2] + old[0] - old[1])


def _series(p: float, q: float, n: np.ndarray) -> np.ndarray:
    """The sum of p^(n-1-i) * q^i for i from 0 to n - 1."""
    return n * p ** np.maximum(n - 1.0, 0) if p == q else (p**n - q**n) / (p - q)


@dataclass(frozen=True)
class Rsi:
    """100 where nothing fell, flat series included; 0 where nothing rose; with a moving mean of it."""

    length: int = 14
    ma_length: int = 14
    source: str = "close"
    holes = False

    def __post_init__(self) -> None:
        for n in (self.length, self.ma_length):
            check_length(n)

    def names(self) -> list[str]:
        return [f"rsi_{self.length}", f"rsi_ma_{self.ma_length}"]

    def start(self) -> list[float]:
        """The last bar, both averages, and the last values for the mean."""
        return [np.nan, *AVERAGE, *AVERAGE, *[np.nan] * (self.ma_length - 1)]

    def warm(self) -> int:
        return self.length + 1

    def tail(self) -> int:
        return self.ma_length - 1

    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]:
        delta = np.diff(x, prepend=state[0])
        # The first bar has no change; as a number it would let the averages begin one bar early.
        begun = int(np.isnan(delta[:1]).sum())
        up, first = averaged(np.maximum(delta[begun:], 0.0), self.length, 1.0 / self.length, state[1:4])
        down, second = averaged(np.maximum(-delta[begun:], 0.0), self.length, 1.0 / self.length, state[4:7])
        with np.errstate(divide="ignore", invalid="ignore"):
            rsi = np.where(down == 0, 100.0, np.where(up == 0, 0.0, 100.0 - 100.0 / (1.0 + up / down)))
        rsi[np.isnan(up)] = np.nan
        rsi = np.concatenate([np.full(begun, np.nan), rsi])
        windows, ring = rolling(rsi, self.ma_length, state[7:])
        return {f"rsi_{self.length}": rsi, f"rsi_ma_{self.ma_length}": windows.mean(axis=1)}, [float(x[-1]) if len(x) else state[0], *first, *second, *ring]

    def mapped(self, before: float, x: np.ndarray) -> list[float]:
        delta = np.diff(x, prepend=before)
        return [weighted(np.maximum(d, 0.0), 1.0 / self.length) for d in (delta, -delta)]

    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]:
        alpha = 1.0 / self.length
        return [last, *_leapt(state[1:4], alpha, n, added[0]), *_leapt(state[4:7], alpha, n, added[1]), *[np.nan] * (self.ma_length - 1)]


@dataclass(frozen=True)
class Bollinger:
    length: int = 20
    mult: float = 2.0
    source: str = "close"
    holes = True

    def __post_init__(self) -> None:
        check_length(self.length)

    def names(self) -> list[str]:
        return ["bb_basis", "bb_upper", "bb_lower"]

    def start(self) -> list[float]:
        return [np.nan] * (self.length - 1)

    def warm(self) -> int:
        return 0

    def tail(self) -> int:
        return self.length - 1

    def run(self, x: np.ndarray, state: list[float]) -> tuple[Columns, list[float]]:
        windows, ring = rolling(x, self.length, state)
        mean, wide = windows.mean(axis=1), windows.std(axis=1) * self.mult
        return {"bb_basis": mean, "bb_upper": mean + wide, "bb_lower": mean - wide}, ring

    def mapped(self, before: float, x: np.ndarray) -> list[float]:
        return []

    def leap(self, state: list[float], n: int, last: float, added: list[float]) -> list[float]:
        return self.start()


DEFAULT_ENGINES: tuple[Engine, ...] = (EmaFan(), Macd(), Rsi(), Bollinger())


@dataclass(frozen=True)
class Run:
    """The bars of one source of a bucket: how many come before the first finite one, the finite ones from there on, and whether others follow."""

    lead: int
    x: np.ndarray
    ends: bool

    @staticmethod
    def of(x: np.ndarray) -> Run:
        bad = np.flatnonzero(np.isnan(x))
        good = np.flatnonzero(~np.isnan(x))
        lead = int(good[0]) if len(good) else len(x)
        after = bad[np.searchsorted(bad, lead) :]
        return Run(lead, x[lead : after[0]] if len(after) else x[lead:], bool(len(after)))


class Stepper:
    """The states of several engines over one series. ``begun`` and ``broken`` tell, by source, of finite bars and of holes after them."""

    def __init__(self, engines: tuple[Engine, ...], flat: list[float] | None = None) -> None:
        self.engines = engines
        self.sources = tuple(dict.fromkeys(e.source for e in engines))
        self.begun, self.broken = dict.fromkeys(self.sources, False), dict.fromkeys(self.sources, False)
        self.states = [e.start() for e in engines]
        at = 0
        if flat is not None:
            for s in self.sources:
                self.begun[s], self.broken[s] = flat[at] > 0, flat[at + 1] > 0
                at += 2
            for i, state in enumerate(self.states):
                self.states[i] = list(flat[at : at + len(state)])
                at += len(state)

    def flat(self) -> list[float]:
        return [float(v) for s in self.sources for v in (self.begun[s], self.broken[s])] + [float(v) for state in self.states for v in state]

    def _recursive(self, source: str) -> list[int]:
        return [i for i, e in enumerate(self.engines) if e.source == source and not e.holes]

    def _open(self, source: str, run: Run) -> bool:
        """Whether the run's bars count; a series that has begun ends at a bar without a value."""
        self.broken[source] |= self.begun[source] and run.lead > 0
        return not self.broken[source] and len(run.x) > 0

    def _close(self, source: str, run: Run) -> None:
        self.begun[source] |= len(run.x) > 0
        self.broken[source] |= run.ends and self.begun[source]

    def step(self, values: dict[str, np.ndarray]) -> Columns:
        """The columns of a run of bars; ``values`` has the sources, NaN for what is not finite."""
        columns: Columns = {}
        for source, x in values.items():
            run = Run.of(x)
            counts = self._open(source, run)
            for i, e in enumerate(self.engines):
                if e.source != source:
                    continue
                if e.holes:
                    made, self.states[i] = e.run(x, self.states[i])
                elif counts:
                    own, self.states[i] = e.run(run.x, self.states[i])
                    made = {n: np.concatenate([np.full(run.lead, np.nan), c, np.full(len(x) - run.lead - len(c), np.nan)]) for n, c in own.items()}
                else:
                    made = {n: np.full(len(x), np.nan) for n in e.names()}
                columns |= made
            if len(x):
                self._close(source, run)
        return columns

    def summary(self, values: dict[str, np.ndarray]) -> list[float]:
        """A bucket's bars in numbers that any state can be taken over."""
        out: list[float] = []
        for source in self.sources:
            x, own = values[source], [self.engines[i] for i in self._recursive(source)]
            raw = x[max(0, len(x) - max((e.tail() for e in self.engines if e.source == source and e.holes), default=0)) :]
            run = Run.of(x)
            head, tail = max((e.warm() for e in own), default=0), max((e.tail() for e in own), default=0)
            n = len(run.x) - head - tail
            if not own:
                lead, tailed, maps, n = np.zeros(0), np.zeros(0), [], 0
            elif n <= 0:
                lead, tailed, maps, n = run.x, np.zeros(0), [], 0
            else:
                between = run.x[head : head + n]
                lead, tailed, maps = run.x[:head], run.x[head + n :], [between[-1], *(v for e in own for v in e.mapped(run.x[head - 1], between))]
            out += [len(x), run.lead, len(run.x), run.ends, n, *(v for part in (maps, lead, tailed, raw) for v in (len(part), *part))]
        return [float(v) for v in out]

    def take(self, summary: list[float]) -> None:
        """Go over a bucket by its summary."""
        at = 0

        def part() -> np.ndarray:
            nonlocal at
            n = int(summary[at])
            at += n + 1
            return np.array(summary[at - n : at])

        for source in self.sources:
            many, lead, length, ends, n = (int(v) for v in summary[at : at + 5])
            at += 5
            maps, head, tail, raw = part(), part(), part(), part()
            run = Run(lead, np.zeros(length), bool(ends))
            if self._open(source, run):
                used = 1
                for i in self._recursive(source):
                    e = self.engines[i]
                    _, state = e.run(head, self.states[i])
                    if n:
                        more = len(e.mapped(0.0, np.zeros(1)))
                        state = e.leap(state, n, float(maps[0]), maps[used : used + more].tolist())
                        used += more
                        _, state = e.run(tail, state)
                    self.states[i] = state
            for i, e in enumerate(self.engines):
                if e.source == source and e.holes:
                    _, self.states[i] = e.run(raw, self.states[i])
            if many:
                self._close(source, run)


def feature_names(engines: tuple[Engine, ...] = DEFAULT_ENGINES) -> list[str]:
    names = [*PRICES, *(n for e in engines for n in e.names())]
    if len(set(names)) < len(names):
        raise ValueError(f"column names repeat: {names}")
    return names


def engines_of(config: dict) -> tuple[Engine, ...]:
    """Engines from a dict with any of ema (list), macd, rsi, bbands (dicts of parameters), each with its source."""
    made: list[Engine] = []
    if "ema" in config:
        e = config["ema"]
        made.append(EmaFan(tuple(e["lengths"]), e.get("source", "close")) if isinstance(e, dict) else EmaFan(tuple(e)))
    for key, kind in (("macd", Macd), ("rsi", Rsi), ("bbands", Bollinger)):
        if key in config:
            made.append(kind(**config[key]))
    return tuple(made)


def with_features(candles: DataFrame, engines: tuple[Engine, ...] = DEFAULT_ENGINES, dtype: str = "double", chunk: int = BUCKET_BARS) -> DataFrame:
    """The candles with every engine's columns, null in warm-up. ``float`` narrows the result, never the computation.

    Keys must be unique. Buckets span ``chunk`` bars. All bars are shuffled once; beside them go a row for each bucket.
    """
    names = feature_names(engines)[len(PRICES) :]
    if not names:
        return candles.select(*KEY, *PRICES)
    ship(candles.sparkSession)
    place = [*SERIES, "_bucket"]
    width = F.col("timeframe_minutes").cast("long") * MINUTE_MS * chunk
    # Names are never null here: keys that may be null would need another shuffle to be joined.
    named = [F.coalesce(c, F.lit(NO_NAME)).alias(c) for c in SERIES[:3]]
    rows = candles.select(*named, *KEY[3:], *PRICES, floored(F.col("ts"), width).alias("_bucket")).repartition(*place)
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*place).schema)
    summed = rows.sortWithinPartitions(*place, "ts").mapInArrow(_summaries(engines, place), f"{head}, _first long, _sum array<double>")
    # One row a bucket, in order; a task holds one of them and the state.
    begins = summed.repartition(*SERIES).sortWithinPartitions(*place).mapInArrow(_states(engines), f"{head}, _first long, _state array<double>")
    begins = begins.select(*[F.col(c).alias(f"_b{c}") for c in place], "_first", "_state")
    # The state comes to the first bar of its bucket alone.
    on = F.col("ts") <= F.col("_first")
    for c in place:
        on = on & (F.col(c) == F.col(f"_b{c}"))
    met = rows.join(begins, on, "left").select(*rows.columns, "_state").sortWithinPartitions(*place, "ts")
    schema = StructType([*rows.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    made = met.mapInArrow(_columns(engines, place, names), schema)
    named = [F.nullif(F.col(c), F.lit(NO_NAME)).alias(c) for c in SERIES[:3]]
    return made.select(*named, *KEY[3:], *PRICES, *[F.col(n).cast(dtype).alias(n) for n in names])


def _sources(engines: tuple[Engine, ...], table: pa.Table) -> Columns:
    """The engines' source columns, NaN for what is not finite."""
    out = {}
    for source in dict.fromkeys(e.source for e in engines):
        x = table.column(source).to_numpy().astype(float)
        out[source] = np.where(np.isfinite(x), x, np.nan)
    return out


def _lists(values: list[list[float] | None]) -> pa.Array:
    return pa.array(values, pa.list_(pa.float64()))


def _summaries(engines: tuple[Engine, ...], place: list[str]):
    """A row for each bucket of sorted bars: its place, its first time and its summary."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stepper = Stepper(engines)
        for table in runs(batches, place):
            bounds = run_starts(table, place)
            values = _sources(engines, table)
            made = [stepper.summary({s: x[lo:hi] for s, x in values.items()}) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
            first = table.take(pa.array(bounds[:-1])).combine_chunks()
            yield from pa.table([*(first.column(c) for c in place), first.column("ts"), _lists(made)], names=[*place, "_first", "_sum"]).to_batches()

    return apply


def _states(engines: tuple[Engine, ...]):
    """The state that each bucket but the first of a series begins with, from sorted summaries."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stepper = None, Stepper(engines)
        for batch in batches:
            made = []
            for *series, summary in zip(*(batch.column(c).to_pylist() for c in [*SERIES, "_sum"]), strict=True):
                if series != key:
                    key, stepper = series, Stepper(engines)
                    made.append(None)
                else:
                    made.append(stepper.flat())
                stepper.take(summary)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(made)], names=[*batch.schema.names[:-1], "_state"])

    return apply


def _columns(engines: tuple[Engine, ...], place: list[str], names: list[str]):
    """The Arrow function that adds the columns to sorted bars, one bucket after another."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, place):
            bounds = run_starts(table, place)
            values, states = _sources(engines, table), table.column("_state")
            parts: dict[str, list[np.ndarray]] = {n: [] for n in names}
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                for name, column in Stepper(engines, states[int(lo)].as_py()).step({s: x[lo:hi] for s, x in values.items()}).items():
                    parts[name].append(column)
            table = table.drop_columns(["_state"])
            for name in names:
                table = table.append_column(name, pa.array(np.concatenate(parts[name]), pa.float64(), from_pandas=True))
            yield from table.to_batches()

    return apply


def first_bars(features: DataFrame, names: list[str]) -> DataFrame:
    """(series, feature, first_bar, first_ts, last_value): where each column begins, by bar, and how it ends."""
    bars = numbered(features)
    long = bars.select(*SERIES, "bar", "ts", F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])).alias("feature", "value"))
    return long.groupBy(*SERIES, "feature").agg(
        F.min(F.when(F.col("value").isNotNull(), F.col("bar"))).alias("first_bar"),
        F.min(F.when(F.col("value").isNotNull(), F.col("ts"))).alias("first_ts"),
        F.max_by("value", "ts").alias("last_value"),
    )

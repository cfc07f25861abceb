"""The jobs that put the parts together: ingest passes, and the features of what is stored."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.operators import gaps, indicators, intervals, rollup
from candlewright.schema import MINUTE_MS, SERIES, as_candles
from candlewright.sources import config, payloads, rest
from candlewright.sources.files import create_once, drop_path, names_in, numbers_in, written
from candlewright.sources.store import RANGE_BARS, CandleStore

Wanted = list[tuple[tuple, str]]
BOUNDS = "market string, category string, symbol string, timeframe_minutes int, timeframe string, start_ts long, end_ts long"


def requests_for(missing: DataFrame, limit: int) -> DataFrame:
    """Requests (request_start, request_end) for intervals of missing candles of any series, both ends included."""
    width = F.col("timeframe_minutes").cast("long") * MINUTE_MS
    step = width * limit
    cut = missing.withColumn("request_start", F.explode(F.sequence(F.col("start_ts"), F.col("end_ts"), step)))
    return cut.withColumn("request_end", F.least(F.col("request_start") + step, F.col("end_ts") + width))


def roll_up(store: CandleStore, targets: list[tuple[int, int]]) -> dict[int, int]:
    """Build what the store's (source, target minutes) lack since the last time; how many candles of each target were built.

    The store's log tells what was written since, and a number in ``rolled`` beside it up to where each target has been built from it. Of each
    series only the slots that changed are built anew, and those that were still open. A target that was never built is built from all.
    """
    spark, made = store.spark, {}
    for source, target in rollup.layers(targets):
        place = f"{store.root}/rolled/{source}-{target}"
        done = numbers_in(spark, place)
        last, changes = store.changes(done[-1] if done else 0, source)
        marks = store.marks()
        slots = rollup.touched_slots(changes, marks.where(F.col("timeframe_minutes") == source), marks, target)
        spans = [tuple(r) for r in slots.distinct().collect()]  # as many as the log has intervals
        if spans:
            rows = intervals.in_intervals(store.within(spans), spark.createDataFrame(spans, slots.schema))
            reach = marks.select(*SERIES, F.col("max_ts").alias("ts"))
            built = store.write(rollup.rollup(rows, source, target, dedup=False, reach_of=reach))
            made[target] = built.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        create_once(spark, f"{place}/{last:012d}", "")
        for v in done:
            if v < last:
                drop_path(spark, f"{place}/{v:012d}")
    return made


@dataclass
class Ingest:
    """Fetch what series lack, roll it up. ``exchange`` is a configuration as in ``rest.Exchange.of``.

    All gaps of all series are one plan: a table of requests that a fixed number of lanes answer, and one write.
    ``variants`` (market, category, symbol, variants) has other names of symbols, tried in turn; which one worked is kept
    beside the store and tried first from then on. ``probe`` looks for the first candle
    that the exchange has of each series before anything is asked for. ``failed`` tells what could not be asked for.
    """

    spark: SparkSession
    store: CandleStore
    exchange_name: str
    exchange: dict
    limit: int = 1000
    replay: str | None = None
    lanes: int = rest.LANES
    variants: DataFrame | None = None
    probe: bool = False
    failed: dict[tuple, str] = field(default_factory=dict)

    def bounds(self, wanted: Wanted, start_ts: int, end_ts: int | None, now_ms: int | None = None) -> DataFrame:
        """The range of each series that can be asked for; without an end, up to its last closed candle at ``now_ms``."""
        rows = []
        for series, timeframe in wanted:
            if not isinstance(series[3], int) or series[3] < 1:
                self.failed[series] = f"{timeframe}: a timeframe needs at least one minute"
                continue
            width = series[3] * MINUTE_MS
            closed = (now_ms or int(time.time() * 1000)) // MINUTE_MS * MINUTE_MS // width * width - width
            rows.append((*series, timeframe, start_ts, max(closed, 0) if end_ts is None else end_ts))
        return self.spark.createDataFrame(rows, BOUNDS)

    def missing(self, bounds: DataFrame) -> DataFrame:
        """(series, start_ts, end_ts, n): intervals within ``bounds``, both ends included, without a candle in the store.

        The store's bitmaps of what it has tell; candles are not read.
        """
        widths = sorted(r[0] for r in bounds.select("timeframe_minutes").distinct().collect())
        parts = [gaps.missing_from_bitmaps(bounds.where(F.col("timeframe_minutes") == m), self.store.presence(m), m, RANGE_BARS) for m in widths]
        none = self.spark.createDataFrame([], "market string, category string, symbol string, timeframe_minutes int, start_ts long, end_ts long, n long")
        return functools.reduce(DataFrame.unionByName, parts, none)

    def named(self, rows: DataFrame) -> DataFrame:
        """``rows`` with names: those of the symbol in the order to try."""
        keys = SERIES[:3]
        known = rows.withColumn("_v", F.array("symbol"))
        if self.variants is not None:
            known = rows.join(self.variants.select(*keys, F.col("variants").alias("_v")).dropDuplicates(keys), keys, "left").withColumn("_v", F.coalesce("_v", F.array("symbol")))
        worked = self.winners().withColumnRenamed("name", "_last")
        return known.join(worked, keys, "left").withColumn("names", config.tried_variants(F.col("_v"), F.col("_last"))).drop("_v", "_last")

    def winners(self) -> DataFrame:
        """(market, category, symbol, name): the name of each symbol that the exchange answered last."""
        rows = self._kept("names", "market string, category string, symbol string, name string, at_ms long")
        return rows.groupBy(*SERIES[:3]).agg(F.max_by("name", "at_ms").alias("name"))

    def begun(self, bounds: DataFrame) -> DataFrame:
        """``bounds`` from the first candle that the exchange has on, looked for once and kept beside the store.

        Series of which it has none yet are left out, and looked for again in the next pass.
        """
        known = self._kept("begins", "market string, category string, symbol string, timeframe_minutes int, first_ts long")
        path = tuple(self.exchange.get("format", {}).get("data_path", ("data", "ohlc")))
        found = rest.first_candles(self.named(bounds.join(known, SERIES, "left_anti")), self._of(), path, self.limit, self.lanes, self.replay)
        found.where("first_ts IS NOT NULL").select(*SERIES, "first_ts").write.mode("append").parquet(f"{self.store.root}/begins")
        known = self._kept("begins", "market string, category string, symbol string, timeframe_minutes int, first_ts long").groupBy(*SERIES).agg(F.min("first_ts").alias("first_ts"))
        return bounds.join(known, SERIES).select(*SERIES, "timeframe", F.greatest("start_ts", "first_ts").alias("start_ts"), "end_ts")

    def _kept(self, name: str, schema: str) -> DataFrame:
        """A small table beside the store; without rows where it is not there yet."""
        place = f"{self.store.root}/{name}"
        return self.spark.read.schema(schema).parquet(place) if names_in(self.spark, place) else self.spark.createDataFrame([], schema)

    def _of(self) -> rest.Exchange:
        return rest.Exchange.of(self.exchange_name, self.exchange)

    def fetch(self, bounds: DataFrame, missing: DataFrame | None = None) -> DataFrame:
        """Ask for all that is missing within ``bounds``, once, and write it; (series, n) written."""
        lacking = (self.missing(bounds) if missing is None else missing).join(bounds.select(*SERIES, "timeframe"), SERIES)
        asked = rest.answers(self.named(requests_for(lacking, self.limit)), self._of(), self.limit, self.lanes, self.replay)
        raw, path = written(asked, "answers")
        raw.where("status = 200").select(*SERIES[:3], "name", F.lit(int(time.time() * 1000)).alias("at_ms")).distinct().write.mode("append").parquet(f"{self.store.root}/names")
        form = self.exchange.get("format", {})
        got = raw.where("payload IS NOT NULL").select(*SERIES, "start_ts", "end_ts", "payload")
        rows = payloads.parse(got, form.get("response_type", "array"), multiplier=int(form.get("timestamp_multiplier", 1)), path=tuple(form.get("data_path", ("data", "ohlc"))))
        made = self.store.write(as_candles(rows.where("ts BETWEEN start_ts AND end_ts")))
        drop_path(self.spark, path)
        return made

    def fill(self, bounds: DataFrame) -> dict[tuple, int]:
        """Fetch until nothing is missing or the number stays; the missing candles of each series then.

        What is missing is found once before each fetch and once after the last, into a table that all that asks for it reads.
        """
        before, path = None, None
        while True:
            lacking, new = written(self.missing(bounds), "missing")
            if path is not None:
                drop_path(self.spark, path)
            path, left = new, lacking.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            if not left or (before is not None and left >= before):
                break
            before = left
            self.fetch(bounds, lacking)
        per = {tuple(r)[:4]: r["n"] for r in lacking.groupBy(*SERIES).agg(F.sum("n").alias("n")).collect()}
        drop_path(self.spark, path)
        return {tuple(r): per.get(tuple(r), 0) for r in bounds.select(*SERIES).collect()}

    def run(self, wanted: Wanted, start_ts: int, end_ts: int | None, targets: list[tuple[int, int]] = (), now_ms: int | None = None) -> dict[tuple, int]:
        """One pass: fill each (series, timeframe), roll up along ``targets``. The missing candles of each series."""
        bounds = self.bounds(wanted, start_ts, end_ts, now_ms)
        left = self.fill(self.begun(bounds) if self.probe else bounds)
        roll_up(self.store, list(targets))
        if left:
            self.store.compact()
            self.store.vacuum()
        return left

    def poll(self, wanted: Wanted, start_ts: int, targets: list[tuple[int, int]] = (), every_s: float = 60.0, passes: int | None = None, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> dict[tuple, int]:
        """Passes up to the last closed candles, one every ``every_s`` seconds, for ever unless ``passes`` are given.

        A pass that fails is noted in ``failed`` and the next one asks again, since what is missing is found anew.
        """
        left: dict[tuple, int] = {}
        done = 0
        while passes is None or done < passes:
            began = clock()
            try:
                left = self.run(wanted, start_ts, None, targets, int(began * 1000))
            except Exception as e:  # noqa: BLE001  the next pass may succeed
                self.failed[("pass", done)] = str(e)[:500]
            done += 1
            if passes is None or done < passes:
                sleep(max(0.0, began + every_s - clock()))
        return left


def training_features(store: CandleStore, symbols: DataFrame, timeframes: DataFrame, start_ts: int | None = None, engines: tuple[indicators.Engine, ...] = indicators.DEFAULT_ENGINES, dtype: str = "double") -> DataFrame:
    """Features of all stored series of active symbols in active timeframes, from ``start_ts`` on unless that is None."""
    return indicators.with_features(config.dimension_series(store.scan(), config.active_symbols(symbols), timeframes, start_ts), engines, dtype)

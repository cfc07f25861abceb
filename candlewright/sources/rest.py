"""Candles from REST exchanges: requests as rows, which executors fetch and answer with raw payloads.

Requests are planned as a table from what is missing, for all series at once, and dealt to a fixed number of lanes for each
exchange. A lane is one task; it has its part of the exchange's rate and sends its requests one after another, so the
rate of all lanes together is the exchange's whatever the number of requests. Payload text becomes candles by
``payloads.parse``, in Spark. The data source ``rest_candles`` does the same for one series, in batch and as a stream. With
a ``replay`` folder the payloads come from files instead of the network, which is how tests run.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from candlewright.schema import MINUTE_MS, SERIES
from candlewright.session import ship

RAW = "exchange string, symbol string, timeframe string, start_ts long, end_ts long, status int, payload string"
#: 1 January 2011, from where a request without a start begins.
EARLIEST_MS = 1_293_840_000_000
ATTEMPTS, LANES = 3, 4
#: What an exchange says to who asks too often.
REFUSED = (418, 429)
Answer = tuple[int, bytes, dict]


@dataclass(frozen=True)
class Exchange:
    """One exchange as configured. ``params`` are templates: {symbol} {timeframe} {start} {end} {limit} or plain values."""

    name: str
    api_url: str
    params: dict = field(default_factory=dict)
    active: bool = True
    timestamp_format: str = "milliseconds"
    timeframe_format: str = "default"
    rate_limit: float = 0.25
    backoff_base: float = 2.0
    max_backoff: float = 30.0

    @staticmethod
    def of(name: str, config: dict) -> Exchange:
        params = {k: v.get("value", "") for k, v in config.get("format", {}).get("params", {}).items()}
        return Exchange(
            name, config.get("api_url", ""), params, bool(config.get("active")), config.get("timestamp_format", "milliseconds"), config.get("timeframe_format", "default"),
            float(config.get("rate_limit", 0.25)), float(config.get("backoff_429_base", 2.0)), float(config.get("max_backoff", 30.0)),
        )


def timeframe_for(exchange: Exchange, timeframe: str, minutes: int) -> str:
    """The timeframe as the exchange wants it."""
    return {"seconds": str(minutes * 60), "minutes": str(minutes), "hours": str(minutes // 60)}.get(exchange.timeframe_format, timeframe)


def request(exchange: Exchange, symbol: str, timeframe: str, minutes: int, start_ts: int | None = None, end_ts: int | None = None, limit: int = 1000) -> tuple[str, dict]:
    """(url, params) for at most ``limit`` candles; ("", {}) where the exchange is inactive or has no address.

    An end of None leaves the end open, 0 stands for a full window, and any other is cut to a full window.
    """
    if not exchange.active or not exchange.api_url:
        return "", {}
    begin = EARLIEST_MS if start_ts is None else start_ts
    window = begin + limit * minutes * MINUTE_MS
    end = None if end_ts is None else window if end_ts == 0 else min(window, end_ts)
    unit = 1000 if exchange.timestamp_format == "seconds" else 1
    known = {"{symbol}": symbol, "{timeframe}": timeframe_for(exchange, timeframe, minutes), "{start}": str(begin // unit), "{end}": None if end is None else str(end // unit), "{limit}": str(limit)}
    made = {k: limit if k == "limit" and not isinstance(v, str) else known.get(v, v) if isinstance(v, str) else v for k, v in exchange.params.items()}
    absent = [k for k, v in made.items() if v is None or v == ""]
    return exchange.api_url.replace("{symbol}", symbol.lower()), {k: v for k, v in made.items() if k not in absent}


def plan_requests(intervals: DataFrame, minutes: int, limit: int = 1000) -> DataFrame:
    """``intervals`` with request_start and request_end of windows of ``limit`` candles; neighbours share an edge."""
    step = limit * minutes * MINUTE_MS
    starts = F.when(F.col("start_ts") < F.col("end_ts"), F.sequence(F.col("start_ts"), F.col("end_ts") - 1, F.lit(step)))
    cut = intervals.withColumn("request_start", F.explode(starts))
    return cut.withColumn("request_end", F.least(F.col("request_start") + step, F.col("end_ts")))


def windows(start_ts: int, end_ts: int, minutes: int, limit: int) -> list[tuple[int, int]]:
    step = limit * minutes * MINUTE_MS
    return [(at, min(at + step, end_ts)) for at in range(start_ts, end_ts, step)]


@dataclass
class Lane:
    """The instants at which one of several callers of an exchange may send, each with an equal part of its rate.

    The part shrinks to a half when the exchange refuses, but all lanes together may always send one request a second;
    an answer gives back a lane's part of one request a second, up to where it began.
    """

    whole: float
    lanes: int = 1
    factor: float = 1.0
    due: float = 0.0

    @property
    def rate(self) -> float:
        return self.whole * self.factor / self.lanes

    def book(self, now: float) -> float:
        """Take the next instant; how long to wait for it."""
        at = max(self.due, now)
        self.due = at + 1 / self.rate
        return at - now

    def heard(self, status: int) -> None:
        if status in REFUSED:
            self.factor = max(self.factor / 2, min(1.0, 1 / self.whole))
        elif status == 200:
            self.factor = min(1.0, self.factor + 1 / self.whole)


def lane_of(exchange: Exchange, lanes: int = 1) -> Lane:
    return Lane(1 / exchange.rate_limit if exchange.rate_limit > 0 else 1e9, lanes)


@dataclass
class Caller:
    """Sends requests of one lane: waits for its turn, tries again after refusals and errors, longer each time."""

    exchange: Exchange
    lane: Lane
    get: Callable[[str], Answer] | None = None
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep

    def __call__(self, url: str, params: dict, attempts: int = ATTEMPTS) -> tuple[int, str | None]:
        """(status, text); no text where the last attempt failed. Status 0 stands for no answer at all."""
        address = f"{url}?{urllib.parse.urlencode(params)}" if params else url
        status = 0
        for left in reversed(range(attempts)):
            self.sleep(self.lane.book(self.clock()))
            try:
                status, body, headers = (self.get or http_get)(address)
            except OSError:
                status, body, headers = 0, b"", {}
            self.lane.heard(status)
            if status == 200:
                return status, body.decode(errors="replace")
            if 400 <= status < 500 and status not in REFUSED:
                break  # the request itself is wrong, and will be again
            if left:
                told = str(headers.get("Retry-After", ""))
                self.sleep(min(self.exchange.max_backoff, float(told) if told.isdigit() else self.exchange.backoff_base * 2 ** (attempts - 1 - left)))
        return status, None


@dataclass
class Desk:
    """Answers requests of one lane, from the exchange or a replay folder, under whichever name of a symbol works."""

    caller: Caller
    limit: int = 1000
    replay: str | None = None
    worked: dict[str, str] = field(default_factory=dict)

    def ask(self, name: str, timeframe: str, minutes: int, start_ts: int, end_ts: int) -> tuple[int, str | None]:
        url, params = request(self.caller.exchange, name, timeframe, minutes, start_ts, end_ts, self.limit)
        if not url:
            return 0, None
        if self.replay is None:
            return self.caller(url, params)
        file = Path(self.replay) / f"{name}-{timeframe}-{start_ts}.json"
        return (200, file.read_text()) if file.exists() else (404, None)

    def answer(self, symbol: str, names: list[str], timeframe: str, minutes: int, start_ts: int, end_ts: int) -> tuple[int, str | None, str | None]:
        """(status, text, name): by the name that worked last, else by each in turn until one does."""
        status = 0
        for name in dict.fromkeys([*([self.worked[symbol]] if symbol in self.worked else []), *(names or [symbol])]):
            status, text = self.ask(name, timeframe, minutes, start_ts, end_ts)
            if status == 200:
                self.worked[symbol] = name
                return status, text, name
            if status == 0 or status in REFUSED or status >= 500:
                break  # not the name's fault
        return status, None, None

    def has_candles(self, names: list[str], symbol: str, timeframe: str, minutes: int, start_ts: int, path: tuple[str, ...]) -> bool:
        """Whether a window from ``start_ts`` on has any candle."""
        _, text, _ = self.answer(symbol, names, timeframe, minutes, start_ts, start_ts + self.limit * minutes * MINUTE_MS)
        try:
            rows = json.loads(text or "[]")
            for part in path if isinstance(rows, dict) else ():
                rows = rows[part]
        except (ValueError, KeyError, TypeError):
            return False
        return bool(rows) and isinstance(rows, (list, dict))


REQUESTS = ["names", "timeframe", "request_start", "request_end"]


def answers(requests: DataFrame, exchange: Exchange, limit: int = 1000, lanes: int = LANES, replay: str | None = None, get: Callable[[str], Answer] | None = None) -> DataFrame:
    """The columns of ``requests``, then status, payload and name (that of the symbol which worked).

    ``requests`` has the series, names (array, in the order to try), timeframe, request_start and request_end. They are dealt
    to ``lanes`` tasks, and each sends its own in the order of time. Write the result before it is used twice.
    """
    ship(requests.sparkSession)
    asked = requests.withColumn("_lane", F.pmod(F.xxhash64(*SERIES, "request_start"), F.lit(lanes)).cast("int"))
    dealt = asked.repartitionById(lanes, F.col("_lane")).sortWithinPartitions("request_start", *SERIES).drop("_lane")

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        desk = Desk(Caller(exchange, lane_of(exchange, lanes), get), limit, replay)
        for part in parts:
            made = [desk.answer(r.symbol, list(r.names) if r.names is not None else [], r.timeframe, int(r.timeframe_minutes), int(r.request_start), int(r.request_end)) for r in part.itertuples()]
            part["status"], part["payload"], part["name"] = zip(*made, strict=True) if made else ([], [], [])
            yield part

    return dealt.mapInPandas(send, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema) + ", status int, payload string, name string")


def first_candles(series: DataFrame, exchange: Exchange, path: tuple[str, ...] = (), limit: int = 1000, lanes: int = LANES, replay: str | None = None) -> DataFrame:
    """The columns of ``series``, then first_ts: from where on the exchange has candles between start_ts and end_ts, or null.

    Each series takes a bisection of windows, about the logarithm of their number in requests, in one of ``lanes`` tasks.
    """
    ship(series.sparkSession)
    dealt = series.withColumn("_lane", F.pmod(F.xxhash64(*SERIES), F.lit(lanes)).cast("int")).repartitionById(lanes, F.col("_lane")).drop("_lane")

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        desk = Desk(Caller(exchange, lane_of(exchange, lanes)), limit, replay)
        for part in parts:
            found = []
            for r in part.itertuples():
                names, minutes = list(r.names) if r.names is not None else [], int(r.timeframe_minutes)
                at = earliest(lambda ts, r=r, n=names, m=minutes: desk.has_candles(n, r.symbol, r.timeframe, m, ts, path), int(r.start_ts), int(r.end_ts), minutes * limit)
                found.append(at)
            part["first_ts"] = pd.array(found, dtype="Int64")
            yield part

    return dealt.mapInPandas(probe, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema) + ", first_ts long")


def http_get(url: str) -> tuple[int, bytes, dict]:
    try:
        with urllib.request.urlopen(url, timeout=30) as answer:  # noqa: S310
            return answer.status, answer.read(), dict(answer.headers)
    except urllib.error.HTTPError as e:
        return e.code, b"", dict(e.headers)


def earliest(available: Callable[[int], bool], start_ts: int, end_ts: int, minutes: int) -> int | None:
    """The first candle start at which data are available, by bisection; None where there are none up to the end.

    Availability must not end once it has begun.
    """
    step = minutes * MINUTE_MS
    low, high = 0, max(0, (end_ts - start_ts) // step)
    if not available(start_ts + high * step):
        return None
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if available(start_ts + middle * step) else (middle + 1, high)
    return start_ts + low * step


@dataclass
class Windows(InputPartition):
    """The requests of one lane."""

    windows: list[tuple[int, int]]


def _dealt(options: dict, start_ts: int, end_ts: int) -> list[Windows]:
    lanes = int(options.get("lanes", LANES))
    all_ = windows(start_ts, end_ts, int(options["minutes"]), int(options.get("limit", 1000)))
    return [Windows(all_[i::lanes]) for i in range(min(lanes, len(all_)))]


def _read(options: dict, part: Windows, strict: bool = False) -> Iterator[tuple]:
    exchange = Exchange.of(options["exchange"], json.loads(options["config"]))
    desk = Desk(Caller(exchange, lane_of(exchange, int(options.get("lanes", LANES)))), int(options.get("limit", 1000)), options.get("replay"))
    symbol, timeframe, minutes = options["symbol"], options["timeframe"], int(options["minutes"])
    for start_ts, end_ts in part.windows:
        status, text = desk.ask(symbol, timeframe, minutes, start_ts, end_ts)
        if strict and status != 200 and (status == 0 or status in REFUSED or status >= 500):
            raise OSError(f"{exchange.name} answered {symbol} {timeframe} from {start_ts} with status {status}")
        yield options["exchange"], symbol, timeframe, start_ts, end_ts, status, text


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Windows]:
        return _dealt(self.options, int(self.options["start_ts"]), int(self.options["end_ts"]))

    def read(self, partition: Windows) -> Iterator[tuple]:
        return _read(self.options, partition)


class _StreamReader(DataSourceStreamReader):
    """Each micro-batch asks for at most ``batch_candles`` more candles, up to end_ts or the last closed candle.

    A request that the exchange refuses, fails or does not answer fails the micro-batch, which then asks for the same
    candles again; the offset does not pass what was not read. What it says it does not have (404) is passed.
    """

    def __init__(self, options: dict) -> None:
        self.options = options
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"ts": int(self.options["start_ts"])}

    def latestOffset(self) -> dict:
        step = int(self.options["minutes"]) * MINUTE_MS
        now = int(self.options.get("end_ts", 0)) or int(time.time() * 1000) // step * step
        self.at = min(now, (int(self.options["start_ts"]) if self.at is None else self.at) + int(self.options.get("batch_candles", 10_000)) * step)
        return {"ts": self.at}

    def partitions(self, start: dict, end: dict) -> list[Windows]:
        self.at = max(self.at or 0, end["ts"])
        return _dealt(self.options, start["ts"], end["ts"])

    def read(self, partition: Windows) -> Iterator[tuple]:
        return _read(self.options, partition, strict=True)


class RestCandles(DataSource):
    """Format ``rest_candles``. Options: exchange, config (JSON), symbol, timeframe, minutes, start_ts, end_ts, limit, lanes, replay."""

    @classmethod
    def name(cls) -> str:
        return "rest_candles"

    def schema(self) -> str:
        return RAW

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))

import json

import pytest
from pyspark.sql import functions as F

from candlewright.functions import time as t
from candlewright.sources import config, payloads, rest

START, END = 1735689600000, 1735776000000
BARS = {"active": True, "api_url": "https://bars.example/{symbol}/ohlc", "timestamp_format": "seconds", "timeframe_format": "seconds",
        "format": {"params": {"step": {"value": "{timeframe}"}, "limit": {"value": 1000}, "start": {"value": "{start}"}, "end": {"value": "{end}"}, "none": {"value": ""}}}}


def ask(config=BARS, **more):
    return rest.request(rest.Exchange.of("bars", config), "BTCUSD", "1h", 60, **{"start_ts": START, "end_ts": END} | more)


def test_request_comes_from_config():
    url, params = ask()
    assert url == "https://bars.example/btcusd/ohlc"
    assert params == {"step": "3600", "limit": 1000, "start": str(START // 1000), "end": str(END // 1000)}


def test_windows_end_where_asked_or_when_full():
    quarter = lambda **more: rest.request(rest.Exchange.of("bars", BARS | {"timestamp_format": "milliseconds"}), "ETHEUR", "15m", 15, **more)[1]
    width = 900_000
    for candles, limit in ((3, 8), (8, 8), (9, 8), (500, 96)):
        got = quarter(start_ts=START, end_ts=START + candles * width, limit=limit)
        assert int(got["end"]) - int(got["start"]) == min(candles, limit) * width
    assert quarter(start_ts=START, end_ts=START + width // 3)["end"] == str(START + width // 3)
    assert set(quarter(start_ts=7, end_ts=None)) == {"step", "limit", "start"} and quarter(start_ts=7)["start"] == "7"
    assert quarter(start_ts=START, end_ts=0, limit=4)["end"] == str(START + 4 * width)
    assert quarter()["start"] == str(rest.EARLIEST_MS) and quarter(start_ts=0)["start"] == "0"


def test_no_request_of_an_inactive_exchange():
    assert ask(BARS | {"active": False}) == ("", {}) and ask(BARS | {"api_url": ""}) == ("", {})


def test_plan_shares_edges(spark):
    df = spark.createDataFrame([("a", 0, 250 * 60_000), ("b", 5, 5), ("c", 9, 2)], "k string, start_ts long, end_ts long")
    got = [(r.request_start // 60_000, r.request_end // 60_000) for r in rest.plan_requests(df, 1, 100).orderBy("request_start").collect()]
    assert got == [(0, 100), (100, 200), (200, 250)] == [(a // 60_000, b // 60_000) for a, b in rest.windows(0, 250 * 60_000, 1, 100)]


class Clock:
    def __init__(self):
        self.now, self.sent = 0.0, []

    def sleep(self, seconds):
        self.now += seconds


def caller(answers, lanes=1, clock=None, **more):
    clock = clock or Clock()
    exchange = rest.Exchange("x", "u", **more)

    def get(url):
        clock.sent.append(clock.now)
        made = answers(len(clock.sent)) if callable(answers) else answers.pop(0)
        if isinstance(made, Exception):
            raise made
        return made

    return rest.Caller(exchange, rest.lane_of(exchange, lanes), get, lambda: clock.now, clock.sleep), clock


def test_a_caller_tries_again_later():
    ask, clock = caller([(429, b"", {"Retry-After": "7"}), (500, b"", {}), (200, b"[]", {})])
    assert ask("u", {"a": 1}) == (200, "[]") and clock.sent == [0.0, 7.0, 11.0]
    assert caller([(503, b"", {})] * 3, max_backoff=1.0)[0]("u", {}) == (503, None)
    assert caller([OSError()] * 3)[0]("u", {}) == (0, None)
    ask, clock = caller([(404, b"", {})])
    assert ask("u", {}) == (404, None) and len(clock.sent) == 1


def test_a_lane_slows_down_and_recovers():
    lane = rest.Lane(8.0)
    assert [lane.book(0.0) for _ in range(3)] == [0.0, 0.125, 0.25]
    rates = []
    for status in (429, 429, 418, 429, 429, 503, 200, 200, *[200] * 9):
        lane.heard(status)
        rates.append(lane.rate)
    assert rates[:8] == [4.0, 2.0, 1.0, 1.0, 1.0, 1.0, 2.0, 3.0] and rates[-1] == 8.0
    assert rest.Lane(8.0, 4).rate == 2.0 and rest.Lane(0.5).rate == 0.5


@pytest.mark.parametrize("lanes", [1, 4])
def test_all_lanes_together_keep_to_the_rate(lanes):
    sent = []
    for _ in range(lanes):
        ask, clock = caller(lambda k: (429, b"", {}) if k % 10 == 0 else (200, b"[]", {}), lanes, rate_limit=0.25)
        while clock.now < 100:
            ask("u", {})
        sent += clock.sent
    assert len([t for t in sent if t < 100]) <= 4 * 100 + lanes and len(sent) > 100
    worst = max(sum(a <= t < a + 10 for t in sent) for a in range(90))
    assert worst <= 40 + lanes


def test_other_names_are_tried_and_the_one_that_works_is_kept(tmp_path):
    for at in (0, 1):
        (tmp_path / f"btcusd-1m-{at}.json").write_text("[[1]]")
    desk = rest.Desk(rest.Caller(rest.Exchange.of("x", BARS), rest.Lane(1e9)), 10, str(tmp_path))
    assert desk.answer("BTC", ["BTC/USD", "btcusd"], "1m", 1, 0, 9) == (200, "[[1]]", "btcusd") and desk.worked == {"BTC": "btcusd"}
    assert desk.answer("BTC", ["BTC/USD"], "1m", 1, 1, 9) == (200, "[[1]]", "btcusd")
    assert desk.answer("ETH", [], "1m", 1, 0, 9) == (404, None, None)


def test_earliest_is_found_by_bisection():
    first = START + 37 * 3_600_000
    tried = []
    assert rest.earliest(lambda ts: tried.append(ts) or ts >= first, START, START + 1000 * 3_600_000, 60) == first
    assert len(tried) <= 12
    assert rest.earliest(lambda ts: False, START, END, 60) is None


def test_replayed_source_batch_and_stream(spark, tmp_path):
    spark.dataSource.register(rest.RestCandles)
    for k in (0, 10):
        at = [START + (k + i) * 3_600_000 for i in range(10)]
        body = {"data": {"ohlc": [{"timestamp": str(x // 1000), "open": "1", "high": "2", "low": "0.5", "close": "1.5"} for x in at]}}
        (tmp_path / f"BTCUSD-1h-{START + k * 3_600_000}.json").write_text(json.dumps(body))
    options = {"exchange": "bars", "config": json.dumps(BARS), "symbol": "BTCUSD", "timeframe": "1h", "minutes": "60", "start_ts": str(START), "end_ts": str(START + 25 * 3_600_000), "limit": "10", "replay": str(tmp_path)}
    raw = spark.read.format("rest_candles").options(**options).load()
    assert sorted((r.status, (r.start_ts - START) // 3_600_000) for r in raw.collect()) == [(200, 0), (200, 10), (404, 20)]
    parsed = payloads.parse(raw.select("symbol", "payload"), "object", multiplier=1000)
    assert parsed.count() == 20 and parsed.agg(F.min("ts"), F.max("volume")).first() == (START, 0.0)
    stream = spark.readStream.format("rest_candles").options(**options, batch_candles="10").load()
    q = stream.writeStream.format("memory").queryName("rest_rows").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("rest_rows").count() >= 1


ARRAYS = [[[1735689600000, "93000.1", "93500", "92500", "93250", "1.5", 0, "x"], [1735693200000, 1, 2, 3, 4, 5]]]


def test_array_payloads(spark):
    df = spark.createDataFrame([(1, json.dumps(ARRAYS[0])), (2, json.dumps([[1735689600, "1", "1", "1", "1", "1"], ["bad", 1, 1, 1, 1, 1], [1, 2]]))], "id int, payload string")
    got = sorted(map(tuple, payloads.parse_arrays(df).collect()))
    assert got == [(1, 1735689600000, 93000.1, 93500.0, 92500.0, 93250.0, 1.5), (1, 1735693200000, 1.0, 2.0, 3.0, 4.0, 5.0), (2, 1735689600000, 1.0, 1.0, 1.0, 1.0, 1.0)]


def test_object_payloads(spark):
    whole = {"timestamp": "1735689600", "open": "1", "high": "2", "low": "0", "close": "1", "volume": "3"}
    items = [whole, {k: v for k, v in whole.items() if k != "low"}, {k: v for k, v in whole.items() if k != "volume"}]
    df = spark.createDataFrame([(1, json.dumps({"data": {"pair": "P", "ohlc": items}})), (2, json.dumps({"data": {"ohlc": whole}}))], "id int, payload string")
    got = sorted((r.id, r.ts, r.volume) for r in payloads.parse_objects(df, multiplier=1000).collect())
    assert got == [(1, 1735689600000, 0.0), (1, 1735689600000, 3.0), (2, 1735689600000, 3.0)]


@pytest.mark.parametrize("bad", ["[]", "{}", '{"code": 1, "error": "no"}', '{"data": {"ohlc": []}}', "not json", "", None])
def test_bad_payloads_have_no_rows(spark, bad):
    df = spark.createDataFrame([(bad,)], "payload string")
    assert payloads.parse_arrays(df).count() == 0 and payloads.parse_objects(df).count() == 0


def test_unknown_type_raises(spark):
    with pytest.raises(ValueError):
        payloads.parse(spark.createDataFrame([("",)], "payload string"), "xml")


def test_config_files_and_problems(tmp_path):
    path = str(tmp_path / "c.json")
    config.save_json({"a": 1}, path)
    config.save_json({"a": 2}, path)
    assert config.load_json(path) == {"a": 2} and len(list(tmp_path.iterdir())) == 1
    (tmp_path / "c.yaml").write_text("a:\n  b: [1, 2]\n")
    assert config.load_config(str(tmp_path / "c.yaml")) == {"a": {"b": [1, 2]}} and config.load_config(path) == {"a": 2}
    (tmp_path / "c.yaml").unlink()
    with pytest.raises(FileNotFoundError):
        config.load_json(str(tmp_path / "none.json"))
    good = {k: {"minutes": m} for k, m in config.STANDARD_MINUTES.items()}
    assert config.problems(good, {k: {"minutes": m, "source": s} for k, (m, s) in config.CUSTOM_MINUTES.items()}) == []
    assert len(config.problems(good | {"x1": {}}, {"7m": {"minutes": 7, "source": "3m"}, "9m": {"minutes": 9, "source": "no"}})) == 4


def test_filters(spark):
    frames = config.timeframes(spark, {"1h": {"minutes": 60, "active": True, "active_featured": True}, "1d": {"minutes": 1440, "active": True}, "3h": {"minutes": 180, "active": True}})
    assert [r.name for r in config.active_timeframes(frames).collect()] == ["1h"]
    assert config.custom_timeframes(spark, {"enable": False, "custom_intervals": {"2d": {"minutes": 2880}}}).count() == 0
    custom = config.custom_timeframes(spark, {"enable": True, "custom_intervals": {"3h": {"hours": 3, "source": "1h", "active": True, "active_featured": True}, "1h": {"minutes": 61, "active": True, "active_featured": True}}})
    assert sorted((r.name, r.minutes) for r in config.read_timeframes(frames, custom).collect()) == [("1h", 61), ("3h", 180)]
    names = spark.createDataFrame([("1h",), ("9x",)], "name string")
    assert sorted((r.name, r.minutes) for r in config.minutes_of(names, frames, custom).collect()) == [("1h", 60), ("9x", 0)]
    fetched = spark.createDataFrame([("3h", True)], "name string, has_data boolean")
    assert [r.name for r in config.build_tasks(custom, frames, fetched).collect()] == ["1h"]


def test_time_functions(spark):
    df = spark.createDataFrame([(-1,), (0,), (1735689600123,)], "ms long")
    got = df.select(t.floored(F.col("ms"), 60_000).alias("f"), t.normalised(F.lit(5)).alias("n"), t.normalised(F.lit(7), 1000).alias("m")).collect()
    assert [r.f for r in got] == [-60_000, 0, 1735689600000] and got[0].n == 5000 and got[0].m == 7000
    text = spark.sql("SELECT '2024-02-29' AS d").select(t.date_millis(F.col("d")).alias("ms")).select(t.millis_text(F.col("ms"), F.lit(60)).alias("a"), t.millis_text(F.col("ms"), F.lit(1440)).alias("b"), t.days_in_year(F.col("ms")).alias("y")).first()
    assert tuple(text) == ("2024-02-29 00:00:00", "2024-02-29", 366)
    now = df.select(t.last_closed(F.col("ms"), F.lit(60)).alias("c")).collect()
    assert [r.c for r in now] == [0, 0, 1735689600000 - 3_600_000]

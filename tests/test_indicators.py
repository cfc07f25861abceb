import numpy as np
import pandas as pd
import pytest
from helpers import DAY, JAN_2024, candles, close_to, loop_average, loop_sma, loop_stdev, walk
from pyspark.sql import functions as F

from candlewright.functions import moving
from candlewright.operators import indicators as ind
from candlewright.operators.series import numbered
from candlewright.schema import PRICES


def frame(spark, closes, symbol="S"):
    return candles(spark, [(JAN_2024 + i * DAY, 0, 0, 0, x, 1) for i, x in enumerate(closes)], symbol=symbol)


def column(df, name):
    return [r[name] for r in df.orderBy("ts").select(name).collect()]


def first(xs):
    return next((i for i, x in enumerate(xs) if x is not None), None)


@pytest.fixture(scope="module")
def block(spark):
    xs = walk(600)
    return xs, ind.with_features(frame(spark, xs)).orderBy("ts").toPandas()


@pytest.mark.parametrize("n", [9, 26, 50, 100, 200])
def test_ema_is_the_loop(block, n):
    xs, pdf = block
    got = [None if x != x else x for x in pdf[f"ema_{n}"]]
    assert got == loop_average(xs, n, 2.0 / (n + 1))
    assert first(got) == n - 1


def test_macd_has_its_own_warm_up(block):
    xs, pdf = block
    fast, slow = loop_average(xs, 12, 2 / 13), loop_average(xs, 26, 2 / 27)
    macd = [None if b is None else a - b for a, b in zip(fast, slow, strict=True)]
    signal = loop_average(macd, 9, 0.2)
    none = lambda c: [None if x != x else x for x in pdf[c]]
    assert close_to(none("macd"), macd) and close_to(none("macd_signal"), signal)
    assert [first(none(c)) for c in ("macd", "macd_signal", "macd_hist")] == [25, 33, 33]


def test_rsi_and_its_mean(block):
    xs, pdf = block
    d = [None] + [b - a for a, b in zip(xs, xs[1:], strict=False)]
    up = loop_average([None if x is None else max(x, 0.0) for x in d], 14, 1 / 14)
    down = loop_average([None if x is None else max(-x, 0.0) for x in d], 14, 1 / 14)
    want = [None if u is None else 100.0 if v == 0 else 0.0 if u == 0 else 100 - 100 / (1 + u / v) for u, v in zip(up, down, strict=True)]
    got = [None if x != x else x for x in pdf["rsi_14"]]
    assert close_to(got, want) and first(got) == 14
    assert first([None if x != x else x for x in pdf["rsi_ma_14"]]) == 27


def test_bollinger(block):
    xs, pdf = block
    mean, sd = loop_sma(xs, 20), loop_stdev(xs, 20)
    none = lambda c: [None if x != x else x for x in pdf[c]]
    assert close_to(none("bb_basis"), mean)
    assert close_to(none("bb_upper"), [None if m is None else m + 2 * s for m, s in zip(mean, sd, strict=True)], 1e-11)
    assert first(none("bb_lower")) == 19


def test_prefix_is_untouched_and_names_are_unique(spark, block):
    xs, pdf = block
    assert list(pdf["close"]) == xs
    assert ind.feature_names()[:5] == ["open", "high", "low", "close", "volume"] and len(ind.feature_names()) == 18
    with pytest.raises(ValueError):
        ind.feature_names((ind.EmaFan((9,)), ind.EmaFan((9,))))


def test_monotone_and_flat_series(spark):
    rising = column(ind.with_features(frame(spark, list(range(1, 61))), (ind.Rsi(),)), "rsi_14")
    falling = column(ind.with_features(frame(spark, list(range(60, 0, -1))), (ind.Rsi(),)), "rsi_14")
    flat = column(ind.with_features(frame(spark, [5.0] * 60), (ind.Rsi(),)), "rsi_14")
    assert rising[20] == 100 and falling[20] == 0 and flat[20] == 100


def test_short_and_leading_null(spark):
    short = ind.with_features(frame(spark, [1, 2, 3, 4, 5]), (ind.EmaFan((200,)),))
    assert column(short, "ema_200") == [None] * 5
    late = [None] * 10 + list(range(1, 51))
    got = column(ind.with_features(frame(spark, late), (ind.EmaFan((5,)),)), "ema_5")
    assert got == loop_average([None if x is None else float(x) for x in late], 5, 2 / 6) and first(got) == 14
    assert column(ind.with_features(frame(spark, [None] * 3), (ind.EmaFan((2,)),)), "ema_2") == [None] * 3
    assert ind.with_features(frame(spark, [])).count() == 0


def test_a_hole_poisons_what_follows(spark):
    xs = [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 8.0]
    got = column(ind.with_features(frame(spark, xs), (ind.EmaFan((2,)), ind.Bollinger(2))), "ema_2")
    assert got[:3] == loop_average(xs[:3], 2, 2 / 3) and got[3:] == [None] * 5
    basis = column(ind.with_features(frame(spark, xs), (ind.Bollinger(2),)), "bb_basis")
    assert basis == [None, 1.5, 2.5, None, None, 5.5, 6.5, 7.5]


def test_nothing_looks_ahead(spark):
    xs = walk(300, seed=5)
    whole = column(ind.with_features(frame(spark, xs)), "macd_signal")
    part = column(ind.with_features(frame(spark, xs[:200])), "macd_signal")
    assert whole[:200] == part


def test_chunks_agree_with_the_whole(spark):
    xs = walk(900, seed=9)
    engines = (ind.EmaFan((9, 20)), ind.Macd(4, 9, 3), ind.Rsi(5, 4), ind.Bollinger(10))
    whole = ind.with_features(frame(spark, xs), engines).orderBy("ts").toPandas()
    parts = ind.with_features(frame(spark, xs), engines, chunk=100).orderBy("ts").toPandas()
    assert len(parts) == len(whole)
    for name in ind.feature_names(engines):
        assert close_to([None if x != x else x for x in parts[name]], [None if x != x else x for x in whole[name]], 1e-12), name


def test_series_do_not_mix(spark):
    a, b = walk(60, 1), walk(60, 2)
    both = ind.with_features(frame(spark, a, "A").unionByName(frame(spark, b, "B")), (ind.EmaFan((9,)),))
    assert column(both.where("symbol = 'B'"), "ema_9") == loop_average(b, 9, 0.2)


def test_length_is_checked_and_config_makes_engines(spark):
    with pytest.raises(ValueError):
        moving.check_length(0)
    made = ind.engines_of({"ema": [7], "macd": {"fast": 3, "slow": 5, "signal": 2}, "rsi": {"length": 21, "ma_length": 5, "source": "high"}, "bbands": {"length": 10, "mult": 1.5}})
    assert [n for e in made for n in e.names()] == ["ema_7", "macd", "macd_signal", "macd_hist", "rsi_21", "rsi_ma_5", "bb_basis", "bb_upper", "bb_lower"]
    assert made[2].source == "high"


def test_float_narrows_only_the_result(spark):
    df = ind.with_features(frame(spark, walk(40)), (ind.EmaFan((9,)),), dtype="float")
    assert dict(df.dtypes)["ema_9"] == "float" and dict(df.dtypes)["close"] == "double"


def test_bar_numbers_over_buckets(spark):
    rows = [(JAN_2024 + i * 7 * DAY, 1, 1, 1, 1, 1) for i in range(2500)]
    got = numbered(candles(spark, rows)).orderBy("ts").select("bar").collect()
    assert [r.bar for r in got] == list(range(2500))
    assert numbered(candles(spark, [])).count() == 0


def test_first_bars(spark):
    f = ind.with_features(frame(spark, walk(40)), (ind.EmaFan((9, 200)),))
    got = {r.feature: (r.first_bar, r.last_value is None) for r in ind.first_bars(f, ["ema_9", "ema_200"]).collect()}
    assert got == {"ema_9": (8, False), "ema_200": (None, True)}


def test_window_functions(spark):
    from pyspark.sql.window import Window

    xs = walk(50)
    df = frame(spark, xs)
    w = Window.partitionBy("symbol").orderBy("ts")
    got = df.select("ts", moving.sma(F.col("close"), 5, w).alias("a"), moving.stdev(F.col("close"), 5, w).alias("b"), moving.change(F.col("close"), w).alias("c"))
    assert close_to(column(got, "a"), loop_sma(xs, 5)) and close_to(column(got, "b"), loop_stdev(xs, 5), 1e-10)
    assert column(got, "c")[0] is None and column(got, "c")[1] == xs[1] - xs[0]


def loop_with_holes(xs, length, alpha):
    """The loop, ended by the first bar without a value after the first one with one."""
    begun = first(xs)
    hole = next((i for i in range(begun, len(xs)) if xs[i] is None), len(xs)) if begun is not None else 0
    return loop_average(xs[:hole], length, alpha) + [None] * (len(xs) - hole)


@pytest.mark.parametrize("holes", [[5_000], [0, 1, 2, 8_191, 16_384], [*range(9_000), 9_500, 20_000], [*range(30_000)]])
def test_holes_end_an_average_whatever_the_size(spark, holes):
    n = 50_000
    xs = walk(n, seed=3)
    for i in holes:
        xs[i] = None
    df = spark.createDataFrame([("m", "c", "S", 1440, JAN_2024 + i * 60_000 * 1440, x) for i, x in enumerate(xs)], "market string, category string, symbol string, timeframe_minutes int, ts long, close double")
    df = df.select("*", *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "volume")])
    want = loop_with_holes(xs, 9, 0.2)
    for chunk in (16_384, 1_000):
        got = ind.with_features(df, (ind.EmaFan((9,)), ind.Rma(5), ind.Bollinger(5)), chunk=chunk).orderBy("ts").toPandas()
        clean = lambda c: [None if x != x else x for x in got[c]]  # noqa: B023, E731
        assert close_to(clean("ema_9"), want, 1e-12) and close_to(clean("rma_5"), loop_with_holes(xs, 5, 0.2), 1e-12)
        assert [x is None for x in clean("bb_basis")] == [None in xs[i - 4 : i + 1] or i < 4 for i in range(n)]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_long_series_are_the_loop(spark, broadcast):
    n = 200_000
    xs = {k: walk(n, seed=k) for k in (1, 2)}
    rng = np.random.default_rng(5)
    # Minutes with gaps, so that buckets hold from one bar to thousands; one of the series has no name.
    at = {k: np.sort(np.concatenate([np.arange(n - 40) * 2 + rng.integers(0, 2, n - 40), 2 * n + np.cumsum(rng.integers(4000, 30_000, 40))])) for k in xs}
    frames = [pd.DataFrame({"symbol": "S" if k == 1 else None, "ts": JAN_2024 + at[k] * 60_000, "close": xs[k]}) for k in xs]
    df = spark.createDataFrame(pd.concat(frames)).select(F.lit("m").alias("market"), F.lit("c").alias("category"), "symbol", F.lit(1).alias("timeframe_minutes"), F.col("ts").cast("long").alias("ts"), *[F.col("close").alias(c) for c in PRICES])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = ind.with_features(df).toPandas().sort_values("ts")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for k, x in xs.items():
        own = got[got.symbol == "S"] if k == 1 else got[got.symbol.isna()]
        want = ind.Stepper(ind.DEFAULT_ENGINES).step({"close": np.array(x)})
        assert len(own) == n and list(own.close) == x
        for name, column in want.items():
            # A difference of averages is as exact as they are, of about the size of the bars.
            near = np.abs(x).max() * 1e-14 if "macd" in name else 0
            np.testing.assert_allclose(own[name].to_numpy(), column, rtol=1e-12, atol=near, err_msg=name)
        np.testing.assert_allclose(own["ema_200"], [np.nan if v is None else v for v in loop_average(x, 200, 2 / 201)], rtol=1e-12)


@pytest.mark.parametrize("seed", range(6))
def test_summaries_take_any_state_where_steps_do(seed):
    rng = np.random.default_rng(seed)
    engines = (ind.EmaFan((2, 9)), ind.Rma(3), ind.Macd(3, 3 + seed % 2, 3), ind.Rsi(4, 3), ind.Bollinger(5), ind.EmaFan((4,), "open"))
    x = {s: rng.normal(100, 3, 400) for s in ("close", "open")}
    for s in x:
        x[s][: rng.integers(0, 30)] = np.nan
    if seed % 3 == 2:
        x["close"][300] = np.nan
    whole = ind.Stepper(engines).step(x)
    edges = np.unique(np.concatenate([[0, 400], rng.integers(0, 400, 12)]))
    summed = ind.Stepper(engines)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        part = {s: v[lo:hi] for s, v in x.items()}
        made = ind.Stepper(engines, summed.flat()).step(part)
        for name, column in made.items():
            np.testing.assert_allclose(column, whole[name][lo:hi], rtol=1e-11, atol=1e-11, err_msg=f"{name} {lo}")
        summed.take(ind.Stepper(engines).summary(part))

import numpy as np
import pytest
from helpers import DAY, HOUR, JAN_2024, candles, loop_average, walk
from pyspark.sql import functions as F

from candlewright.operators import export, indicators
from candlewright.schema import CANDLES
from candlewright.sources.store import CandleStore
from candlewright.sources.tables import candles_from_ticks, micros, tick_order
from candlewright.streaming import live


def test_stream_emits_closed_slots_as_batch_has_them(spark, tmp_path):
    ticks = spark.range(500).select(F.col("id"), F.concat(F.lit("s"), (F.col("id") % 2)).alias("sym"), F.timestamp_millis(F.lit(JAN_2024) + F.col("id") * 300_000).cast("timestamp_ntz").alias("at"), (F.col("id") % 17).cast("double").alias("p"))
    ticks.coalesce(1).write.parquet(f"{tmp_path}/ticks")
    stream = spark.readStream.schema(ticks.schema).parquet(f"{tmp_path}/ticks")
    made = live.stream_candles(stream, F.col("sym"), F.col("at"), F.col("p"), F.lit(1), tick_order(micros(F.col("at")), F.col("id")), 11)
    store = CandleStore(spark, f"file://{tmp_path}/store").create()
    live.start(made, store, f"{tmp_path}/checkpoint").awaitTermination()
    live.start(made, store, f"{tmp_path}/checkpoint").awaitTermination()  # nothing new: nothing happens
    from candlewright.functions.time import millis

    batch = candles_from_ticks(ticks, F.col("sym"), millis(F.col("at")), F.col("p"), F.lit(1), tick_order(micros(F.col("at")), F.col("id")), 11)
    last = batch.agg(F.max("ts")).first()[0]
    want = sorted(map(tuple, batch.where(F.col("ts") + 660_000 <= last).collect()))
    assert sorted(map(tuple, store.scan().collect())) == want and len(want) > 200


def test_tick_order_is_by_time_then_number(spark):
    big = 2**63 - 1
    rows = [(us, tie) for us in (-5, 0, 1, 1_700_000_000_000_000) for tie in (-big, -1, 0, big)]
    df = spark.createDataFrame(rows, "us long, tie long").select("us", "tie", tick_order(F.col("us"), F.col("tie")).alias("o"))
    assert [(r.us, r.tie) for r in df.orderBy("o").collect()] == sorted(rows)
    plan = candles_from_ticks(df, F.lit("s"), F.col("us"), F.col("tie"), F.lit(1), F.col("o"), 60)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


ENGINES = (indicators.EmaFan((9,)), indicators.Macd(4, 9, 3), indicators.Rsi(5, 4), indicators.Bollinger(6))


def streamed(spark, tmp_path, batches, hold_ms=0, engines=ENGINES):
    """What a stream of these batches emits, each a run of its own over one checkpoint."""
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/bars")
        made = live.live_features(spark.readStream.schema(CANDLES).parquet(f"{tmp_path}/bars"), engines, hold_ms)
        made.writeStream.option("checkpointLocation", f"{tmp_path}/ck").option("path", f"{tmp_path}/out").format("parquet").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out").orderBy("ts", "late").toPandas()


def bars(spark, xs, lo, hi):
    return candles(spark, [(JAN_2024 + i * DAY, 0, 0, 0, xs[i], 1) for i in range(lo, hi)])


def test_live_indicators_over_batches(spark, tmp_path):
    xs = walk(120)
    got = streamed(spark, tmp_path, [bars(spark, xs, 40 * k, 40 * k + 40).orderBy(F.desc("ts")) for k in range(3)])
    want = indicators.with_features(bars(spark, xs, 0, 120), ENGINES).orderBy("ts").toPandas()
    assert len(got) == 120 and not got.late.any() and [None if x != x else x for x in got["ema_9"]] == loop_average(xs, 9, 0.2)
    for c in indicators.feature_names(ENGINES)[5:]:
        np.testing.assert_allclose(got[c], want[c], rtol=1e-12, equal_nan=True, err_msg=c)


def test_a_late_file_is_named_and_changes_nothing(spark, tmp_path):
    xs = walk(90)
    got = streamed(spark, tmp_path, [bars(spark, xs, 0, 30), bars(spark, xs, 60, 90), bars(spark, xs, 30, 60)])
    late, kept = got[got.late], got[~got.late]
    assert len(late) == 30 and late[indicators.feature_names(ENGINES)[5:]].isna().all().all() and list(late.close) == xs[30:60]
    known = candles(spark, [(JAN_2024 + i * DAY, 0, 0, 0, xs[i], 1) for i in [*range(30), *range(60, 90)]])
    want = indicators.with_features(known, ENGINES).orderBy("ts").toPandas()
    np.testing.assert_allclose(kept["ema_9"], want["ema_9"], rtol=1e-12, equal_nan=True)


def test_held_back_candles_leave_in_order(spark, tmp_path):
    xs = walk(91)
    got = streamed(spark, tmp_path, [bars(spark, xs, 0, 30), bars(spark, xs, 60, 90), bars(spark, xs, 30, 60), bars(spark, xs, 90, 91)], hold_ms=60 * DAY)
    want = indicators.with_features(bars(spark, xs, 0, 91), ENGINES).orderBy("ts").toPandas()
    assert not got.late.any() and len(got) == 31  # those that are 60 days older than the newest one
    for c in indicators.feature_names(ENGINES)[5:]:
        np.testing.assert_allclose(got[c], want[c][:31], rtol=1e-12, equal_nan=True, err_msg=c)


def test_a_hole_ends_live_averages(spark, tmp_path):
    xs = [None, 1.0, 3.0, 4.0, float("inf"), 5.0, 6.0, 7.0, 8.0]
    rows = [candles(spark, [(JAN_2024 + i * DAY, 0, 0, 0, xs[i], 1) for i in part]) for part in (range(4), range(4, 5), range(5, 9))]
    got = streamed(spark, tmp_path, rows, engines=(indicators.EmaFan((2,)), indicators.Bollinger(2)))
    assert [None if x != x else x for x in got["ema_2"]] == [None, None, 2.0, 4.0 * (2 / 3) + 2.0 * (1 - 2 / 3), *[None] * 5]
    assert [None if x != x else x for x in got["bb_basis"]] == [None, None, 2.0, 3.5, None, None, 5.5, 6.5, 7.5]


def test_tensors_share_the_block(spark):
    torch = pytest.importorskip("torch")
    f = indicators.with_features(candles(spark, [(JAN_2024 + i * HOUR, 0, 0, 0, float(i), 1) for i in range(12)], 60), (indicators.EmaFan((3,)),))
    made = export.tensors(export.entry(f, ("m", "c", "S", 60), ["close", "ema_3"]))
    assert torch.equal(made["block"][:, 0], made["close"]) and made["block"].dtype == torch.float64 and len(made["timestamp"]) == 12


def test_tensors_are_views_of_the_entry(spark, monkeypatch):
    import sys
    import types

    # Stands for torch where it is not installed: what it would get are the entry's own arrays.
    monkeypatch.setitem(sys.modules, "torch", types.SimpleNamespace(from_numpy=lambda a: a))
    f = indicators.with_features(candles(spark, [(JAN_2024 + i * HOUR, 0, 0, 0, float(i), 1) for i in range(12)], 60), (indicators.EmaFan((3,)),))
    entry = export.entry(f, ("m", "c", "S", 60), ["close", "ema_3"])
    made = export.tensors(entry)
    assert made["names"] == ["close", "ema_3"] and np.shares_memory(made["block"], entry["feat"]) and np.shares_memory(made["ema_3"], entry["feat"])
    assert list(made["close"]) == list(range(12)) and made["timestamp"].dtype == np.int64 and len(made["timestamp"]) == 12


def test_until_complete():
    left = [5, 3, 1, 1]
    assert live.until_complete(lambda: left[0], lambda: left.pop(0)) == 1
    assert live.until_complete(lambda: 0, lambda: None) == 0


def test_export(spark):
    xs = walk(50)
    f = indicators.with_features(candles(spark, [(JAN_2024 + i * HOUR, 0, 0, 0, x, 1) for i, x in enumerate(xs)], 60), (indicators.EmaFan((9,)),))
    e = export.entry(f, ("m", "c", "S", 60), ["close", "ema_9"])
    assert e["feat"].shape == (50, 2) and list(e["feat"][:, 0]) == xs and np.isnan(e["feat"][:8, 1]).all() and not np.isnan(e["feat"][8:, 1]).any()
    assert export.windows_of(e, 10).shape == (41, 10, 2) and export.windows_of(e, 60).shape == (0, 60, 2)
    got = export.blocks(f, ["close", "ema_9"], rows=20).orderBy("block").collect()
    assert [r.n for r in got] == [20, 20, 10]
    np.testing.assert_array_equal(np.concatenate([np.frombuffer(r.data).reshape(-1, 2) for r in got]), e["feat"])
    with pytest.raises(ValueError):
        export.entry(f, ("m", "c", "S", 60), ["block"])

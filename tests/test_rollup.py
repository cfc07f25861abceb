import datetime as dt

import pytest
from helpers import DAY, HOUR, JAN_2024, candles, daily

from candlewright.operators import rollup as r


def bars(df):
    return [(x.ts, x.open, x.high, x.low, x.close, x.volume) for x in df.orderBy("symbol", "ts").collect()]


def ms(*args):
    return int(dt.datetime(*args, tzinfo=dt.UTC).timestamp() * 1000)


def test_two_days_make_a_bar(spark):
    got = bars(r.rollup(candles(spark, daily(6)), 1440, 2880))
    assert got == [(JAN_2024 + 2 * i * DAY, 100 + 2 * i, 201 + 2 * i, 49 - 2 * i, 151 + 2 * i, 21 + 4 * i) for i in range(3)]


def test_open_slot_waits(spark):
    assert len(bars(r.rollup(candles(spark, daily(5)), 1440, 2880))) == 2
    assert len(bars(r.rollup(candles(spark, daily(6)), 1440, 2880, now_ms=JAN_2024 + 4 * DAY))) == 2


def test_a_gap_inside_a_slot_is_no_matter(spark):
    got = bars(r.rollup(candles(spark, daily(6, skip={2})), 1440, 2880))
    assert got[1] == (JAN_2024 + 2 * DAY, 103, 203, 47, 153, 13)


def test_repeated_candles_count_once(spark):
    rows = daily(2)
    assert bars(r.rollup(candles(spark, [*rows, rows[0]]), 1440, 2880))[0][5] == 21


def test_nothing_from_nothing(spark):
    assert bars(r.rollup(candles(spark, []), 1440, 2880)) == []
    assert bars(r.rollup(candles(spark, daily(4)), 1440, 0)) == []
    assert bars(r.rollup(candles(spark, daily(4)), 60, 2880)) == []


@pytest.mark.parametrize(("year", "full", "rest"), [(2024, 183, 0), (2025, 182, 1)])
def test_year_anchor_and_short_last_slot(spark, year, full, rest):
    start = ms(year, 1, 1)
    days = (dt.date(year + 1, 1, 1) - dt.date(year, 1, 1)).days
    rows = [(start + i * DAY, 1, 1, 1, 1, 1) for i in range(days + 2)]
    got = bars(r.rollup(candles(spark, rows), 1440, 2880))
    own = [b for b in got if b[0] < ms(year + 1, 1, 1)]
    assert len(own) == full + rest
    assert own[-1][5] == (1 if rest else 2)
    assert got[-1][0] == ms(year + 1, 1, 1)


def test_short_slot_closes_with_its_year(spark):
    start = ms(2025, 12, 1)
    rows = [(start + i * DAY, 1, 1, 1, 1, 1) for i in range(31)]
    last = bars(r.rollup(candles(spark, rows), 1440, 2880))[-1]
    assert last[0] == ms(2025, 12, 31) and last[5] == 1


@pytest.mark.parametrize(("minutes", "per_day", "last"), [(11, 131, 10), (45, 32, 45), (90, 16, 90), (1000, 2, 440)])
def test_day_anchor(spark, minutes, per_day, last):
    rows = [(JAN_2024 + i * 60_000, 1, 1, 1, 1, 1) for i in range(2880)]
    got = bars(r.rollup(candles(spark, rows, 1), 1, minutes))
    assert len(got) == 2 * per_day
    assert got[per_day - 1][5] == last and got[per_day][0] == JAN_2024 + DAY


def test_before_1970(spark):
    rows = [(-2 * DAY + i * HOUR, 1, 1, 1, 1, 1) for i in range(48)]
    got = bars(r.rollup(candles(spark, rows, 60), 60, 1440))
    assert [b[0] for b in got] == [-2 * DAY, -DAY]


def test_chain_is_made_in_order(spark):
    rows = [(JAN_2024 + i * HOUR, i, i + 1, i - 1, i, 1) for i in range(24)]
    got = r.rollup_many(candles(spark, rows, 60), [(180, 360), (60, 180)])
    assert {(x.timeframe_minutes, x.n) for x in got.groupBy("timeframe_minutes").count().withColumnRenamed("count", "n").collect()} == {(180, 8), (360, 4)}
    assert bars(got.where("timeframe_minutes = 360")) == bars(r.rollup(candles(spark, rows, 60), 60, 360))
    assert r.layers([(180, 360), (60, 180), (60, 120)]) == [(60, 120), (60, 180), (180, 360)]
    with pytest.raises(ValueError):
        r.layers([(60, 120), (120, 60)])


def test_incremental_is_a_part_of_the_whole(spark):
    rows = [(JAN_2024 + i * HOUR, i, i + 1, i - 1, i, 1) for i in range(96)]
    whole = bars(r.rollup(candles(spark, rows, 60), 60, 360))
    lo, hi = JAN_2024 + 24 * HOUR, JAN_2024 + 48 * HOUR
    assert bars(r.incremental_rollup(candles(spark, rows, 60), 60, 360, lo, hi)) == [b for b in whole if lo <= b[0] <= hi]
    assert bars(r.incremental_rollup(candles(spark, rows, 60), 60, 360, hi, lo)) == []


def test_first_of_key_takes_the_first_arrival(spark):
    from pyspark.sql import functions as F

    df = candles(spark, [(0, 1, 1, 1, 1, 1), (0, 2, 2, 2, 2, 2)]).withColumn("n", F.col("open"))
    assert bars(r.first_of_key(df, F.col("n")))[0][1] == 1 and bars(r.first_of_key(df, -F.col("n")))[0][1] == 2


def test_slot_series(spark):
    b = spark.createDataFrame([(ms(2024, 12, 31), ms(2025, 1, 2))], "start_ts long, end_ts long")
    assert r.slot_series(b, 11).count() == 2 * 131
    spans = sorted((x.slot_start, x.slot_end) for x in r.slot_series(spark.createDataFrame([(ms(2025, 12, 30), ms(2026, 1, 3))], "start_ts long, end_ts long"), 2880).collect())
    assert spans[-2:] == [(ms(2025, 12, 31), ms(2026, 1, 1)), (ms(2026, 1, 1), ms(2026, 1, 3))]
    assert r.slot_series(spark.createDataFrame([(5, 1)], "start_ts long, end_ts long"), 60).count() == 0


def test_one_shuffle_of_the_candles(spark):
    plan = r.rollup(candles(spark, daily(6)), 1440, 2880)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3  # candles by slot, and the two sides' few rows by series
    assert "REPARTITION_BY_COL" in plan

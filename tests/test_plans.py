"""How often plans read their source and shuffle."""

import re

import pytest
from helpers import DAY, HOUR, JAN_2024, candles
from pyspark.sql import functions as F

from candlewright.operators import gaps, indicators, intervals, rollup
from candlewright.schema import SERIES
from candlewright.sources import store, tables


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def count(df, what):
    return len(re.findall(what, plan(df)))


def stored(spark, tmp_path, n=300, minutes=60):
    candles(spark, [(JAN_2024 + i * HOUR, i, i + 1, i - 1, i, 1) for i in range(n)], minutes).write.parquet(f"file://{tmp_path}/c")
    return spark.read.parquet(f"file://{tmp_path}/c")


def test_a_chain_of_roll_ups_does_not_grow_with_its_levels(spark, tmp_path):
    c = stored(spark, tmp_path)
    one, three = (rollup.rollup_many(c, t) for t in ([(60, 180)], [(60, 180), (180, 360), (360, 1440)]))
    assert count(one, "FileScan|Scan parquet") == 1 and count(three, "FileScan|Scan parquet") == 3
    assert count(three, "Exchange hashpartitioning") == 0
    assert {r.timeframe_minutes: r["count"] for r in three.groupBy("timeframe_minutes").count().collect()} == {180: 100, 360: 50, 1440: 12}
    assert sorted(map(tuple, three.where("timeframe_minutes = 360").collect())) == sorted(map(tuple, rollup.rollup(c, 60, 360).collect()))


def test_stored_candles_are_summed_up_before_the_shuffle(spark, tmp_path):
    c = stored(spark, tmp_path)
    plain, unique = rollup.rollup(c, 60, 360, dedup=False), rollup.rollup(c, 60, 360)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, unique.collect()))
    assert "REPARTITION_BY_COL" not in plan(plain) and "REPARTITION_BY_COL" in plan(unique)


def test_interval_membership_is_one_sort(spark, tmp_path):
    c = stored(spark, tmp_path)
    spans = c.where("ts % 7 = 0").select(*SERIES, F.col("ts").alias("start_ts"), (F.col("ts") + 9 * DAY).alias("end_ts"))
    made = intervals.in_intervals(c, spans)
    assert "Join" not in plan(made) and count(made, "Exchange hashpartitioning") == 1 and count(made, "Sort ") == 1


def test_overlapping_intervals_and_null_keys(spark):
    rows = candles(spark, [(i * DAY, 1, 1, 1, 1, 1) for i in range(-400, 400, 7)])
    spans = [("m", "c", "S", 1440, a * DAY, b * DAY) for a, b in ((-300, 200), (-310, -305), (150, 160), (300, 290), (330, 330), (336, 343))] + [("m", "c", None, 1440, 0, 9 * DAY), ("m", "c", "T", 1440, 0, 9 * DAY)]
    df = spark.createDataFrame(spans, "market string, category string, symbol string, timeframe_minutes int, start_ts long, end_ts long")
    got = sorted(r.ts // DAY for r in intervals.in_intervals(rows, df).collect())
    want = [d for d in range(-400, 400, 7) if any(a <= d <= b for a, b in ((-300, 200), (-310, -305), (330, 330), (336, 343)))]
    assert got == want


def test_runs_inside_a_bucket_stay_out_of_the_second_pass(spark, monkeypatch):
    monkeypatch.setattr(gaps, "BUCKET", 10)
    missing = [d for d in range(100) if d % 3 and d not in (40, 41)] + list(range(100, 135)) + [137]
    got = gaps.merge_intervals(candles(spark, [(d * DAY, 1, 1, 1, 1, 1) for d in missing]), 1440).orderBy("start_ts").collect()
    want = []
    for d in missing:
        if want and want[-1][1] == d - 1:
            want[-1][1:] = [d, want[-1][2] + 1]
        else:
            want.append([d, d, 1])
    assert [[r.start_ts // DAY, r.end_ts // DAY, r.n] for r in got] == want


def test_long_ranges_are_made_by_many_tasks(spark):
    bounds = spark.createDataFrame([("m", "c", "S", 0, 400_000 * 60_000)], "market string, category string, symbol string, start_ts long, end_ts long")
    for made in (gaps.expected(bounds, 1), rollup.slot_series(bounds, 11)):
        assert made.select(F.spark_partition_id()).distinct().count() >= 4


def final(df):
    df.write.format("noop").mode("overwrite").save()
    grouped = df.groupBy().agg(*[F.count(c) for c in df.columns])
    grouped.collect()
    return plan(grouped)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_features_shuffle_the_bars_once(spark, tmp_path, broadcast):
    c = stored(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for engines in ((indicators.Bollinger(),), indicators.DEFAULT_ENGINES):
            text = final(indicators.with_features(c, engines, chunk=50))
            assert len(re.findall("FileScan|Scan parquet", text)) == 1
            wide = [x for x in text.split("\n") if re.search(r"\+- Exchange hashpartitioning", x) and "_bucket" in x and "REPARTITION_BY_COL" in x]
            assert len(wide) == 1 and text.count("ReusedExchange") == 1
            # Beside it only rows of buckets are shuffled: by series, and to their buckets where they are too many to broadcast.
            assert len(re.findall(r"\+- Exchange hashpartitioning", text)) == (2 if broadcast == "10m" else 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_series_reports_shuffle_little(spark, tmp_path):
    c = stored(spark, tmp_path)
    assert count(gaps.overview(c), "FileScan|Scan parquet") == 1 and count(gaps.overview(c), "Exchange hashpartitioning") == 2
    ends = store.head_tail(c, 3)
    assert count(ends, "FileScan|Scan parquet") == 1 and count(ends, "Exchange hashpartitioning") == 2
    text = final(gaps.breaks(c))
    assert len(re.findall("FileScan|Scan parquet", text)) == 1 and len(re.findall(r"\+- Exchange hashpartitioning", text)) == 2


def test_line_items_are_hashed(spark):
    made = tables.lineitem_candles(spark, "/root/testdata/sf0.001")
    assert "SortAggregate" not in plan(made) and "HashAggregate" in plan(made)

from helpers import DAY, HOUR, JAN_2024, candles
from pyspark.sql import functions as F

from candlewright.operators import gaps
from candlewright.sources import store as st


def make(spark, tmp_path):
    return st.CandleStore(spark, f"file://{tmp_path}/store").create()


def hourly(n, base=93_000.0):
    return [(1735689600000 + i * HOUR, base + i, base + 500 + i, base - 500 + i, base + 250 + i, 1.5 + i) for i in range(n)]


def rows(df):
    return [tuple(r)[4:] for r in df.orderBy("symbol", "ts").collect()]


def test_round_trip_order_and_precision(spark, tmp_path):
    s = make(spark, tmp_path)
    assert not s.exists() and s.scan().count() == 0
    data = hourly(30)
    counts = s.write(candles(spark, data[::-1], 60)).collect()
    assert s.exists() and counts[0].n == 30
    assert rows(s.scan()) == [(r[0], *map(float, r[1:])) for r in data]
    got = s.query(("m", "c", "S", 60), data[0][0], data[-1][0] + 1).collect()
    assert [r.ts for r in got] == [r[0] for r in data]
    cents = candles(spark, [(0, 1, 1, 1, 131072.01, 1), (HOUR, 1, 1, 1, 131072.02, 1)], 60, "C")
    s.write(cents)
    assert len({r.close for r in s.scan(series=[("m", "c", "C", 60)]).collect()}) == 2


def test_range_is_half_open_and_prunes_columns(spark, tmp_path):
    s = make(spark, tmp_path)
    data = hourly(10)
    s.write(candles(spark, data, 60))
    got = s.query(("m", "c", "S", 60), data[2][0], data[5][0], ["close"])
    assert got.columns == ["ts", "close"] and [r.ts for r in got.collect()] == [r[0] for r in data[2:5]]
    assert s.query(("m", "c", "none", 60), 0, 10).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "volume" not in plan.split("ReadSchema")[1]


def test_repeats_within_and_between_batches(spark, tmp_path):
    from pyspark.sql import functions as F

    s = make(spark, tmp_path)
    batch = candles(spark, [(0, 1, 1, 1, 1, 1), (0, 2, 2, 2, 2, 2)], 60).withColumn("n", F.col("open"))
    assert s.write(batch, F.col("n")).first().n == 1
    assert rows(s.scan())[0][1] == 1
    s.write(candles(spark, [(0, 9, 9, 9, 9, 9), (HOUR, 3, 3, 3, 3, 3)], 60))
    assert [r[1] for r in rows(s.scan())] == [9, 3]


def test_null_keys_and_empty_batches(spark, tmp_path):
    s = make(spark, tmp_path)
    s.write(candles(spark, [(0, 1, 1, 1, 1, 1)], 60))
    assert s.write(candles(spark, [], 60)).count() == 0
    nulls = candles(spark, [(5, 1, 1, 1, 1, 1)], 60).selectExpr("market", "category", "CAST(NULL AS STRING) AS symbol", "timeframe_minutes", "ts", "open", "high", "low", "close", "volume")
    assert s.write(nulls).count() == 0
    assert s.scan().count() == 1


def test_compaction_keeps_the_rows(spark, tmp_path):
    s = make(spark, tmp_path)
    for i in range(4):
        s.write(candles(spark, hourly(24)[6 * i : 6 * i + 6], 60))
    before = rows(s.scan())
    s.compact()
    assert rows(s.scan()) == before and len(before) == 24
    assert len(s.scan().inputFiles()) == 1
    assert s.vacuum() == 0 and s.vacuum(0) == 3
    assert rows(s.scan()) == before and s.vacuum(0) == 0
    st.CandleStore(spark, f"file://{tmp_path}/none").compact()


def test_other_series_stay(spark, tmp_path):
    s = make(spark, tmp_path)
    s.write(candles(spark, hourly(5), 60, "A/b c"))
    s.write(candles(spark, hourly(3), 60, "B"))
    assert s.scan(series=[("m", "c", "A/b c", 60)]).count() == 5 and s.scan().count() == 8


def test_multi_range_watermarks_and_fetch_intervals(spark):
    c = candles(spark, [(i * DAY, 1, 1, 1, 1, 1) for i in range(1, 6)])
    assert [r.ts // DAY for r in st.at_or_from(c, DAY, 4 * DAY).orderBy("ts").collect()] == [1, 4, 5]
    assert [r.ts // DAY for r in st.at_or_from(c, 4 * DAY, 3 * DAY).orderBy("ts").collect()] == [3, 4, 5]
    marks = st.watermarks(c)
    assert (marks.first().min_ts, marks.first().max_ts) == (DAY, 5 * DAY)
    assert sorted((r.start_ts, r.end_ts) for r in st.intervals_to_fetch(marks, 0, 9 * DAY).collect()) == [(0, DAY - 1), (5 * DAY + 1, 9 * DAY)]
    assert st.intervals_to_fetch(marks, DAY, 5 * DAY).count() == 0


def test_head_and_tail(spark):
    c = candles(spark, [(JAN_2024 + i * DAY, i, i, i, i, 1) for i in range(7)])
    assert [(int(r.open), r.part) for r in st.head_tail(c, 2).orderBy("ts").collect()] == [(0, "head"), (1, "head"), (5, "tail"), (6, "tail")]
    assert st.head_tail(c, 5).count() == 7


def files(tmp_path):
    return {p: p.stat().st_size for p in (tmp_path / "store/snapshots").rglob("*.parquet")}


def test_an_upsert_rewrites_one_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "RANGE_BARS", 100)
    s = make(spark, tmp_path)
    s.write(candles(spark, hourly(1000), 60))
    before = files(tmp_path)
    assert len(before) in (10, 11)
    s.write(candles(spark, [(1735689600000 + 555 * HOUR, 1, 1, 1, 1, 1)], 60))
    new = [n for p, n in files(tmp_path).items() if p not in before]
    assert len(new) == 1 and new[0] < 0.3 * sum(before.values())
    got = rows(s.scan())
    assert len(got) == 1000 and got[555][1:] == (1.0,) * 5
    (mark,) = s.marks().collect()
    assert (mark.n, mark.min_ts, mark.max_ts) == (1000, got[0][0], got[-1][0]) and s.series() == [("m", "c", "S", 60)]
    assert len(s.query(("m", "c", "S", 60), got[550][0], got[560][0]).inputFiles()) == 1


def test_two_writers_of_one_range_lose_nothing(spark, tmp_path, monkeypatch):
    a, b = make(spark, tmp_path), make(spark, tmp_path)
    a.write(candles(spark, hourly(2), 60))
    point, late = a._point, [candles(spark, hourly(6)[4:], 60), candles(spark, hourly(3, 1.0)[2:], 60, "T")]

    def slow(seen, changes, new):
        if late:
            b.write(late.pop(0))  # another writer comes first
        point(seen, changes, new)

    monkeypatch.setattr(a, "_point", slow)
    a.write(candles(spark, hourly(4)[2:], 60))
    assert [r[0] for r in rows(b.scan(series=[("m", "c", "S", 60)]))] == [r[0] for r in hourly(6)]
    a.write(candles(spark, hourly(7)[6:], 60))  # the other one writes another series meanwhile
    assert b.scan().count() == 8 and len(st.numbers_in(spark, f"{a.root}/current")) == 5


def test_vacuum_leaves_a_snapshot_that_is_not_named_yet(spark, tmp_path):
    s = make(spark, tmp_path)
    s.write(candles(spark, hourly(2), 60))
    seen, _ = s._state()
    changes, _ = s._written(candles(spark, hourly(5), 60))
    assert s.vacuum(0) == 0
    s._point(seen, changes)
    assert s.scan().count() == 5 and s.vacuum(0) == 1 and s.scan().count() == 5


def test_the_log_is_whole_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "WHOLE_EVERY", 3)
    s = make(spark, tmp_path)
    for i in range(7):
        s.write(candles(spark, hourly(i + 1)[i:], 60, f"S{i % 2}"))
    assert "whole" in s._entry(6) and "whole" not in s._entry(7)
    assert s.scan().count() == 7 and len(s.series()) == 2


def test_a_vacuum_does_not_grow_with_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "WHOLE_EVERY", 4)
    s, calls = make(spark, tmp_path), []
    monkeypatch.setattr(st, "drop_path", lambda spark, path, f=st.drop_path: calls.append(path) or f(spark, path))
    made = []
    for _ in range(3):
        for i in range(9):
            s.write(candles(spark, hourly(3, float(i)), 60))
        calls.clear()
        assert s.vacuum(0) == 9 - (not made)
        made.append(len(calls))
        calls.clear()
        assert s.vacuum(0) == 0 and not calls  # nothing new, nothing done
        assert len(st.numbers_in(spark, f"{s.root}/current")) <= 4 and s.scan().count() == 3
    assert made[2] <= made[1] <= 1.25 * made[0]
    assert len(list((tmp_path / "store/snapshots").iterdir())) == 1


def test_old_pieces_stay_for_as_long_as_readers_need(spark, tmp_path):
    s = make(spark, tmp_path)
    for i in range(3):
        s.write(candles(spark, hourly(2, float(i)), 60))
    assert s.vacuum() == 0 and len(list((tmp_path / "store/snapshots").iterdir())) == 3
    assert s.vacuum(0) == 2


def test_gaps_are_found_without_candles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "RANGE_BARS", 100)
    s = make(spark, tmp_path)
    s.write(candles(spark, [r for i, r in enumerate(hourly(300)) if i % 7], 60))
    s.write(candles(spark, [r for i, r in enumerate(hourly(300)) if i in (7, 14, 155)], 60))
    bounds = s.marks().select("market", "category", "symbol", F.col("min_ts").alias("start_ts"), F.col("max_ts").alias("end_ts"))
    made = gaps.missing_from_bitmaps(bounds, s.presence(60), 60, 100)
    assert made.inputFiles() and all("/presence/" in f for f in made.inputFiles())
    want = gaps.missing_intervals(bounds, s.scan(), 60)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.select(made.columns).collect()))
    assert s.vacuum(0) == 2 and made.count() == 40

"""Every query of the engine by name, with the SQL that gives the same rows.

``E(tf)`` are candles of the events by event type, ``L(1d)`` daily candles of the line items by return flag, ``O(1d)``
daily candles of the orders by status. Prices that went through averages are rounded on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import moving
from candlewright.functions import time as t
from candlewright.operators import export, gaps, indicators, intervals, rollup
from candlewright.operators.series import numbered
from candlewright.plans import jobs
from candlewright.schema import CANDLES, DAY_MS, PRICES, SERIES, as_candles
from candlewright.sources import config, payloads, rest, store, tables
from candlewright.sources.files import app_folder
from candlewright.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


BAR = ["symbol", "ts", *PRICES]


# --- base relations -----------------------------------------------------------------------------------------------


def sql_events(minutes: int, name: str = "c") -> str:
    ms = minutes * 60000
    return f"""{name} AS (SELECT event_type AS symbol, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % {ms} AS ts, first(value ORDER BY ts, event_id) AS open, max(value) AS high,
    min(value) AS low, last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2)"""


SQL_LINES = """c AS (SELECT l_returnflag AS symbol, epoch_ms(l_shipdate) - epoch_ms(l_shipdate) % 86400000 AS ts,
    first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2)"""
SQL_ORDERS = """c AS (SELECT o_orderstatus AS symbol, epoch_ms(o_orderdate) - epoch_ms(o_orderdate) % 86400000 AS ts, first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS open,
    max(o_totalprice) AS high, min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2)"""
BAR_SQL = "symbol, ts, open, high, low, close, volume"


def events(spark: SparkSession, d: str, minutes: int) -> DataFrame:
    return tables.event_candles(spark, d, minutes)


def lines(spark: SparkSession, d: str) -> DataFrame:
    return tables.lineitem_candles(spark, d)


def by_symbol():
    return Window.partitionBy("symbol").orderBy("ts")


@query("candles_1h", f"WITH {sql_events(60)} SELECT {BAR_SQL} FROM c")
def candles_1h(spark, d):
    return events(spark, d, 60).select(BAR)


@query("candles_lineitem_1d", f"WITH {SQL_LINES} SELECT {BAR_SQL} FROM c")
def candles_lineitem_1d(spark, d):
    return lines(spark, d).select(BAR)


@query("candles_orders_1d", f"WITH {SQL_ORDERS} SELECT {BAR_SQL} FROM c")
def candles_orders_1d(spark, d):
    return tables.order_candles(spark, d).select(BAR)


SQL_BANDS = """CASE WHEN n >= 20 THEN round(m, 6) END AS bb_basis, CASE WHEN n >= 20 THEN round(m + 2 * s, 6) END AS bb_upper, CASE WHEN n >= 20 THEN round(m - 2 * s, 6) END AS bb_lower"""
SQL_FRAME = "count(close) OVER w AS n, avg(close) OVER w AS m, stddev_pop(close) OVER w AS s FROM c WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 19 PRECEDING)"


def _bands(df: DataFrame) -> DataFrame:
    return indicators.with_features(df, (indicators.Bollinger(),)).select("symbol", "ts", "close", *[F.round(c, 6).alias(c) for c in ("bb_basis", "bb_upper", "bb_lower")])


@query("candles_1h_bollinger", f"WITH {sql_events(60)} SELECT symbol, ts, close, {SQL_BANDS} FROM (SELECT *, {SQL_FRAME})")
def candles_1h_bollinger(spark, d):
    return _bands(events(spark, d, 60))


# --- roll-up ------------------------------------------------------------------------------------------------------


def sql_rollup(source: str, source_ms: int, minutes: int, out: str = "r") -> str:
    im = minutes * 60000
    if minutes <= 1440:
        anchor, end = "ts - ts % 86400000", "ts - ts % 86400000 + 86400000"
    else:
        year = "date_trunc('year', make_timestamp(ts * 1000))"
        anchor, end = f"epoch_ms({year})", f"epoch_ms({year} + INTERVAL 1 YEAR)"
    return f"""{out} AS (SELECT symbol, slot AS ts, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, sum(volume) AS volume
    FROM (SELECT *, a + ((ts - a) // {im}) * {im} AS slot, least(a + ((ts - a) // {im}) * {im} + {im}, e) AS slot_end, max(ts) OVER (PARTITION BY symbol) + {source_ms} AS reach
          FROM (SELECT *, {anchor} AS a, {end} AS e FROM {source}))
    WHERE slot_end <= reach GROUP BY symbol, slot)"""


for _name, _source, _minutes in (("11m", 1, 11), ("45m", 15, 45), ("90m", 30, 90)):
    query(f"candles_day_anchor_{_name}", f"WITH {sql_events(_source)}, {sql_rollup('c', _source * 60000, _minutes)} SELECT {BAR_SQL} FROM r")(
        lambda spark, d, s=_source, m=_minutes: rollup.rollup(events(spark, d, s), s, m).select(BAR)
    )
for _name, _minutes in (("2d", 2880), ("3d", 4320), ("8d", 11520)):
    query(f"candles_year_anchor_{_name}", f"WITH {SQL_LINES}, {sql_rollup('c', 86400000, _minutes)} SELECT {BAR_SQL} FROM r")(
        lambda spark, d, m=_minutes: rollup.rollup(lines(spark, d), 1440, m).select(BAR)
    )


@query(
    "rollup_chain_1h_3h_6h",
    f"WITH {sql_events(60)}, {sql_rollup('c', 3600000, 180)}, {sql_rollup('r', 10800000, 360, 'q')} SELECT 180 AS timeframe_minutes, {BAR_SQL} FROM r UNION ALL SELECT 360, {BAR_SQL} FROM q",
)
def rollup_chain(spark, d):
    return rollup.rollup_many(events(spark, d, 60), [(180, 360), (60, 180)]).select("timeframe_minutes", *BAR)


#: 2024 in the events' time: the slots that begin on the second and third of January.
FROM_MS, TO_MS = 1704153600000, 1704326399999


@query("rollup_incremental_6h", f"WITH {sql_events(60)}, {sql_rollup('c', 3600000, 360)} SELECT {BAR_SQL} FROM r WHERE ts BETWEEN {FROM_MS} AND {TO_MS}")
def rollup_incremental(spark, d):
    return rollup.incremental_rollup(events(spark, d, 60), 60, 360, FROM_MS, TO_MS).select(BAR)


@query("rollup_changed", f"WITH {sql_events(60)}, {sql_rollup('c', 3600000, 360)} SELECT {BAR_SQL} FROM r")
def rollup_changed(spark, d):
    """Roll-ups that follow a store's writes: a first part, then late candles and one series further on, built slot by slot."""
    c = events(spark, d, 60)
    s = store.CandleStore(spark, _folder(spark, "changed-store")).create()
    late = F.pmod(F.xxhash64("symbol", F.floor(F.col("ts") / (7 * DAY_MS))), F.lit(5)) == 0
    for part in (~late & (F.col("ts") < TO_MS), late & (F.col("ts") < TO_MS), F.col("ts") >= TO_MS):
        s.write(c.where(part))
        jobs.roll_up(s, [(60, 360)])
    return s.scan(F.col("timeframe_minutes") == 360).select(BAR)


def _bounds_sql(table: str = "c") -> str:
    return f"b AS (SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM {table} GROUP BY symbol)"


@query(
    "slot_series_8d",
    f"""WITH {SQL_LINES}, {_bounds_sql()}, y AS (SELECT symbol, lo, hi, unnest(range(year(make_timestamp(lo * 1000)), year(make_timestamp(hi * 1000)) + 1)) AS y FROM b),
    p AS (SELECT symbol, hi, epoch_ms(make_timestamp(y, 1, 1, 0, 0, 0)) AS a, epoch_ms(make_timestamp(y + 1, 1, 1, 0, 0, 0)) AS e FROM y),
    s AS (SELECT symbol, hi, e, unnest(range(a, e, 691200000)) AS slot_start FROM p)
    SELECT symbol, slot_start, least(slot_start + 691200000, e) AS slot_end FROM s WHERE least(slot_start + 691200000, e) <= hi""",
)
def slot_series_8d(spark, d):
    bounds = lines(spark, d).groupBy("symbol").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))
    return rollup.slot_series(bounds, 11520).select("symbol", "slot_start", "slot_end")


@query(
    "asof_slots",
    f"""WITH {sql_events(60)}, s AS (SELECT symbol, ts AS slot FROM c WHERE volume % 3 = 0)
    SELECT c.symbol, c.ts, s.slot AS slot_start FROM c ASOF JOIN s ON c.symbol = s.symbol AND c.ts >= s.slot""",
)
def asof_slots(spark, d):
    c = events(spark, d, 60)
    slots = c.where("volume % 3 = 0").select(*SERIES, F.col("ts").alias("slot_start"))
    return intervals.last_at_or_before(c, slots).where("slot_start IS NOT NULL").select("symbol", "ts", "slot_start")


# --- windows and recursive averages -------------------------------------------------------------------------------


@query("sma_20", f"WITH {SQL_LINES} SELECT symbol, ts, CASE WHEN n >= 20 THEN round(m, 6) END AS sma_20 FROM (SELECT *, {SQL_FRAME})")
def sma_20(spark, d):
    return lines(spark, d).select("symbol", "ts", F.round(moving.sma(F.col("close"), 20, by_symbol()), 6).alias("sma_20"))


@query("stdev_20", f"WITH {SQL_LINES} SELECT symbol, ts, CASE WHEN n >= 20 THEN round(s, 6) END AS stdev_20 FROM (SELECT *, {SQL_FRAME})")
def stdev_20(spark, d):
    return lines(spark, d).select("symbol", "ts", F.round(moving.stdev(F.col("close"), 20, by_symbol()), 6).alias("stdev_20"))


@query("bollinger", f"WITH {SQL_LINES} SELECT symbol, ts, close, {SQL_BANDS} FROM (SELECT *, {SQL_FRAME})")
def bollinger(spark, d):
    return _bands(lines(spark, d))


@query("change", f"WITH {SQL_LINES} SELECT symbol, ts, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts), 6) AS change FROM c")
def change(spark, d):
    return lines(spark, d).select("symbol", "ts", F.round(moving.change(F.col("close"), by_symbol()), 6).alias("change"))


def sql_recursion(averages: dict[str, tuple[str, int, float]], source: str = "n", rest: str = "") -> str:
    """CTEs ``name`` (symbol, rn, y): the seeded average of a column of ``source`` (symbol, rn, ...), bar by bar."""
    out = []
    for name, (column, length, alpha) in averages.items():
        out.append(f"""{name}_v AS MATERIALIZED (SELECT symbol, rn, {column} AS x, row_number() OVER (PARTITION BY symbol ORDER BY rn) AS k FROM {source} WHERE {column} IS NOT NULL),
    {name} AS (SELECT symbol, max(rn) AS rn, {length} AS k, sum(x ORDER BY k) / {length} AS y FROM {name}_v WHERE k <= {length} GROUP BY symbol HAVING count(*) = {length}
        UNION ALL SELECT v.symbol, v.rn, v.k, {alpha!r} * v.x + (1 - {alpha!r}) * e.y FROM {name} e JOIN {name}_v v ON v.symbol = e.symbol AND v.k = e.k + 1)""")
    return ",\n".join(out) + rest


NUMBERED = "n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM c)"
FAN = {f"ema_{n}": ("close", n, 2.0 / (n + 1)) for n in (9, 26, 50, 100, 200)}
FAN_COLUMNS = ", ".join(f"round({n}.y, 6) AS {n}" for n in FAN)
FAN_JOINS = " ".join(f"LEFT JOIN {n} ON {n}.symbol = n.symbol AND {n}.rn = n.rn" for n in FAN)


def _features(df: DataFrame, *engines: indicators.Engine) -> DataFrame:
    names = [n for e in engines for n in e.names()]
    return indicators.with_features(df, engines).select("symbol", "ts", *[F.round(n, 6).alias(n) for n in names])


@query("ema_fan", f"WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {sql_recursion(FAN)} SELECT n.symbol, n.ts, {FAN_COLUMNS} FROM n {FAN_JOINS}")
def ema_fan(spark, d):
    return _features(lines(spark, d), indicators.EmaFan())


@query(
    "rma_14",
    f"WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {sql_recursion({'rma_14': ('close', 14, 1 / 14)})} SELECT n.symbol, n.ts, round(rma_14.y, 6) AS rma_14 FROM n LEFT JOIN rma_14 ON rma_14.symbol = n.symbol AND rma_14.rn = n.rn",
)
def rma_14(spark, d):
    return _features(lines(spark, d), indicators.Rma())


SQL_HOLES = """g AS MATERIALIZED (SELECT * EXCLUDE (close), CASE WHEN symbol = 'N' AND ts < 794880000000 OR symbol <> 'A' AND ts // 86400000 % 1500 = CASE WHEN symbol = 'N' THEN 700 ELSE 1000 END THEN NULL ELSE close END AS close FROM n),
    f AS (SELECT symbol, min(rn) AS rn FROM g WHERE close IS NOT NULL GROUP BY symbol),
    h AS (SELECT g.symbol, min(g.rn) AS rn FROM g JOIN f ON f.symbol = g.symbol AND g.rn > f.rn WHERE g.close IS NULL GROUP BY g.symbol),
    o AS MATERIALIZED (SELECT g.symbol, g.rn, g.ts, CASE WHEN h.rn IS NULL OR g.rn < h.rn THEN g.close END AS x FROM g LEFT JOIN h ON h.symbol = g.symbol)"""


@query(
    "ema_with_hole",
    f"WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {SQL_HOLES}, {sql_recursion({'ema_9': ('x', 9, 0.2)}, 'o')} SELECT o.symbol, o.ts, round(ema_9.y, 6) AS ema_9 FROM o LEFT JOIN ema_9 ON ema_9.symbol = o.symbol AND ema_9.rn = o.rn",
)
def ema_with_hole(spark, d):
    """One series without holes, one with one, and one that begins late and has two; in chunks that holes lie before, in and after."""
    c = lines(spark, d)
    day = F.floor(F.col("ts") / 86_400_000) % 1500
    gone = ((F.col("symbol") == "N") & (F.col("ts") < 794_880_000_000)) | ((F.col("symbol") != "A") & (day == F.when(F.col("symbol") == "N", 700).otherwise(1000)))
    holed = c.withColumn("close", F.when(~gone, F.col("close")))
    return indicators.with_features(holed, (indicators.EmaFan((9,)),), chunk=512).select("symbol", "ts", F.round("ema_9", 6).alias("ema_9"))


MACD_CTES = f"""{sql_recursion({"fast": ("close", 12, 2.0 / 13), "slow": ("close", 26, 2.0 / 27)})},
    m AS MATERIALIZED (SELECT n.symbol, n.rn, n.ts, fast.y - slow.y AS macd FROM n LEFT JOIN fast ON fast.symbol = n.symbol AND fast.rn = n.rn LEFT JOIN slow ON slow.symbol = n.symbol AND slow.rn = n.rn),
    {sql_recursion({"sig": ("macd", 9, 2.0 / 10)}, "m")}"""
MACD_COLUMNS = "round(m.macd, 6) AS macd, round(sig.y, 6) AS macd_signal, round(m.macd - sig.y, 6) AS macd_hist"
RSI_CTES = f"""d AS MATERIALIZED (SELECT symbol, rn, ts, close - lag(close) OVER (PARTITION BY symbol ORDER BY rn) AS delta FROM n),
    u AS MATERIALIZED (SELECT *, CASE WHEN delta > 0 THEN delta WHEN delta IS NOT NULL THEN 0.0 END AS up, CASE WHEN delta < 0 THEN -delta WHEN delta IS NOT NULL THEN 0.0 END AS down FROM d),
    {sql_recursion({"ru": ("up", 14, 1 / 14), "rd": ("down", 14, 1 / 14)}, "u")},
    r AS (SELECT u.symbol, u.rn, u.ts, CASE WHEN rd.y = 0 THEN 100.0 WHEN ru.y = 0 THEN 0.0 ELSE 100 - 100 / (1 + ru.y / rd.y) END AS rsi
          FROM u LEFT JOIN ru ON ru.symbol = u.symbol AND ru.rn = u.rn LEFT JOIN rd ON rd.symbol = u.symbol AND rd.rn = u.rn),
    rs AS (SELECT *, CASE WHEN count(rsi) OVER w >= 14 THEN avg(rsi) OVER w END AS ma FROM r WINDOW w AS (PARTITION BY symbol ORDER BY rn ROWS 13 PRECEDING))"""


@query("macd", f"WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {MACD_CTES} SELECT m.symbol, m.ts, {MACD_COLUMNS} FROM m LEFT JOIN sig ON sig.symbol = m.symbol AND sig.rn = m.rn")
def macd(spark, d):
    return _features(lines(spark, d), indicators.Macd())


@query("rsi", f"WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {RSI_CTES} SELECT symbol, ts, round(rsi, 6) AS rsi_14, round(ma, 6) AS rsi_ma_14 FROM rs")
def rsi(spark, d):
    return _features(lines(spark, d), indicators.Rsi())


FEATURES_SQL = f"""WITH RECURSIVE {SQL_LINES}, {NUMBERED}, {sql_recursion(FAN)}, {MACD_CTES}, {RSI_CTES},
    b AS (SELECT symbol, rn, count(close) OVER w AS n, avg(close) OVER w AS m, stddev_pop(close) OVER w AS s FROM n WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 19 PRECEDING)),
    f AS (SELECT n.symbol, n.ts, n.rn, n.open, n.high, n.low, n.close, n.volume, {FAN_COLUMNS}, {MACD_COLUMNS}, round(rs.rsi, 6) AS rsi_14, round(rs.ma, 6) AS rsi_ma_14,
        CASE WHEN b.n >= 20 THEN round(b.m, 6) END AS bb_basis, CASE WHEN b.n >= 20 THEN round(b.m + 2 * b.s, 6) END AS bb_upper, CASE WHEN b.n >= 20 THEN round(b.m - 2 * b.s, 6) END AS bb_lower
    FROM n {FAN_JOINS} JOIN m ON m.symbol = n.symbol AND m.rn = n.rn LEFT JOIN sig ON sig.symbol = n.symbol AND sig.rn = n.rn
        JOIN rs ON rs.symbol = n.symbol AND rs.rn = n.rn JOIN b ON b.symbol = n.symbol AND b.rn = n.rn)"""


@query("feature_block", f"{FEATURES_SQL} SELECT * EXCLUDE (rn) FROM f")
def feature_block(spark, d):
    names = indicators.feature_names()[len(PRICES) :]
    return indicators.with_features(lines(spark, d)).select("symbol", "ts", *PRICES, *[F.round(n, 6).alias(n) for n in names])


@query(
    "first_bars",
    f"""{FEATURES_SQL}, l AS (SELECT symbol, ts, rn, unnest(['ema_9', 'ema_200', 'macd', 'macd_signal', 'rsi_14', 'rsi_ma_14', 'bb_basis']) AS feature,
    unnest([ema_9, ema_200, macd, macd_signal, rsi_14, rsi_ma_14, bb_basis]) AS v FROM f)
    SELECT symbol, feature, min(rn - 1) FILTER (WHERE v IS NOT NULL) AS first_bar, min(ts) FILTER (WHERE v IS NOT NULL) AS first_ts, last(v ORDER BY ts) AS last_value FROM l GROUP BY ALL""",
)
def first_bars(spark, d):
    f = indicators.with_features(lines(spark, d))
    out = indicators.first_bars(f, ["ema_9", "ema_200", "macd", "macd_signal", "rsi_14", "rsi_ma_14", "bb_basis"])
    return out.select("symbol", "feature", "first_bar", "first_ts", F.round("last_value", 6).alias("last_value"))


# --- gaps and intervals -------------------------------------------------------------------------------------------

SQL_EXPECTED = f"{_bounds_sql()}, e AS (SELECT symbol, unnest(range(lo, hi + 1, {{ms}})) AS ts FROM b), x AS (SELECT e.symbol, e.ts FROM e ANTI JOIN c ON c.symbol = e.symbol AND c.ts = e.ts)"
SQL_ISLANDS = "i AS (SELECT symbol, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n FROM (SELECT *, ts - {ms} * row_number() OVER (PARTITION BY symbol ORDER BY ts) AS g FROM x) GROUP BY symbol, g)"


def _bounds(c: DataFrame) -> DataFrame:
    return c.groupBy(*SERIES[:3]).agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


def _missing(c: DataFrame, minutes: int) -> DataFrame:
    return gaps.missing(gaps.expected(_bounds(c), minutes), c)


@query("missing_timestamps", f"WITH {sql_events(60)}, {SQL_EXPECTED.format(ms=3600000)} SELECT symbol, ts FROM x")
def missing_timestamps(spark, d):
    return _missing(events(spark, d, 60), 60).select("symbol", "ts")


@query("missing_intervals", f"WITH {SQL_ORDERS}, {SQL_EXPECTED.format(ms=86400000)}, {SQL_ISLANDS.format(ms=86400000)} SELECT symbol, start_ts, end_ts, n FROM i")
def missing_intervals(spark, d):
    return gaps.merge_intervals(_missing(tables.order_candles(spark, d), 1440), 1440).select("symbol", "start_ts", "end_ts", "n")


@query("missing_from_marks", f"WITH {SQL_ORDERS}, {SQL_EXPECTED.format(ms=86400000)}, {SQL_ISLANDS.format(ms=86400000)} SELECT symbol, start_ts, end_ts, n FROM i")
def missing_from_marks(spark, d):
    """The gaps of stored candles from the bitmaps that the store keeps with its watermarks; no candle is read."""
    s = store.CandleStore(spark, _folder(spark, "marked-store")).create()
    s.write(tables.order_candles(spark, d))
    bounds = s.marks().select(*SERIES[:3], F.col("min_ts").alias("start_ts"), F.col("max_ts").alias("end_ts"))
    return gaps.missing_from_bitmaps(bounds, s.presence(1440), 1440, store.RANGE_BARS).select("symbol", "start_ts", "end_ts", "n")


@query("missing_count", f"WITH {sql_events(15)}, {SQL_EXPECTED.format(ms=900000)} SELECT symbol, count(*) AS n_missing FROM x GROUP BY symbol")
def missing_count(spark, d):
    return gaps.missing_count(gaps.merge_intervals(_missing(events(spark, d, 15), 15), 15), 15).select("symbol", "n_missing")


SQL_BREAKS = "k AS (SELECT symbol, ts, next_ts FROM (SELECT symbol, ts, lead(ts) OVER (PARTITION BY symbol ORDER BY ts) AS next_ts FROM c) WHERE next_ts - ts > {ms})"


@query(
    "overview",
    f"""WITH {sql_events(15)}, {SQL_BREAKS.format(ms=900000)}, o AS (SELECT symbol, count(*) AS total, count(DISTINCT ts) AS n_distinct, min(ts) AS min_ts, max(ts) AS max_ts FROM c GROUP BY symbol)
    SELECT symbol, total, n_distinct, total - n_distinct AS n_dup, min_ts, max_ts, (max_ts - min_ts) // 900000 + 1 AS expected, (max_ts - min_ts) // 900000 + 1 - n_distinct AS missing,
    coalesce(g, 0) AS n_gaps FROM o LEFT JOIN (SELECT symbol, count(*) AS g FROM k GROUP BY symbol) USING (symbol)""",
)
def overview(spark, d):
    return gaps.overview(events(spark, d, 15)).drop("market", "category", "timeframe_minutes")


@query(
    "top_gaps",
    f"WITH {sql_events(15)}, {SQL_BREAKS.format(ms=900000)} SELECT symbol, ts, next_ts, next_ts - ts AS gap_ms, (next_ts - ts) // 900000 - 1 AS n_missing FROM k ORDER BY gap_ms DESC, ts, symbol LIMIT 10",
)
def top_gaps(spark, d):
    return gaps.top_gaps(events(spark, d, 15), 10).select("symbol", "ts", "next_ts", "gap_ms", "n_missing")


SQL_SPANS = "v AS (SELECT symbol, ts AS start_ts, ts + 7200000 * CAST(volume AS BIGINT) AS end_ts FROM c WHERE volume >= 3)"


def _spans(c: DataFrame) -> DataFrame:
    return c.where("volume >= 3").select(*SERIES, F.col("ts").alias("start_ts"), (F.col("ts") + 7200000 * F.col("volume").cast("long")).alias("end_ts"))


@query("interval_membership", f"WITH {sql_events(60)}, {SQL_SPANS} SELECT symbol, ts FROM c WHERE EXISTS (SELECT 1 FROM v WHERE v.symbol = c.symbol AND c.ts BETWEEN v.start_ts AND v.end_ts)")
def interval_membership(spark, d):
    c = events(spark, d, 60)
    return intervals.in_intervals(c, _spans(c)).select("symbol", "ts")


@query(
    "interval_widened",
    f"WITH {sql_events(60)}, v AS (SELECT symbol, ts AS start_ts, ts AS end_ts FROM c WHERE ts % 604800000 = 0) SELECT symbol, ts FROM c WHERE EXISTS (SELECT 1 FROM v WHERE v.symbol = c.symbol AND c.ts BETWEEN v.start_ts - 21600000 AND v.end_ts + 21600000)",
)
def interval_widened(spark, d):
    c = events(spark, d, 60)
    spans = c.where("ts % 604800000 = 0").select(*SERIES, F.col("ts").alias("start_ts"), F.col("ts").alias("end_ts"))
    return intervals.near_intervals(c, spans, 10_800_000).select("symbol", "ts")


# --- reads and writes ---------------------------------------------------------------------------------------------


@query("range_read", f"WITH {sql_events(60)} SELECT {BAR_SQL} FROM c WHERE ts >= {FROM_MS} AND ts < {TO_MS + 1}")
def range_read(spark, d):
    return store.in_range(events(spark, d, 60), FROM_MS, TO_MS + 1).select(BAR)


@query("multi_range_read", f"WITH {sql_events(60)} SELECT symbol, ts FROM c WHERE ts = {FROM_MS} OR ts >= {TO_MS + 1}")
def multi_range_read(spark, d):
    return store.at_or_from(events(spark, d, 60), FROM_MS, TO_MS + 1).select("symbol", "ts")


@query("ts_range", f"WITH {sql_events(60)} SELECT symbol, min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n FROM c GROUP BY symbol")
def ts_range(spark, d):
    return store.watermarks(events(spark, d, 60)).select("symbol", "min_ts", "max_ts", "n")


@query(
    "intervals_to_fetch",
    f"""WITH {sql_events(60)}, {_bounds_sql()} SELECT symbol, hi + 1 AS start_ts, {TO_MS * 2} AS end_ts FROM b WHERE hi + 1 <= {TO_MS * 2}
    UNION ALL SELECT symbol, 0, lo - 1 FROM b WHERE lo - 1 >= 0""",
)
def intervals_to_fetch(spark, d):
    return store.intervals_to_fetch(store.watermarks(events(spark, d, 60)), 0, TO_MS * 2).select("symbol", "start_ts", "end_ts")


def _tick_candles(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    at = t.floored(t.millis(F.col("ts")), 3_600_000)
    v = F.col("value")
    return e.select(F.lit("synthetic").alias("market"), F.lit("test").alias("category"), F.col("event_type").alias("symbol"), F.lit(60).alias("timeframe_minutes"), at.alias("ts"), v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"), F.lit(1.0).alias("volume"), "event_id")


SQL_TICKS = "k AS (SELECT event_type AS symbol, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 3600000 AS ts, value AS v, event_id FROM events)"


@query("dedup_first_wins", f"WITH {SQL_TICKS} SELECT symbol, ts, first(v ORDER BY event_id) AS open, first(v ORDER BY event_id) AS close FROM k GROUP BY symbol, ts")
def dedup_first_wins(spark, d):
    return store.first_wins(_tick_candles(spark, d), F.col("event_id")).select("symbol", "ts", "open", "close")


@query(
    "upsert_last_wins",
    f"""WITH {sql_events(60)}, s AS (SELECT symbol, ts + 7200000 AS ts, open + 1000 AS open, close + 1000 AS close FROM c)
    SELECT coalesce(s.symbol, c.symbol) AS symbol, coalesce(s.ts, c.ts) AS ts, coalesce(s.open, c.open) AS open, coalesce(s.close, c.close) AS close FROM c FULL JOIN s ON s.symbol = c.symbol AND s.ts = c.ts""",
)
def upsert_last_wins(spark, d):
    c = events(spark, d, 60)
    revised = as_candles(c.withColumn("ts", F.col("ts") + 7_200_000).withColumn("open", F.col("open") + 1000).withColumn("close", F.col("close") + 1000))
    return store.last_wins(c, revised).select("symbol", "ts", "open", "close")


@query("head_tail", f"WITH {sql_events(60)}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS a, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM c) SELECT {BAR_SQL}, CASE WHEN a <= 5 THEN 'head' ELSE 'tail' END AS part FROM n WHERE a <= 5 OR z <= 5")
def head_tail(spark, d):
    return store.head_tail(events(spark, d, 60), 5).select(*BAR, "part")


@query("bar_numbers", f"WITH {sql_events(15)} SELECT symbol, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS bar FROM c")
def bar_numbers(spark, d):
    return numbered(events(spark, d, 15)).select("symbol", "ts", "bar")


# --- configuration and payloads -----------------------------------------------------------------------------------

MARKETS = {
    "synthetic": {"active": True, "symbols_config": {"test": {"active": True, "symbols": {"click": {"active": True, "variants": {"click": {"active": True}, "CLK": {"active": False}, "Clk2": {}}}, "view": {"active": False, "variants": {}}, "purchase": {"active": True, "variants": {"PUR": {"active": True}}}}}}},
    "idle": {"active": False, "symbols_config": {"test": {"active": True, "symbols": {"signup": {"active": True, "variants": {}}}}}},
}
STANDARD = {k: {"minutes": m, "seconds": 60 * m, "active": k in ("1h", "1d", "3h"), "active_featured": k in ("1h", "3h")} | ({"hours": m // 60} if m >= 60 else {}) for k, m in config.STANDARD_MINUTES.items()}
CUSTOM = {"enable": True, "custom_intervals": {k: {"minutes": m, "source": s, "active": k != "22m", "active_featured": k in ("3h", "2d")} for k, (m, s) in config.CUSTOM_MINUTES.items()}}


@query("active_series", f"WITH {sql_events(60)} SELECT {BAR_SQL} FROM c WHERE symbol IN ('click', 'purchase')")
def active_series(spark, d):
    active = config.active_symbols(config.symbols(spark, MARKETS))
    frames = config.read_timeframes(config.timeframes(spark, STANDARD), config.custom_timeframes(spark, CUSTOM))
    return config.dimension_series(events(spark, d, 60), active, frames).select(BAR)


@query("build_tasks", "SELECT n_name AS name, CAST(n_nationkey * 15 + 15 AS INTEGER) AS minutes, '15m' AS source FROM nation WHERE n_nationkey % 2 = 0 AND NOT (n_nationkey % 3 = 0 AND n_nationkey % 4 = 0)")
def build_tasks(spark, d):
    """Custom timeframes named after the nations, of which every third is a standard one too and every fourth got data."""
    n = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("int").alias("k"))
    custom = n.select("name", (F.col("k") * 15 + 15).alias("minutes"), F.lit("15m").alias("source"), (F.col("k") % 2 == 0).alias("active"), F.lit(True).alias("active_featured"))
    standard = n.select("name", F.lit(15).alias("minutes"), (F.col("k") % 3 == 0).alias("active"), F.lit(False).alias("active_featured"))
    return config.build_tasks(custom, standard, n.select("name", (F.col("k") % 4 == 0).alias("has_data")))


@query(
    "symbol_variants",
    """WITH s AS (SELECT c_custkey AS k, 'Ab' || c_custkey AS v, 'aB' || (c_custkey % 3) AS w, CASE WHEN c_custkey % 4 = 0 THEN 'AB' || c_custkey END AS g FROM customer),
    t AS (SELECT k, unnest([g, v, w, upper(v), lower(v), upper(w), lower(w)]) AS x, unnest(range(7)) AS i FROM s)
    SELECT k AS c_custkey, string_agg(x, ' ' ORDER BY i) AS tried FROM (SELECT k, x, min(i) AS i FROM t WHERE x IS NOT NULL GROUP BY k, x) GROUP BY k""",
)
def symbol_variants(spark, d):
    k = F.col("c_custkey")
    variants = F.array(F.concat(F.lit("Ab"), k), F.concat(F.lit("aB"), k % 3))
    good = F.when(k % 4 == 0, F.concat(F.lit("AB"), k))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.array_join(config.tried_variants(variants, good), " ").alias("tried"))


@query(
    "timeframe_keys",
    """SELECT event_id, CAST(CASE event_id % 7 WHEN 0 THEN event_id % 90 WHEN 1 THEN event_id % 90 * 60 WHEN 2 THEN event_id % 90 * 1440 WHEN 3 THEN event_id % 90 * 10080 WHEN 4 THEN event_id % 90 * 44640
    ELSE -1 END AS INTEGER) AS minutes FROM events""",
)
def timeframe_keys(spark, d):
    """Keys of every unit, of no unit, and with the unit in front."""
    n, k = (F.col("event_id") % 90).cast("string"), F.col("event_id") % 7
    key = F.when(k == 6, F.concat(F.lit("h"), n)).otherwise(F.concat(n, F.element_at(F.array(*[F.lit(u) for u in ("m", "h", "d", "w", "M", "x")]), (F.least(k, F.lit(5)) + 1).cast("int"))))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.coalesce(t.timeframe_minutes(key).cast("int"), F.lit(-1)).alias("minutes"))


@query(
    "timeframe_text",
    """WITH e AS (SELECT event_id, 'tf' || event_id % 48 AS name, CASE WHEN event_id % 5 > 0 THEN event_id % 48 * 1800 END AS s, CASE WHEN event_id % 7 > 0 THEN event_id % 48 * 30 END AS m, CASE WHEN event_id % 3 > 0 THEN event_id % 48 // 2 END AS h FROM events)
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(coalesce(s, m * 60, h * 3600, 86400) AS VARCHAR) WHEN 1 THEN CAST(coalesce(m, h * 60, 1440) AS VARCHAR) WHEN 2 THEN CAST(coalesce(h, m // 60, 24) AS VARCHAR) ELSE name END AS shown FROM e""",
)
def timeframe_text(spark, d):
    """Timeframes in each style, with some of their units unknown."""
    i = F.col("event_id")
    n = i % 48
    style = F.element_at(F.array(*[F.lit(x) for x in ("seconds", "minutes", "hours", "default")]), (i % 4 + 1).cast("int"))
    shown = t.timeframe_text(F.concat(F.lit("tf"), n), F.when(i % 5 > 0, n * 1800), F.when(i % 7 > 0, n * 30), F.when(i % 3 > 0, F.floor(n / 2)), style)
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", shown.alias("shown"))


@query(
    "parse_array_payload",
    "SELECT event_id, (epoch_us(ts) // 1000) AS ts, value AS open, value + 1 AS high, value - 1 AS low, value + 0.5 AS close, CAST(event_id % 7 AS DOUBLE) AS volume FROM events WHERE event_id % 11 <> 0",
)
def parse_array_payload(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    v, ms = F.col("value"), t.millis(F.col("ts"))
    fields = [ms.cast("string"), v.cast("string"), (v + 1).cast("string"), F.when(F.col("event_id") % 11 == 0, "bad").otherwise((v - 1).cast("string")), (v + 0.5).cast("string"), (F.col("event_id") % 7).cast("string")]
    raw = e.select("event_id", F.when(F.col("event_id") % 13 == 0, F.to_json(F.array(F.array(*fields[:3]), F.array(*fields)))).otherwise(F.to_json(F.array(F.array(*fields)))).alias("payload"))
    return payloads.parse_arrays(raw)


@query(
    "parse_object_payload",
    "SELECT event_id, (epoch_us(ts) // 1000) // 1000 * 1000 AS ts, value AS open, value + 1 AS high, value - 1 AS low, value + 0.5 AS close, CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE CAST(event_id % 7 AS DOUBLE) END AS volume FROM events WHERE event_id % 11 <> 0",
)
def parse_object_payload(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    v = F.col("value")
    item = F.struct(
        F.floor(t.millis(F.col("ts")) / 1000).cast("string").alias("timestamp"), v.cast("string").alias("open"), (v + 1).cast("string").alias("high"), F.when(F.col("event_id") % 11 != 0, (v - 1).cast("string")).alias("low"), (v + 0.5).cast("string").alias("close"),
        F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 7).cast("string")).alias("volume"),
    )
    raw = e.select("event_id", F.to_json(F.struct(F.struct(F.array(item).alias("ohlc")).alias("data"))).alias("payload"))
    return payloads.parse_objects(raw, multiplier=1000)


@query("normalize_ts", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN (epoch_us(ts) // 1000) ELSE (epoch_us(ts) // 1000) // 1000 * 1000 END AS ts_ms FROM events")
def normalize_ts(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    ms = t.millis(F.col("ts"))
    return e.select("event_id", t.normalised(F.when(F.col("event_id") % 2 == 0, ms).otherwise(F.floor(ms / 1000))).alias("ts_ms"))


@query(
    "closed_candle_bound",
    "SELECT event_id, m AS minutes, greatest(((epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 60000) - ((epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 60000) % (m * 60000) - m * 60000, 0) AS closed_ts FROM events, (VALUES (1), (60), (1440)) AS t(m)",
)
def closed_candle_bound(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("minutes", F.explode(F.array(F.lit(1), F.lit(60), F.lit(1440))))
    return e.select("event_id", "minutes", t.last_closed(t.millis(F.col("ts")), F.col("minutes")).alias("closed_ts"))


@query("millis_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_second, strftime(ts, '%Y-%m-%d') AS on_day, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS midnight FROM events")
def millis_text(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    ms = t.millis(F.col("ts"))
    day = t.millis_text(ms, F.lit(1440))
    return e.select("event_id", t.millis_text(ms).alias("at_second"), day.alias("on_day"), t.date_millis(day).alias("midnight"))


# --- store, requests and streams ----------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share."""
    return f"{app_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("store_round_trip", ORACLE_SQL["upsert_last_wins"])
def store_round_trip(spark, d):
    s = store.CandleStore(spark, _folder(spark, "store")).create()
    c = events(spark, d, 60)
    s.write(c)
    s.write(as_candles(c.withColumn("ts", F.col("ts") + 7_200_000).withColumn("open", F.col("open") + 1000).withColumn("close", F.col("close") + 1000)))
    s.compact()
    s.vacuum(0)
    return s.scan().select("symbol", "ts", "open", "close")


@query("store_marks", ORACLE_SQL["ts_range"])
def store_marks(spark, d):
    """First and last candle of each series as the store's log has them after two writes."""
    s = store.CandleStore(spark, _folder(spark, "store")).create()
    c = events(spark, d, 60)
    s.write(c.where("ts % 7200000 = 0"))
    s.write(c.where("ts % 7200000 <> 0"))
    return s.marks().select("symbol", "min_ts", "max_ts", "n")


@query("store_range_read", f"WITH {sql_events(60)} SELECT ts, open, close FROM c WHERE symbol = 'click' AND ts >= {FROM_MS} AND ts < {TO_MS + 1}")
def store_range_read(spark, d):
    s = store.CandleStore(spark, _folder(spark, "store")).create()
    s.write(events(spark, d, 60))
    return s.query(("synthetic", "test", "click", 60), FROM_MS, TO_MS + 1, ["open", "close"])


@query(
    "request_plan",
    f"WITH {sql_events(60)}, {_bounds_sql()}, p AS (SELECT symbol, hi, unnest(range(lo, hi, 1800000000)) AS request_start FROM b) SELECT symbol, request_start, least(request_start + 1800000000, hi) AS request_end FROM p",
)
def request_plan(spark, d):
    return rest.plan_requests(_bounds(events(spark, d, 60)), 60, 500).select("symbol", "request_start", "request_end")


@query(
    "ingest_requests",
    f"""WITH {SQL_ORDERS}, {SQL_EXPECTED.format(ms=86400000)}, {SQL_ISLANDS.format(ms=86400000)}, q AS (SELECT symbol, start_ts, end_ts, unnest(range(start_ts, end_ts + 1, 259200000)) AS request_start FROM i)
    SELECT symbol, start_ts, end_ts, request_start, least(request_start + 259200000, end_ts + 86400000) AS request_end FROM q""",
)
def ingest_requests(spark, d):
    """The requests of one ingest pass over all series with all their gaps, three candles at most in each."""
    c = tables.order_candles(spark, d)
    return jobs.requests_for(gaps.merge_intervals(_missing(c, 1440), 1440), 3).select("symbol", "start_ts", "end_ts", "request_start", "request_end")


@query(
    "read_bounds",
    f"""WITH {SQL_LINES}, {_bounds_sql()}, s AS (SELECT symbol, lo, hi, unnest([180, 1440]) AS m FROM b),
    t AS (SELECT symbol, hi, m * 60000 AS w, unnest(range(lo - lo % 86400000, hi + 1, m * 60000)) AS a FROM s)
    SELECT symbol, min(a) AS first_ts, max(a + w) AS end_ts FROM t WHERE a + w <= hi GROUP BY symbol""",
)
def read_bounds(spark, d):
    return rollup.read_bounds(_bounds(lines(spark, d)), [180, 1440]).select("symbol", "first_ts", "end_ts")


@query("exchange_selection", "SELECT n_name AS name FROM nation WHERE n_nationkey % 5 = 3 ORDER BY n_nationkey LIMIT 1")
def exchange_selection(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    return config.chosen_exchange(n.select(F.col("n_name").alias("name"), (F.col("n_nationkey") % 5 == 3).alias("active"), F.col("n_nationkey").alias("position"))).select("name")


@query("stream_candles_1h", f"WITH {sql_events(60)} SELECT {BAR_SQL} FROM c WHERE ts + 3600000 <= (SELECT max(ts) FROM c)")
def stream_candles_1h(spark, d):
    """What a stream of the events has emitted once it read them all: all slots but those still open."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    # A pattern, since the table may be a file as well as a folder of files.
    ticks = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    made = live.stream_candles(ticks, F.col("event_type"), F.col("ts"), F.col("value"), F.lit(1), tables.tick_order(tables.micros(F.col("ts")), F.col("event_id")), 60)
    s = store.CandleStore(spark, _folder(spark, "stream-store")).create()
    live.start(made, s, _folder(spark, "stream-checkpoint")).awaitTermination()
    return s.scan().select(BAR)


@query("stream_features", f"{FEATURES_SQL} SELECT * EXCLUDE (rn, {', '.join(PRICES)}) FROM f")
def stream_features(spark, d):
    """All indicators of a stream of candles, from state to state; as in batch."""
    source, out = _folder(spark, "bars"), _folder(spark, "live")
    lines(spark, d).write.parquet(source)
    made = live.live_features(spark.readStream.schema(CANDLES).parquet(source))
    made.writeStream.outputMode("append").option("checkpointLocation", _folder(spark, "live-checkpoint")).option("path", out).format("parquet").trigger(availableNow=True).start().awaitTermination()
    names = indicators.feature_names()[len(PRICES) :]
    return spark.read.schema(made.schema).parquet(out).select("symbol", "ts", *[F.round(n, 6).alias(n) for n in names])


@query(
    "feature_blocks",
    f"""{FEATURES_SQL} SELECT symbol, (rn - 1) // 1024 AS block, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, count(ema_200) AS n_ema_200, round(sum(close), 2) AS sum_close
    FROM f GROUP BY symbol, (rn - 1) // 1024""",
)
def feature_blocks(spark, d):
    """Blocks of features for training, checked by what their bytes hold."""
    names = indicators.feature_names()
    made = export.blocks(indicators.with_features(lines(spark, d)), names, rows=1024)
    return export.column_sums(made, names, ("close", "ema_200")).select("symbol", "block", "n", "first_ts", "last_ts", F.col("n_ema_200"), F.round("sum_close", 2).alias("sum_close"))

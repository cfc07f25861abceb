"""Scalar time functions on millisecond columns; all take and give whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewright.schema import DAY_MS, MINUTE_MS


def millis(ts: Column) -> Column:
    """Milliseconds of a timestamp without zone, read as UTC (the session must be UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def date_millis(text: Column) -> Column:
    """Milliseconds of UTC midnight of a ``yyyy-MM-dd`` text."""
    return F.unix_millis(F.to_timestamp(text, "yyyy-MM-dd"))


def millis_text(ts: Column, timeframe_minutes: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; the date alone for bars of a day or more."""
    at = F.timestamp_millis(ts)
    full = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    return full if timeframe_minutes is None else F.when(timeframe_minutes >= 1440, F.date_format(at, "yyyy-MM-dd")).otherwise(full)


def floored(ts: Column, interval_ms: Column | int) -> Column:
    """``ts`` down to a multiple of the interval, also before 1970."""
    return ts - F.pmod(ts, interval_ms if isinstance(interval_ms, Column) else F.lit(interval_ms))


def normalised(ts: Column, multiplier: Column | int = 1) -> Column:
    """Payload timestamps in milliseconds: by the multiplier unless it is 1, else seconds are told by their size."""
    m = multiplier if isinstance(multiplier, Column) else F.lit(multiplier)
    return F.when(m != 1, ts * m).when(ts < 10_000_000_000, ts * 1000).otherwise(ts)


def days_in_year(ts: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(F.timestamp_millis(ts)), F.lit(12), F.lit(31)))


def anchor(ts: Column, minutes: Column) -> Column:
    """Start of the period that slots count from: the UTC day up to 1440 minutes, beyond that the UTC year."""
    return F.when(minutes <= 1440, floored(ts, DAY_MS)).otherwise(F.unix_millis(F.date_trunc("YEAR", F.timestamp_millis(ts))))


def period_end(ts: Column, minutes: Column) -> Column:
    start = anchor(ts, minutes)
    return F.when(minutes <= 1440, start + DAY_MS).otherwise(start + days_in_year(ts).cast("long") * DAY_MS)


def slot_start(ts: Column, minutes: Column) -> Column:
    start, width = anchor(ts, minutes), minutes.cast("long") * MINUTE_MS
    return start + F.floor((ts - start) / width).cast("long") * width


def slot_end(ts: Column, minutes: Column) -> Column:
    """The end of the slot of ``ts``; the short slot at the end of a period ends with the period."""
    return F.least(slot_start(ts, minutes) + minutes.cast("long") * MINUTE_MS, period_end(ts, minutes))


def last_closed(now_ms: Column, minutes: Column) -> Column:
    """Start of the newest closed standard candle at ``now``, which counts in whole minutes; never below 0."""
    width = minutes.cast("long") * MINUTE_MS
    return F.greatest(floored(floored(now_ms, MINUTE_MS), width) - width, F.lit(0).cast("long"))


def timeframe_minutes(key: Column) -> Column:
    """Minutes of ``15m``, ``1h``, ``3d``, ``1w`` or ``1M`` (a month has 31 days); null for anything else."""
    unit = F.regexp_extract(key, r"^(\d+)([mhdwM])$", 2)
    per = F.when(unit == "m", 1).when(unit == "h", 60).when(unit == "d", 1440).when(unit == "w", 10080).when(unit == "M", 44640)
    return F.try_to_number(F.nullif(F.regexp_extract(key, r"^(\d+)([mhdwM])$", 1), F.lit("")), F.lit("999999999")).cast("long") * per


def timeframe_text(name: Column, seconds: Column, minutes: Column, hours: Column, style: Column) -> Column:
    """How an exchange wants a timeframe: in seconds, minutes or hours, or by its name.

    Null units fall back on the others, and on a day where all are null.
    """
    secs = F.coalesce(seconds.cast("long"), minutes.cast("long") * 60, hours.cast("long") * 3600, F.lit(86400).cast("long"))
    mins = F.coalesce(minutes.cast("long"), hours.cast("long") * 60, F.lit(1440).cast("long"))
    hrs = F.coalesce(hours.cast("long"), F.floor(minutes / 60).cast("long"), F.lit(24).cast("long"))
    return F.when(style == "seconds", secs.cast("string")).when(style == "minutes", mins.cast("string")).when(style == "hours", hrs.cast("string")).otherwise(name)

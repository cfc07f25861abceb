"""Small candle frames and plain-Python oracles."""

import math

from candlewright.schema import CANDLES

DAY = 86_400_000
HOUR = 3_600_000
JAN_2024 = 1_704_067_200_000


def candles(spark, rows, minutes=1440, symbol="S"):
    """rows: (ts, open, high, low, close, volume)."""
    full = [("m", "c", symbol, minutes, int(r[0]), *(None if x is None else float(x) for x in r[1:])) for r in rows]
    return spark.createDataFrame(full, CANDLES)


def daily(n, start=JAN_2024, skip=()):
    return [(start + i * DAY, 100 + i, 200 + i, 50 - i, 150 + i, 10 + i) for i in range(n) if i not in skip]


def walk(n, seed=42, base=90_000.0, step=250.0):
    import random

    rng = random.Random(seed)
    out, x = [], base
    for _ in range(n):
        x += rng.gauss(0, step)
        out.append(x)
    return out


def loop_average(xs, length, alpha):
    """Null until ``length`` values from the first one; then the recursion."""
    out, seen = [None] * len(xs), []
    y = None
    for i, x in enumerate(xs):
        if x is None and not seen:
            continue
        seen.append(x)
        if len(seen) < length:
            continue
        if len(seen) == length:
            y = 0.0
            for v in seen:  # sum() would correct its rounding
                y += v
            y /= length
        else:
            y = x * alpha + y * (1 - alpha)
        out[i] = y
    return out


def loop_sma(xs, length):
    return [None if i + 1 < length or None in xs[i + 1 - length : i + 1] else sum(xs[i + 1 - length : i + 1]) / length for i in range(len(xs))]


def loop_stdev(xs, length):
    out = []
    for i, m in enumerate(loop_sma(xs, length)):
        out.append(None if m is None else math.sqrt(sum((x - m) ** 2 for x in xs[i + 1 - length : i + 1]) / length))
    return out


def close_to(a, b, rel=1e-12):
    return len(a) == len(b) and all((x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=rel, abs_tol=1e-9)) for x, y in zip(a, b, strict=True))

"""Moving averages over a fixed number of bars. Null is warm-up: a value stands once its window is full.

The recursive averages have no window function; they are in ``operators.indicators``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

def finite(x: Column) -> Column:
    """``x`` as a double, null where it is null, NaN or infinite."""
    d = x.cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


def check_length(length: int) -> int:
    if length < 1:
        raise ValueError(f"a moving average needs a length of at least 1, not {length}")
    return length


def sma(x: Column, length: int, order: WindowSpec) -> Column:
    """Mean of the last ``length`` bars; null until they all have values."""
    frame = order.rowsBetween(1 - check_length(length), 0)
    return F.when(F.count(x).over(frame) >= length, F.avg(x).over(frame))


def stdev(x: Column, length: int, order: WindowSpec) -> Column:
    """Population standard deviation of the last ``length`` bars; null until they all have values."""
    frame = order.rowsBetween(1 - check_length(length), 0)
    return F.when(F.count(x).over(frame) >= length, F.stddev_pop(x).over(frame))


def change(x: Column, order: WindowSpec) -> Column:
    return x - F.lag(x).over(order)

"""Vectors that can be compared by cosine, and cosines that do not depend on how rows are batched."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """False for null and empty vectors and those with null or non-finite components or without a non-zero one."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def compared(df: DataFrame, vector: str) -> Column:
    """A vector column in the precision that it has: of floats as it is, of any other numbers in doubles."""
    return F.col(vector).cast("array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>")


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """The rows of a list column, all of ``size`` components, in double precision.

    Rows of doubles are divided by a power of two, which no cosine sees, so that their squares neither overflow nor vanish.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.asarray(column.flatten(), np.float64).reshape(-1, size)
    return np.ldexp(out, -np.frexp(np.abs(out).max(1))[1][:, None]) if pa.types.is_float64(column.type.value_type) else out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of two matrices, row by row; equal rows give equal results wherever they stand."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def unit(a: np.ndarray) -> np.ndarray:
    return a / np.sqrt((a * a).sum(1))[:, None]

"""Vector columns: which rows take part, one width for all, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """True for a vector that is there and holds only finite numbers."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & inside, F.lit(False))


def extent(rows: DataFrame, vector: str) -> tuple[int, int, int]:
    """Rows, smallest and largest length of a vector column, in one scan."""
    size = F.size(vector)
    row = rows.agg(F.count("*").alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    return row["n"], row["low"] or 0, row["high"] or 0


def padded(vector: str, kind: str, low: int, high: int) -> Column:
    """The vector filled up with zeros to ``high`` entries, unless all have that length."""
    c = F.col(vector)
    return c if low == high else F.concat(c, F.array_repeat(F.lit(0).cast(kind), F.lit(high) - F.size(c)))


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """A list column as rows of a matrix."""
    return np.asarray(column.flatten(), dtype=kind).reshape(len(column), width)

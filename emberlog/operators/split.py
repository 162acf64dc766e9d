"""Chronological split by row position, without sorting the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.operators.prefix import HOUR_US, SECOND_US, epoch_us, floor_div, time_at

# twelve bits per step: at most 4,096 counts to look through
ID_SHIFTS = (52, 40, 28, 16, 4, 0)


@dataclass(frozen=True)
class Cut:
    """Last row of the first part: its time (None = among null times) and id."""

    rows: int
    us: int | None
    last_id: int | None
    nulls: bool

    def first_part(self, df: DataFrame, ts: str = "timestamp", row_id: str = "event_id") -> Column:
        if self.rows == 0:
            return F.lit(False)
        time = F.col(ts)
        if self.nulls:
            return time.isNotNull() | (F.col(row_id) <= self.last_id)
        # a literal of the column's own type, so the filter reaches the scan
        mark = time_at(self.us, df.schema[ts].dataType)
        return time.isNotNull() & ((time < mark) | ((time == mark) & (F.col(row_id) <= self.last_id)))


def _bucket_with(df: DataFrame, bucket: Column, k: int) -> tuple[int, int, int]:
    """Bucket holding the k-th smallest row, rows before it, rows in it.

    The window runs over bucket counts only, whose number the caller bounds.
    """
    counts = df.groupBy(bucket.alias("b")).count()
    run = counts.select("b", "count", F.sum("count").over(W.orderBy("b")).alias("run"))
    row = run.where(F.col("run") >= k).orderBy("b").first()
    return row["b"], row["run"] - row["count"], row["count"]


def cut_at(
    df: DataFrame, k: int, ts: str = "timestamp", row_id: str = "event_id", n_known: int | None = None
) -> Cut:
    """The k-th row by (time, id), null times last, found by narrowing counts."""
    if k <= 0:
        return Cut(0, None, None, False)
    rows = df.select(epoch_us(F.col(ts)).alias("us"), F.col(ts).alias("t"), F.col(row_id).alias("id"))
    kind = df.schema[ts].dataType
    if n_known is None:
        n_known = _row_counts(df, ts)[1]
    left, us, nulls = k, None, k > n_known
    if nulls:
        cur, left = rows.where(F.col("us").isNull()), k - n_known
    else:
        cur = rows.where(F.col("us").isNotNull())
        for width in (HOUR_US, SECOND_US, 1):
            b, before, _ = _bucket_with(cur, floor_div(F.col("us"), width), left)
            left -= before
            us = b * width
            lo = time_at(us, kind)
            hi = time_at(us + width, kind)
            cur = cur.where((F.col("t") >= lo) & (F.col("t") < hi))
    ends = cur.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    # rows of one instant: narrow the id by its leading bits
    for shift in ID_SHIFTS:
        if lo >> shift == hi >> shift:
            continue
        b, before, _ = _bucket_with(cur, F.shiftright("id", shift), left)
        left -= before
        lo, hi = max(lo, b << shift), min(hi, (b << shift) + (1 << shift) - 1)
        cur = cur.where(F.col("id").between(lo, hi))
    return Cut(k, us, lo, nulls)


def _row_counts(df: DataFrame, ts: str) -> tuple[int, int]:
    """All rows, and those with a time."""
    row = df.agg(F.count("*").alias("n"), F.count(ts).alias("known")).first()
    return row["n"], row["known"]


def temporal_slices(df: DataFrame, shares: tuple[float, ...], ts: str = "timestamp", row_id: str = "event_id") -> list[Column]:
    """Conditions "row lies in the first ``int(n * share)`` rows" for each share."""
    n, known = _row_counts(df, ts)
    return [cut_at(df, int(n * s), ts, row_id, known).first_part(df, ts, row_id) for s in shares]


def temporal_split(
    df: DataFrame, test_fraction: float = 0.2, ts: str = "timestamp", row_id: str = "event_id"
) -> tuple[DataFrame, DataFrame]:
    """First ``int(n * (1 - f))`` rows by time, and the rest. Both are plain filters."""
    first = temporal_slices(df, (1 - test_fraction,), ts, row_id)[0]
    return df.where(first), df.where(~first)

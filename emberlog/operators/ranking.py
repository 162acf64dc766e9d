"""Ranks, row numbers, top-k and uniform samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.operators.prefix import epoch_us, leaves_for, ordered_totals, range_leaves, totals_before


def percent_rank_average(df: DataFrame, score: str, out: str = "pct") -> DataFrame:
    """Share of rows at or below, ties given their average rank.

    Ranks are computed on distinct scores and joined back.
    """
    counts = df.groupBy(score).agg(F.count("*").alias("n"))
    ranked = ordered_totals(counts, score, ["n"])
    pct = ranked.select(
        F.col(score).alias("_s"),
        ((F.col("run_n") - F.col("n") + (F.col("n") + 1) / 2) / F.col("all_n")).alias(out),
    )
    return df.join(pct, df[score] == pct["_s"], "left").drop("_s")


def top_k(df: DataFrame, k: int, score: str, tie: str = "event_id") -> DataFrame:
    """k rows with the highest score (per-task heaps, then one merge of k rows each)."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)


def latest(df: DataFrame, k: int = 5, ts: str = "timestamp", tie: str = "anomaly_id") -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie)).limit(k)


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """First rows of a table in a stated order."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """k rows per group; Spark drops losers before the shuffle."""
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def sample_key(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string")))


def uniform_sample(df: DataFrame, k: int, row_id: str = "event_id", seed: int = 42) -> DataFrame:
    """k rows drawn without replacement: those with the smallest hashed ids.

    A bound on the hash first leaves little more than k rows; it is widened to
    the whole table in the unlikely case that it leaves fewer than k.
    """
    keyed = df.withColumn("_key", sample_key(F.col(row_id), seed))
    n = df.count()
    margin = k + 8 * int(k**0.5) + 64
    if n > 2 * margin:
        bound = f"{int(margin / n * 16**12):012x}"
        near = keyed.where(F.col("_key") < bound)
        if near.count() >= k:
            keyed = near
    return keyed.orderBy("_key", row_id).limit(k).drop("_key")


def with_row_position(df: DataFrame, ts: str = "timestamp", row_id: str = "event_id", out: str = "row_pos") -> DataFrame:
    """Zero-based position of every row by (time, id); null times come last.

    Rows are dealt into ranges of (time, id) and sorted there, so an instant
    that holds a third of the table is cut by ids, wherever those lie. A row's
    position is its place in its range and the rows of the ranges before.
    """
    # null times sort behind every real one
    rows = df.withColumn("_us", F.coalesce(epoch_us(F.col(ts)), F.lit(2**62)))
    leaves = leaves_for(df.count())
    placed = range_leaves(rows, ["_us", row_id], leaves, "positions")
    totals = placed.groupBy("_leaf").agg(F.count("*").alias("_t_n"))
    before = totals_before(totals, ["n"], [], leaves)
    return placed.join(before, "_leaf").select(*df.columns, (F.col("_off_n") + F.col("_place")).alias(out))

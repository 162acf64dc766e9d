"""Rolling time-window features over the whole log, without a global window.

The frames are RANGE ``w`` minutes before each row up to the row, over all
nodes. Counts and sums come from differences of running totals; the number of
distinct nodes comes from the moments a node enters and leaves the frame. A
plain Spark range frame would re-add the whole frame at each row.

Two plans give the same numbers. Where no 15 minutes hold more than
``BLOCK_ROWS`` pairs of node and instant (checked), a block of time is one
task's work together with the last stretch of the block before it. Where a
burst makes a block larger, running totals by second, hour and horizon keep
every group bounded at the price of more stages.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.operators.prefix import MINUTE_US, epoch_us, floor_div, hour_of, running_totals, second_of
from emberlog.session import spread

WINDOW_MINUTES = (1, 5, 15)
# A block's pandas work peaks near 730 bytes a pair (measured), and a task gets
# at most twice this many pairs; four such tasks share an executor's Python.
BLOCK_ROWS = 250_000


def neighbours_in_time(seen: DataFrame, key: str) -> DataFrame:
    """Add ``prev_us`` and ``next_us`` of the same key; ``seen`` is distinct by (key, us).

    A key with a third of all rows is walked by second, hour and horizon, so no
    window holds more than a second's microseconds or an hour's seconds.
    """
    s = seen.withColumn("_hour", hour_of(F.col("us"))).withColumn("_sec", second_of(F.col("us")))
    w1 = W.partitionBy(key, "_hour", "_sec").orderBy("us")
    inner = s.select("*", F.lag("us").over(w1).alias("_p1"), F.lead("us").over(w1).alias("_n1"))

    w2 = W.partitionBy(key, "_hour").orderBy("_sec")
    secs = (
        s.groupBy(key, "_hour", "_sec")
        .agg(F.min("us").alias("_first"), F.max("us").alias("_last"))
        .select("*", F.lag("_last").over(w2).alias("_p2"), F.lead("_first").over(w2).alias("_n2"))
    )
    w3 = W.partitionBy(key).orderBy("_hour")
    hours = (
        secs.groupBy(key, "_hour")
        .agg(F.min("_first").alias("_hf"), F.max("_last").alias("_hl"))
        .select(key, "_hour", F.lag("_hl").over(w3).alias("_p3"), F.lead("_hf").over(w3).alias("_n3"))
    )
    around = secs.join(hours, [key, "_hour"]).select(
        key, "_hour", "_sec", F.coalesce("_p2", "_p3").alias("_p"), F.coalesce("_n2", "_n3").alias("_n")
    )
    return inner.join(around, [key, "_hour", "_sec"]).select(
        *seen.columns, F.coalesce("_p1", "_p").alias("prev_us"), F.coalesce("_n1", "_n").alias("next_us")
    )


def _frame_columns(n, err, warn, fatal, sev, nodes, w: int) -> list:
    return [
        n.cast("long").alias(f"total_count_{w}min"),
        err.cast("long").alias(f"error_count_{w}min"),
        warn.cast("long").alias(f"warning_count_{w}min"),
        fatal.cast("long").alias(f"fatal_count_{w}min"),
        (sev / n).alias(f"avg_severity_{w}min"),
        nodes.cast("long").alias(f"unique_nodes_{w}min"),
    ]


SUMS = ("n", "err", "warn", "fatal", "sev")


def _block_frames(block_us: int, minutes: Sequence[int]):
    """Function for one block's rows and those of the block before it."""

    def frames(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["us"].to_numpy(), kind="stable")
        us = pdf["us"].to_numpy()[order]
        node = pd.factorize(pdf["node"])[0][order]  # -1 is a row without node
        first = np.flatnonzero(np.append(True, us[1:] != us[:-1]))
        at, ends = us[first], np.append(first[1:], len(us))
        own = at // block_us == pdf["block"].iloc[0]
        totals = {c: np.concatenate([[0], np.cumsum(pdf[c].to_numpy()[order])]) for c in SUMS}

        arrivals, code = us[node >= 0], node[node >= 0]
        by_node = np.argsort(code, kind="stable")
        seen, code = arrivals[by_node], code[by_node]
        same = np.append(code[1:] == code[:-1], False) if len(seen) else np.zeros(0, bool)
        gap = np.where(same, np.append(seen[1:], 0) - seen, np.iinfo(np.int64).max)
        out = {"us": at[own]}
        for w in minutes:
            width = w * MINUTE_US
            start = first[np.searchsorted(at, at[own] - width, side="left")]
            stop = ends[own]
            part = {c: totals[c][stop] - totals[c][start] for c in SUMS}
            # a node counts from its row until its next row or the frame's end
            until = np.sort(np.where(gap <= width, seen + gap * (gap <= width), seen + width + 1))
            came = np.searchsorted(arrivals, at[own], side="right")
            left = np.searchsorted(until, at[own], side="right")
            out[f"total_count_{w}min"] = part["n"]
            out[f"error_count_{w}min"] = part["err"]
            out[f"warning_count_{w}min"] = part["warn"]
            out[f"fatal_count_{w}min"] = part["fatal"]
            out[f"avg_severity_{w}min"] = part["sev"] / part["n"]
            out[f"unique_nodes_{w}min"] = came - left
        return pd.DataFrame(out)

    return frames


def _frame_schema(minutes: Sequence[int]) -> str:
    cols = ["us long"]
    for w in minutes:
        cols += [f"{m}_count_{w}min long" for m in ("total", "error", "warning", "fatal")]
        cols += [f"avg_severity_{w}min double", f"unique_nodes_{w}min long"]
    return ", ".join(cols)


def frames_by_instant(
    events: DataFrame, minutes: Sequence[int] = WINDOW_MINUTES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per distinct timestamp (``us``, null included) with all frame columns."""
    sums = list(SUMS)
    base = events.select(
        epoch_us(F.col("timestamp")).alias("us"),
        "node",
        F.lit(1).cast("long").alias("n"),
        (F.col("severity_score") >= 2).cast("long").alias("err"),
        (F.col("severity_score") == 1).cast("long").alias("warn"),
        (F.col("severity_score") >= 3).cast("long").alias("fatal"),
        F.col("severity_score").cast("long").alias("sev"),
    )
    known = base.where(F.col("us").isNotNull())
    reach = max(minutes) * MINUTE_US
    # rows of one node at one instant are summed first, so pairs are what a task gets
    pairs = F.approx_count_distinct(F.struct("us", "node"), 0.05)
    units = known.groupBy(floor_div(F.col("us"), reach).alias("unit")).agg(pairs.alias("pairs"))
    load = units.agg(F.max("pairs").alias("fullest"), F.count("*").alias("units")).first()
    fullest = int(1.2 * (load["fullest"] or 0))
    if fullest <= block_rows:
        # long blocks copy less; keep enough of them to use every core
        cores = events.sparkSession.sparkContext.defaultParallelism
        length = max(1, min(block_rows // max(fullest, 1), load["units"] // (2 * cores)))
        framed = _frames_in_blocks(known, length * reach, reach, minutes)
    else:
        framed = _frames_by_levels(known, minutes)

    # rows without a timestamp are peers of each other
    lost = base.where(F.col("us").isNull())
    one = lost.groupBy("us", "node").agg(*[F.sum(c).alias(c) for c in sums]).groupBy("us").agg(
        *[F.sum(c).alias(c) for c in sums], F.count("node").alias("nodes")
    )
    cols = []
    for w in minutes:
        cols += _frame_columns(*[F.col(c) for c in sums], F.col("nodes"), w)
    return framed.unionByName(one.select("us", *cols))


def _frames_in_blocks(known: DataFrame, block_us: int, reach: int, minutes: Sequence[int]) -> DataFrame:
    """Each block with a copy of the last stretch of the one before."""
    per_node = known.groupBy("us", "node").agg(*[F.sum(c).alias(c) for c in SUMS])
    here = floor_div(F.col("us"), block_us)
    later = floor_div(F.col("us") + F.lit(reach), block_us)
    copied = per_node.withColumn("block", F.explode(F.sequence(here, later)))
    return spread(copied, "block").groupBy("block").applyInPandas(_block_frames(block_us, minutes), _frame_schema(minutes))


def _frames_by_levels(known: DataFrame, minutes: Sequence[int]) -> DataFrame:
    """The same frames with every group bounded by a second or an hour."""
    sums = list(SUMS)
    per_node = known.groupBy("us", "node").agg(*[F.sum(c).alias(c) for c in sums])
    walked = neighbours_in_time(per_node.where(F.col("node").isNotNull()), "node")
    nameless = per_node.where(F.col("node").isNull()).select(
        *per_node.columns, F.lit(None).cast("long").alias("prev_us"), F.lit(None).cast("long").alias("next_us")
    )
    walked = walked.unionByName(nameless)

    # ord: 0 looks up strictly before, 1 a node leaves a frame, 2 rows arrive
    def enters(w):
        gap = F.col("prev_us").isNull() | (F.col("us") - F.col("prev_us") > w * MINUTE_US)
        return F.when(F.col("node").isNotNull() & gap, 1).otherwise(0).cast("long")

    def leaves(w):
        gap = F.col("next_us").isNull() | (F.col("next_us") - F.col("us") > w * MINUTE_US)
        return F.col("node").isNotNull() & gap

    zero = F.lit(0).cast("long")
    arrive = F.struct(
        F.col("us").alias("us"), F.lit(2).alias("ord"), *[F.col(c).alias(c) for c in sums],
        *[enters(w).alias(f"d{w}") for w in minutes],
    )
    depart = [
        F.when(
            leaves(w),
            F.struct(
                (F.col("us") + w * MINUTE_US + 1).alias("us"), F.lit(1).alias("ord"), *[zero.alias(c) for c in sums],
                *[F.lit(-1 if v == w else 0).cast("long").alias(f"d{v}") for v in minutes],
            ),
        )
        for w in minutes
    ]
    measures = [*sums, *[f"d{w}" for w in minutes]]
    changes = (
        walked.select(F.explode(F.array_compact(F.array(arrive, *depart))).alias("p"))
        .select("p.*")
        .groupBy("us", "ord")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    # each instant also asks for the totals strictly before the start of its frames
    own = F.struct(F.col("us").alias("us"), F.col("ord").alias("ord"),
                   F.when(F.col("ord") == 2, F.col("us")).alias("t"), F.lit(0).alias("w"))
    ask = [
        F.when(F.col("ord") == 2, F.struct((F.col("us") - w * MINUTE_US).alias("us"), F.lit(0).alias("ord"),
                                           F.col("us").alias("t"), F.lit(w).alias("w")))
        for w in minutes
    ]
    points = changes.withColumn("p", F.explode(F.array_compact(F.array(own, *ask)))).select(
        "p.us", "p.ord", "p.t", "p.w", *[F.when(F.col("p.w") == 0, F.col(m)).otherwise(zero).alias(m) for m in measures]
    )
    run = running_totals(points, measures, fine=True).where(F.col("t").isNotNull())

    def at(m, w):
        return F.max(F.when(F.col("w") == w, F.col(f"run_{m}")))

    wide = run.groupBy(F.col("t").alias("us")).agg(
        *[at(m, 0).alias(f"{m}_0") for m in measures],
        *[at(m, w).alias(f"{m}_{w}") for m in sums for w in minutes],
    )
    cols = []
    for w in minutes:
        diff = {m: F.col(f"{m}_0") - F.col(f"{m}_{w}") for m in sums}
        cols += _frame_columns(diff["n"], diff["err"], diff["warn"], diff["fatal"], diff["sev"], F.col(f"d{w}_0"), w)
    return wide.select("us", *cols)


def add_rolling_features(
    events: DataFrame, minutes: Sequence[int] = WINDOW_MINUTES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every event with its frame columns, the two rates and the burst flag."""
    frames = frames_by_instant(events, minutes, block_rows).withColumnRenamed("us", "_frame_us")
    left = events.withColumn("_us", epoch_us(F.col("timestamp")))
    out = left.join(frames, left["_us"].eqNullSafe(frames["_frame_us"]), "left").drop("_us", "_frame_us")
    if {1, 5, 15} <= set(minutes):
        out = out.select(
            "*",
            S.ratio(F.col("error_count_5min"), F.col("total_count_5min")).alias("error_rate_5min"),
            S.ratio(F.col("fatal_count_5min"), F.col("total_count_5min")).alias("fatal_rate_5min"),
            S.burst_flag(F.col("total_count_1min"), F.col("total_count_15min")).alias("burst_flag"),
        )
    return out

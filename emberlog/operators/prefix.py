"""Exact running totals with bounded groups.

A running total over a whole table is one window without PARTITION BY, which
Spark runs in one task. Both functions here reach the same numbers by levels:
totals inside small groups, totals of the groups before, and their sum. Every
window they open is bounded by construction, whatever the data looks like.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from emberlog.session import materialize

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
CELL_ROWS = 4_000_000
LEAF_ROWS = 100_000
FAN = 1_024


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch; a time without zone is read as it is written, whatever the session's zone."""
    day = F.unix_date(ts.cast("date")).cast("long") * (24 * HOUR_US)
    clock = F.hour(ts).cast("long") * HOUR_US + F.minute(ts).cast("long") * MINUTE_US + (F.extract(F.lit("SECOND"), ts) * SECOND_US).cast("long")
    return F.when(F.typeof(ts) == "timestamp", F.unix_micros(ts.cast("timestamp"))).otherwise(day + clock)


def time_at(us: int, kind: DataType) -> Column:
    """A literal of a time column's own type, the inverse of ``epoch_us``."""
    if isinstance(kind, TimestampNTZType):
        return F.lit(str(datetime(1970, 1, 1) + timedelta(microseconds=us))).cast(kind)
    return F.timestamp_micros(F.lit(us)).cast(kind)


def floor_div(n: Column, width: int) -> Column:
    """Whole-number division rounding down, exact for any 64-bit value."""
    w = F.lit(width).cast("long")
    return F.call_function("div", n - F.pmod(n, w), w)


def hour_of(us: Column) -> Column:
    return floor_div(us, HOUR_US)


def second_of(us: Column) -> Column:
    return floor_div(us, SECOND_US)


def needs_fine_cells(times: DataFrame, by: Sequence[str] = (), cell_rows: int = CELL_ROWS) -> bool:
    """Whether some hour of ``us`` values holds more rows than one task should get."""
    counts = times.groupBy(*by, hour_of(F.col("us")).alias("_hour")).count()
    return (counts.agg(F.max("count")).first()[0] or 0) > cell_rows


def running_totals(
    points: DataFrame, measures: Sequence[str], by: Sequence[str] = (), fine: bool | None = None
) -> DataFrame:
    """Add ``run_<m>``: the total of ``m`` over all rows up to this one by (us, ord).

    ``points`` holds ``us`` (microseconds) and a small ``ord`` that orders rows
    of one microsecond; callers aggregate first, so a microsecond has a handful
    of rows. Rows are summed inside a cell, cells before it are added. A cell is
    an hour while the fullest hour is small enough (checked here unless the
    caller has), else a second, with the seconds of an hour as a level between.
    """
    by = list(by)
    if fine is None:
        fine = needs_fine_cells(points, by)
    p = points.withColumn("_hour", hour_of(F.col("us")))
    levels = ["_hour"]
    if fine:
        p = p.withColumn("_sec", second_of(F.col("us")))
        levels.append("_sec")
    cell = [*by, *levels]
    in_cell = W.partitionBy(*cell).orderBy("us", "ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = p.select("*", *[F.sum(m).over(in_cell).alias(f"_in_{m}") for m in measures])

    totals = p.groupBy(*cell).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    offsets = _offsets(totals, measures, by, levels)
    keep = points.columns
    return inner.join(offsets, cell).select(
        *keep, *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"run_{m}") for m in measures]
    )


def _offsets(totals: DataFrame, measures: Sequence[str], by: list[str], levels: list[str]) -> DataFrame:
    """Per cell, the total of all cells before it."""
    outer, last = [*by, *levels[:-1]], levels[-1]
    before = W.partitionBy(*outer).orderBy(last).rowsBetween(W.unboundedPreceding, -1)
    ahead = [F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures]
    if len(levels) == 1:
        return totals.select(*outer, last, *ahead)
    upper = totals.groupBy(*outer).agg(*[F.sum(f"_t_{m}").alias(f"_t_{m}") for m in measures])
    upper = _offsets(upper, measures, by, levels[:-1])
    upper = upper.select(*outer, *[F.col(f"_off_{m}").alias(f"_up_{m}") for m in measures])
    return (
        totals.select(*outer, last, *ahead)
        .join(upper, outer)
        .select(*outer, last, *[(F.col(f"_off_{m}") + F.col(f"_up_{m}")).alias(f"_off_{m}") for m in measures])
    )


def range_totals(
    events: DataFrame, spans: DataFrame, measures: Sequence[str], by: Sequence[str] = (), fine: bool | None = None
) -> DataFrame:
    """Per span, the totals of ``measures`` over events with lo <= us <= hi.

    ``events``: by..., us, measures. ``spans``: by..., span_id, lo, hi. Columns
    ``<m>`` (total inside) and ``<m>_before`` (total before lo) come back. No
    (span, event) pair is formed: a span asks for two running totals.
    """
    by = list(by)
    zero = [F.lit(0).cast("long").alias(m) for m in measures]
    data = events.groupBy(*by, "us").agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    data = data.select(*by, "us", F.lit(1).alias("ord"), *measures)
    ends = F.explode(F.array(F.struct(F.col("lo").alias("us"), F.lit(0).alias("ord")),
                             F.struct(F.col("hi").alias("us"), F.lit(2).alias("ord")))).alias("e")
    # spans that share an end ask once
    asks = spans.select(*by, ends).select(*by, "e.us", "e.ord").distinct().select(*by, "us", "ord", *zero)
    run = running_totals(data.unionByName(asks), measures, by, fine).where(F.col("ord") != 1)
    low = run.where("ord = 0").select(*by, F.col("us").alias("lo"), *[F.col(f"run_{m}").alias(f"{m}_before") for m in measures])
    high = run.where("ord = 2").select(*by, F.col("us").alias("hi"), *[F.col(f"run_{m}").alias(f"_hi_{m}") for m in measures])
    return spans.join(low, [*by, "lo"]).join(high, [*by, "hi"]).select(
        *by, "span_id",
        *[(F.col(f"_hi_{m}") - F.col(f"{m}_before")).alias(m) for m in measures],
        *[F.col(f"{m}_before") for m in measures],
    )


def with_bucket(df: DataFrame, key: str, cuts: Sequence[float], out: str = "_bucket") -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_key", outputCol=out, handleInvalid="keep")
    return bucketizer.transform(df.withColumn("_key", F.col(key).cast("double"))).drop("_key")


def leaves_for(rows: int) -> int:
    """Key ranges for so many rows; their number grows with the table, their size doesn't."""
    return max(1, -(-rows // LEAF_ROWS))


def range_leaves(rows: DataFrame, keys: Sequence[str], leaves: int, name: str) -> DataFrame:
    """Rows dealt into ranges of the keys, sorted and written, with ``_leaf`` (range) and ``_place`` (from 0 inside it).

    Spark's range exchange takes the borders from a sample; they only balance
    the work, what is built on the leaves is exact for any borders.
    """
    mark = F.monotonically_increasing_id()  # task number above, row of the task below 33 bits
    sorted_rows = rows.repartitionByRange(leaves, *keys).sortWithinPartitions(*keys)
    return materialize(
        sorted_rows.select("*", F.shiftright(mark, 33).alias("_leaf"), mark.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), name)


def totals_before(totals: DataFrame, measures: Sequence[str], by: Sequence[str], leaves: int, node: str = "_leaf") -> DataFrame:
    """``by..., node, _off_<m>``: totals of all nodes before this one, from ``_t_<m>`` by node.

    Up the tree, nodes are summed by ``FAN`` into their parent until one window
    holds a level; down the tree, a node adds the nodes before it under its
    parent to what lies before the parent. No window has more than ``FAN`` rows
    a group.
    """
    by = list(by)
    zero = F.lit(0)
    if leaves <= FAN:
        before = W.partitionBy(*by).orderBy(node).rowsBetween(W.unboundedPreceding, -1)
        return totals.select(*by, node, *[F.coalesce(F.sum(f"_t_{m}").over(before), zero).alias(f"_off_{m}") for m in measures])
    parent = f"{node}_up"
    under = totals.withColumn(parent, floor_div(F.col(node).cast("long"), FAN))
    above = under.groupBy(*by, parent).agg(*[F.sum(f"_t_{m}").alias(f"_t_{m}") for m in measures])
    above = totals_before(above, measures, by, -(-leaves // FAN), parent)
    above = above.select(*by, parent, *[F.col(f"_off_{m}").alias(f"_up_{m}") for m in measures])
    before = W.partitionBy(*by, parent).orderBy(node).rowsBetween(W.unboundedPreceding, -1)
    inside = under.select(*by, parent, node, *[F.coalesce(F.sum(f"_t_{m}").over(before), zero).alias(f"_in_{m}") for m in measures])
    return inside.join(above, [*by, parent]).select(*by, node, *[(F.col(f"_in_{m}") + F.col(f"_up_{m}")).alias(f"_off_{m}") for m in measures])


def ordered_totals(counts: DataFrame, key: str, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``run_<m>`` (total up to this key, inclusive) and ``all_<m>`` per group.

    ``counts`` has one row per (by, key), so a hot value is a single row. Rows
    are dealt into ranges of (by, key) of about ``LEAF_ROWS`` rows; windows run
    inside a range, a tree over the ranges' totals gives what lies before it.
    The counts are written once, since their number and the ranges both read
    them.
    """
    by = list(by)
    counts = materialize(counts.where(F.col(key).isNotNull()), "counts")
    leaves = leaves_for(counts.count())
    placed = range_leaves(counts, [*by, key], leaves, "ranges").drop("_place") if leaves > 1 else counts.withColumn("_leaf", F.lit(0).cast("long"))
    in_leaf = W.partitionBy("_leaf", *by)
    upto = in_leaf.orderBy(key).rowsBetween(W.unboundedPreceding, W.currentRow)
    if leaves == 1:
        return placed.select(
            *counts.columns, *[F.sum(m).over(upto).alias(f"run_{m}") for m in measures], *[F.sum(m).over(in_leaf).alias(f"all_{m}") for m in measures])
    group = by or ["_all"]  # a constant, so that both joins below have a key
    placed = placed if by else placed.withColumn("_all", F.lit(0))
    inner = placed.select("*", *[F.sum(m).over(upto).alias(f"_in_{m}") for m in measures])
    totals = placed.groupBy(*group, "_leaf").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    whole = totals.groupBy(*group).agg(*[F.sum(f"_t_{m}").alias(f"all_{m}") for m in measures])
    before = totals_before(totals, measures, group, leaves).join(whole, group)
    return inner.join(before, [*group, "_leaf"]).select(
        *counts.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"run_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


SKETCH_ACCURACY = 10_000


def _as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; NaN counts as missing."""
    value = {c: F.col(c).cast("double") for c in columns}
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in value.items()])


def _brackets(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[tuple[float, float]]]:
    """Per column, disjoint value ranges that should hold the quantiles asked for.

    One pass of mergeable sketches over all columns; the driver gets two numbers
    per column and quantile.
    """
    slack = 4.0 / SKETCH_ACCURACY
    around = [p for q in probs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    row = df.agg(*[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        marks = row[c] or []
        merged: list[tuple[float, float]] = []
        for lo, hi in sorted(zip(marks[::2], marks[1::2])):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        out[c] = merged
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles: one row per feature, columns ``q0..``.

    Spark's ``percentile`` keeps every distinct value of a column in one task.
    Here sketches first bracket each quantile. Values inside a bracket are
    counted one by one, all others only per gap between brackets, so little more
    than the brackets is shuffled. Counts then give the exact order statistics;
    a column whose statistic falls in a gap after all is counted in full.
    """
    columns = list(columns)
    values = _as_doubles(df, columns)
    brackets = _brackets(values, columns, probs)
    found = _ranked_quantiles(_bracketed_counts(values, brackets), probs).collect()  # a row per column
    missed = [r["feature"] for r in found if r["in_gap"]]
    rows = [r for r in found if not r["in_gap"]]
    if missed:
        whole = {c: [(float("-inf"), float("inf"))] for c in missed}
        rows += _ranked_quantiles(_bracketed_counts(values.select(*missed), whole), probs).collect()
    names = [f"q{i}" for i in range(len(probs))]
    schema = "feature string, n long, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame([(r["feature"], r["n"], *[r[n] for n in names]) for r in rows], schema)


def _bracketed_counts(values: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(feature, value, exact, n): one row per value in a bracket and one per gap.

    A gap is represented by its smallest value, which sorts it correctly.
    """
    pieces = []
    for c, ranges in brackets.items():
        x = F.col(c)
        slot = F.lit(2 * len(ranges))
        for k, (lo, hi) in reversed(list(enumerate(ranges))):
            slot = F.when(x < lo, 2 * k).when(x <= hi, 2 * k + 1).otherwise(slot)
        pieces += [F.lit(c), x, slot]
    long = values.select(F.stack(F.lit(len(brackets)), *pieces).alias("feature", "x", "slot")).where(F.col("x").isNotNull())
    exact = F.col("slot") % 2 == 1
    return (
        long.groupBy("feature", "slot", F.when(exact, F.col("x")).alias("v"))
        .agg(F.min("x").alias("value"), F.count("*").alias("n"))
        .select("feature", "value", exact.alias("exact"), "n")
    )


def _ranked_quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Quantiles per feature from (feature, value, exact, n) counts."""
    ranked = ordered_totals(counts, "value", ["n"], ["feature"])
    exprs: list[Column] = []
    for i, q in enumerate(probs):
        pos = (F.col("all_n") - 1) * F.lit(float(q))
        hit = F.struct("value", "exact")
        exprs.append(F.min(F.when(F.col("run_n") > F.floor(pos), hit)).alias(f"_lo{i}"))
        exprs.append(F.min(F.when(F.col("run_n") > F.ceil(pos), hit)).alias(f"_hi{i}"))
    agg = ranked.groupBy("feature").agg(F.max("all_n").alias("n"), *exprs)
    out, gap = [], F.lit(False)
    for i, q in enumerate(probs):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        gap = gap | ~lo["exact"] | ~hi["exact"]
        pos = (F.col("n") - 1) * F.lit(float(q))
        out.append((lo["value"] + (hi["value"] - lo["value"]) * (pos - F.floor(pos))).alias(f"q{i}"))
    return agg.select("feature", "n", *out, gap.alias("in_gap"))

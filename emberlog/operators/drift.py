"""Feature drift: two-sample KS per feature and the report built on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions.scalars import round_binary
from emberlog.operators.prefix import ordered_totals
from emberlog.session import materialize

# Recommendation texts and the scores where they change.
NO_DRIFT = "No se detectó drift — el modelo puede continuar en producción."
LEVELS = (
    (0.3, "Drift leve — monitorear durante los próximos días."),
    (0.7, "Drift moderado — considerar re-entrenamiento con datos recientes."),
)
SEVERE = "Drift severo — re-entrenamiento recomendado con /retrain."
NO_FEATURES = "Features not found — run notebook 02 first."

CELLS = 512
ADDRESS_BITS, STEP_BITS = 40, 4
OPEN_SHARE, OPEN_ROWS = 0.01, 500_000


def shared_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    return [c for c in reference.columns if c in current.columns]


def _p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic Kolmogorov tail; the series is cut at 100 terms."""
    lam = d * F.coalesce(F.sqrt(F.try_divide(n * m, n + m)), F.lit(0.0))
    sign = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + sign(k) * F.exp(-2.0 * k * k * lam * lam)
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def ks_per_feature(both: DataFrame, columns: Sequence[str], is_current: Column, direct_below: int = OPEN_ROWS) -> DataFrame:
    """KS statistic and p-value per feature for two sides held in one table.

    Counting every value would shuffle every value of every feature. The ECDFs
    are compared at the borders of cells first (``refined_cells``), and values
    are counted one by one only in the cells left open. The statistic is exact.
    A side without rows has statistic and p-value 1. Tables of at most
    ``direct_below`` values (rows times features) are counted one by one at once.
    """
    values = both.select(
        is_current.alias("_cur"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    )
    stat = _ks(values, list(columns), direct_below)
    no_side = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    stat = stat.withColumn("ks", F.when(no_side, 1.0).otherwise(F.col("ks")))
    return stat.withColumn("p_value", _p_value(F.col("ks"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")))


def _side_counts() -> list[Column]:
    return [F.count_if(~F.col("_cur")).alias("ref"), F.count_if(F.col("_cur")).alias("cur")]


@dataclass
class Cells:
    """What the border comparison knows: per feature its rows and largest gap so far, and the open cells."""

    known: DataFrame  # feature, best, n_ref, n_cur
    open: DataFrame  # feature, cell, b_ref, b_cur (rows before the cell), rows
    bits: int
    rows: int
    open_rows: int


def _knots(values: DataFrame, columns: list[str]) -> list[list[float]]:
    """Per feature, balanced cell borders from one pass of sketches."""
    probs = [i / CELLS for i in range(1, CELLS)]
    marks = values.agg(*[F.percentile_approx(c, probs, 20 * CELLS).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return [sorted({float(k) for k in marks[i] or [] if k == k and abs(k) != float("inf")}) or [0.0] for i in range(len(columns))]


def _addressed(values: DataFrame, columns: list[str]) -> DataFrame:
    """``_cur, feature, value, at``: a value's cell, and behind it ``ADDRESS_BITS`` of where it lies between the cell's borders.

    Addresses rise with the value, so a cell cut in two by the next bit is two
    ranges of values.
    """
    knots = _knots(values, columns)
    cells = [f"_cell_{i}" for i in range(len(columns))]
    names = [f"_v_{i}" for i in range(len(columns))]
    plain = values.select("_cur", *[F.col(c).alias(n) for c, n in zip(columns, names)])
    splits = [[float("-inf"), *k, float("inf")] for k in knots]
    placed = Bucketizer(inputCols=names, outputCols=cells, splitsArray=splits, handleInvalid="keep").transform(plain)
    top = float((1 << ADDRESS_BITS) - 1)

    def address(i: int) -> Column:
        cell, v, borders = F.col(cells[i]), F.col(names[i]), F.lit(knots[i])
        lo, hi = F.get(borders, (cell - 1).cast("int")), F.get(borders, cell.cast("int"))
        inside = F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0))
        return cell.cast("long") * (1 << ADDRESS_BITS) + F.greatest(F.lit(0.0), F.least(F.lit(top), F.floor(inside * top).cast("double"))).cast("long")

    each = [F.struct(F.lit(c).alias("feature"), F.col(n).alias("value"), address(i).alias("at")) for i, (c, n) in enumerate(zip(columns, names))]
    return placed.select("_cur", F.explode(F.array(*each)).alias("p")).select("_cur", "p.*")


def _compared(counts: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Gaps at the borders of counted cells (``feature, parent, cell, ref, cur, b_ref, b_cur``): (known, open cells)."""
    inside = W.partitionBy("feature", "parent").orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = counts.select(
        "feature", "cell", "ref", "cur",
        (F.col("b_ref") + F.sum("ref").over(inside)).alias("e_ref"), (F.col("b_cur") + F.sum("cur").over(inside)).alias("e_cur"))
    if known is None:
        known = counts.groupBy("feature").agg(F.lit(0.0).alias("best"), F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    run = run.join(known, "feature")

    def share(rows, side):
        return F.coalesce(F.try_divide(rows, F.col(f"n_{side}")), F.lit(0.0))

    hi_ref, hi_cur = share(F.col("e_ref"), "ref"), share(F.col("e_cur"), "cur")
    lo_ref, lo_cur = share(F.col("e_ref") - F.col("ref"), "ref"), share(F.col("e_cur") - F.col("cur"), "cur")
    # at either border; the ends of the cells before an open one are borders that were compared already
    gap = F.greatest(F.abs(hi_ref - hi_cur), F.abs(lo_ref - lo_cur))
    best = run.groupBy("feature").agg(F.max(gap).alias("seen"))
    known = materialize(known.join(best, "feature", "left").select(
        "feature", F.greatest("best", F.coalesce("seen", F.lit(0.0))).alias("best"), "n_ref", "n_cur"), "ks-known")
    reach = F.greatest(hi_ref - lo_cur, hi_cur - lo_ref)
    # with rows of one side only, the gap is monotone inside and largest at a border
    two_sides = (F.col("ref") > 0) & (F.col("cur") > 0)
    bound = known.select("feature", F.col("best").alias("bound"))
    still = run.withColumn("reach", reach).join(bound, "feature").where(two_sides & (F.col("reach") > F.col("bound") + 1e-15))
    still = still.select("feature", "cell", (F.col("e_ref") - F.col("ref")).alias("b_ref"), (F.col("e_cur") - F.col("cur")).alias("b_cur"),
                         (F.col("ref") + F.col("cur")).alias("rows"))
    return known, materialize(still, "ks-open")


def refined_cells(long: DataFrame) -> Cells:
    """Cells cut finer, only where the largest gap may still hide, until what is left to count is little.

    A cell is open while the gap inside it could exceed the largest gap seen at
    any border. Open cells are cut by the next address bits and counted again,
    until they hold at most ``OPEN_SHARE`` of the rows, or ``OPEN_ROWS`` rows
    (counting those at once is cheaper than a pass). Work per pass is a grouped
    count; no list of cells comes to the driver.
    """
    side = F.shiftright("at", ADDRESS_BITS).alias("cell")
    counts = long.groupBy("feature", side).agg(*_side_counts())
    zero = F.lit(0).cast("long")
    counts = materialize(counts.select("feature", F.lit(0).cast("long").alias("parent"), "cell", "ref", "cur", zero.alias("b_ref"), zero.alias("b_cur")), "ks-cells")
    known, still = _compared(counts, None)
    rows = counts.agg(F.sum(F.col("ref") + F.col("cur"))).first()[0] or 0
    bits = 0
    while True:
        left = still.agg(F.sum("rows")).first()[0] or 0
        if left <= max(OPEN_SHARE * rows, OPEN_ROWS) or bits + STEP_BITS > ADDRESS_BITS:
            return Cells(known, still, bits, rows, left)
        shift = ADDRESS_BITS - bits
        parents = still.select("feature", F.col("cell").alias("parent"), "b_ref", "b_cur")
        inside = long.withColumn("parent", F.shiftright("at", shift)).join(parents, ["feature", "parent"])
        bits += STEP_BITS
        finer = inside.groupBy("feature", "parent", F.shiftright("at", ADDRESS_BITS - bits).alias("cell"), "b_ref", "b_cur").agg(*_side_counts())
        known, still = _compared(materialize(finer, "ks-cells"), known)


def _one_cell(values: DataFrame, columns: list[str], sides) -> tuple[DataFrame, Cells]:
    """The cells to begin with, one a feature and open; enough where there is little to count anyway."""
    spark, rows = values.sparkSession, sides["ref"] + sides["cur"]
    known = spark.createDataFrame([(c, 0.0, sides["ref"], sides["cur"]) for c in columns], "feature string, best double, n_ref long, n_cur long")
    still = spark.createDataFrame([(c, 0, 0, 0, rows) for c in columns], "feature string, cell long, b_ref long, b_cur long, rows long")
    long = values.unpivot(["_cur"], columns, "feature", "value").withColumn("cell", F.lit(0).cast("long"))
    return long, Cells(known, still, 0, rows * len(columns), rows * len(columns))


def _ks(values: DataFrame, columns: list[str], direct_below: int = OPEN_ROWS) -> DataFrame:
    """``feature, ks, n_ref, n_cur``."""
    sides = values.agg(*_side_counts()).first()
    if (sides["ref"] + sides["cur"]) * len(columns) <= direct_below:
        inside, cells = _one_cell(values, columns, sides)
    else:
        long = _addressed(values, columns)
        cells = refined_cells(long)
        inside = long.withColumn("cell", F.shiftright("at", ADDRESS_BITS - cells.bits)).join(cells.open.select("feature", "cell"), ["feature", "cell"])
    if not cells.open_rows:
        found = cells.known.withColumn("found", F.lit(0.0))
    else:
        here = cells.open.select("feature", "cell", "b_ref", "b_cur")
        run = ordered_totals(inside.groupBy("feature", "cell", "value").agg(*_side_counts()), "value", ["ref", "cur"], ["feature", "cell"])
        joined = run.join(here, ["feature", "cell"]).join(cells.known, "feature")
        gap = F.abs(F.try_divide(F.col("b_ref") + F.col("run_ref"), F.col("n_ref")) - F.try_divide(F.col("b_cur") + F.col("run_cur"), F.col("n_cur")))
        found = cells.known.join(joined.groupBy("feature").agg(F.max(gap).alias("found")), "feature", "left")
    features = values.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    zero = F.lit(0).cast("long")
    return features.join(found, "feature", "left").select(
        "feature", F.coalesce(F.greatest("best", F.coalesce("found", F.lit(0.0))), F.lit(0.0)).alias("ks"),
        F.coalesce("n_ref", zero).alias("n_ref"), F.coalesce("n_cur", zero).alias("n_cur"))


def ks_two_tables(reference: DataFrame, current: DataFrame) -> DataFrame:
    cols = shared_columns(reference, current)
    both = reference.select(*cols, F.lit(False).alias("_side")).unionByName(current.select(*cols, F.lit(True).alias("_side")))
    return ks_per_feature(both, cols, F.col("_side"))


def recommendation(score: Column, detected: Column) -> Column:
    expr = F.when(~detected, NO_DRIFT)
    for bound, text in LEVELS:
        expr = expr.when(score < bound, text)
    return expr.otherwise(SEVERE)


def drift_report(ks: DataFrame, threshold: float = 0.05) -> DataFrame:
    """One row: score, flag, drifted names, p-values, number of features, advice."""
    hit = F.col("p_value") < threshold
    agg = ks.agg(
        F.avg(hit.cast("double")).alias("_share"),
        F.array_sort(F.collect_list(F.when(hit, F.col("feature")))).alias("features_drifted"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", round_binary(F.col("p_value"), 6).alias("p"))))).alias("feature_scores"),
        F.count("*").alias("_n"),
    )
    share = F.coalesce(F.col("_share"), F.lit(0.0))
    detected = (share > 0) & (F.size("features_drifted") > 0)
    return agg.select(
        round_binary(share, 4).alias("drift_score"), detected.alias("drift_detected"), "features_drifted", "feature_scores",
        F.greatest("_n", F.lit(1)).alias("n_features_total"), recommendation(share, detected).alias("recommendation"),
    )


def no_features_report(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(0.0).alias("drift_score"), F.lit(False).alias("drift_detected"),
        F.array().cast("array<string>").alias("features_drifted"),
        F.create_map().cast("map<string,double>").alias("feature_scores"),
        F.lit(1).cast("long").alias("n_features_total"), F.lit(NO_FEATURES).alias("recommendation"),
    )


def traffic_light(score: Column, amber: float = 0.15, red: float = 0.50) -> Column:
    return F.when(score < amber, "🟢").when(score < red, "🟡").otherwise("🔴")


def shift_features(df: DataFrame, columns: Sequence[str], mean: float = 2.0, std: float = 0.5, seed: int = 42) -> DataFrame:
    """Add N(mean, std) noise to the named columns (an artificial drift)."""
    return df.select(
        *[
            (F.col(c) + F.lit(mean) + (F.randn(seed + i) * std if std else F.lit(0.0))).alias(c) if c in columns else F.col(c)
            for i, c in enumerate(df.columns)
        ]
    )

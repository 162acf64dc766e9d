"""Group, pivot and summary reports over log and prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.operators.prefix import exact_quantiles

HOURS = list(range(24))
# Weekday order of the heat map.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def node_baseline(df: DataFrame) -> DataFrame:
    """Per node: events, anomalies by label, mean severity, error ratio."""
    total, errors = F.count("severity_score"), F.sum(F.col("is_anomaly").cast("long"))
    return (
        df.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            total.alias("node_total"),
            errors.alias("node_error_count"),
            F.avg("severity_score").alias("node_avg_severity"),
        )
        .withColumn("node_error_ratio", S.ratio(F.col("node_error_count"), F.col("node_total")))
    )


def relative_frequency(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value, most frequent first, ties by value."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)
    return out.limit(top) if top else out


def anomaly_types(df: DataFrame, top: int = 15) -> DataFrame:
    return value_counts(df.where("is_anomaly"), "label", top)


def class_balance(df: DataFrame) -> DataFrame:
    n_anomaly, n = F.count_if("is_anomaly"), F.count("*")
    agg = df.agg((n - n_anomaly).alias("n_normal"), n_anomaly.alias("n_anomaly"), n.alias("_n"))
    return agg.select(
        "n_normal", "n_anomaly", S.ratio(F.col("n_anomaly"), F.col("_n")).alias("ratio"),
        F.floor(F.try_divide(F.col("n_normal"), F.col("n_anomaly"))).cast("long").alias("one_to"),
    )


def hourly_series(df: DataFrame, flag: str = "is_predicted_anomaly") -> DataFrame:
    """Anomalies, total and normals per hour; hours without rows count 0."""
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    counts = df.where(F.col("timestamp").isNotNull()).groupBy(hour.alias("hour")).agg(
        F.count_if(flag).alias("anomalias"), F.count("*").alias("total")
    )
    span = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).where(F.col("lo").isNotNull())
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour"))
    out = spine.join(counts, "hour", "left").na.fill(0, ["anomalias", "total"])
    return out.withColumn("normales", F.col("total") - F.col("anomalias"))


def _hour_pivot(df: DataFrame, row: str) -> DataFrame:
    hours = df.groupBy(row).pivot("hour", HOURS).count().na.fill(0, [str(h) for h in HOURS])
    return hours.select(row, *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def weekday_heatmap(df: DataFrame) -> DataFrame:
    """Anomalies by weekday (Monday first) and hour."""
    base = df.where(F.col("is_anomaly") & F.col("timestamp").isNotNull()).select(
        S.weekday_name(F.col("timestamp")).alias("weekday"), S.hour_of_day(F.col("timestamp")).alias("hour")
    )
    order = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("weekday"))
    return _hour_pivot(base, "weekday").withColumn("day_no", order).orderBy("day_no")


def node_heatmap(alerts: DataFrame, top: int = 15) -> DataFrame:
    """Alerts by hour of day for the nodes with most of them."""
    nodes = value_counts(alerts, "node", top).select("node")
    base = alerts.where(F.col("timestamp").isNotNull()).join(nodes, "node", "left_semi")
    return _hour_pivot(base.select("node", S.hour_of_day(F.col("timestamp")).alias("hour")), "node")


def node_leaderboard(df: DataFrame, top: int = 15) -> DataFrame:
    return (
        df.where("is_predicted_anomaly")
        .groupBy("node")
        .agg(F.count("anomaly_score").alias("n_anomalies"), F.avg("anomaly_score").alias("avg_score"))
        .orderBy(F.col("n_anomalies").desc(), "node")
        .limit(top)
    )


def top_nodes(df: DataFrame, top: int = 5) -> DataFrame:
    return value_counts(df, "node", top)


def kpi_block(df: DataFrame, min_score: float = 0.3, severities: Sequence[str] = ()) -> DataFrame:
    """Totals of the prediction table; critical ones counted among shown alerts."""
    shown = F.col("is_predicted_anomaly") & (F.col("anomaly_score") >= min_score)
    if severities:
        shown = shown & F.col("severidad").isin(list(severities))
    return df.agg(
        F.count("*").alias("total"),
        F.count_if("is_predicted_anomaly").alias("n_predicted"),
        F.avg(F.col("is_predicted_anomaly").cast("double")).alias("rate"),
        F.count_if(shown & (F.col("severidad") == "CRITICAL")).alias("n_critical"),
    )


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles, max per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    basics = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quart = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select("feature", *[F.col(f"q{i}").alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    return basics.join(quart, "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form; the matrix itself is columns x columns small."""
    cols = list(columns)
    vectors = VectorAssembler(inputCols=cols, outputCol="v", handleInvalid="skip").transform(df).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    rows = [(a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def histogram_per_class(df: DataFrame, value: str, by: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of each class over its own range, with densities."""
    df = df.where(F.col(value).isNotNull())
    ranges = df.groupBy(by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("_size"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    at = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    slot = F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = df.join(ranges, by).groupBy(by, "_lo", "_hi", "_size", slot.alias("bin")).agg(F.count("*").alias("n"))
    return counts.select(
        by, "bin", "n", (F.col("_lo") + F.col("bin") * width).alias("bin_from"),
        F.try_divide(F.col("n"), F.col("_size") * width).alias("density"),
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram per class over the common range, with densities."""
    df = df.where(F.col(value).isNotNull())
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()  # one scan for both
    lo, hi = ends["lo"], ends["hi"]
    width = (hi - lo) / F.lit(float(bins))
    slot = F.when(hi == lo, 0).otherwise(F.least(F.floor((F.col(value) - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.groupBy(by, slot.alias("bin")).agg(F.count("*").alias("n"))
    sizes = df.groupBy(by).agg(F.count("*").alias("_size"))
    return counts.join(sizes, by).select(
        by, "bin", "n", (lo + F.col("bin") * width).alias("bin_from"),
        F.try_divide(F.col("n"), F.col("_size") * width).alias("density"),
    )


def latency_summary(df: DataFrame, column: str) -> DataFrame:
    quant = exact_quantiles(df, [column], [0.5, 0.95])
    mean = df.agg(F.avg(column)).scalar()
    return quant.select(mean.alias("mean_ms"), F.col("q0").alias("median_ms"), F.col("q1").alias("p95_ms"))


def contamination(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.col("is_anomaly").cast("double")).alias("contamination"))


# Score moments used when a class has no rows.
DEFAULT_MOMENTS = {False: (0.15, 0.08), True: (0.78, 0.12)}


def score_moments(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the score per class; defaults where a class is empty."""

    def of(flag: bool) -> list[Column]:
        mine = F.when(F.col("is_anomaly") == flag, F.col("anomaly_score"))
        name, (mean, std) = ("anomaly" if flag else "normal"), DEFAULT_MOMENTS[flag]
        empty = F.count(mine) == 0
        return [
            F.when(empty, F.lit(mean)).otherwise(F.avg(mine)).alias(f"{name}_mean"),
            F.when(empty, F.lit(std)).otherwise(F.stddev_samp(mine)).alias(f"{name}_std"),
        ]

    return df.agg(*of(False), *of(True))


def time_extent(df: DataFrame) -> DataFrame:
    return df.agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count("*").alias("n"))


def detection_rollup(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n, a = F.count("*"), F.count_if("is_predicted_anomaly")
    out = df.groupBy(*by).agg(n.alias("total_logs"), a.alias("total_anomalies"))
    return out.withColumn(
        "anomaly_rate", F.coalesce(S.ratio(F.col("total_anomalies"), F.col("total_logs")), F.lit(0.0))
    )

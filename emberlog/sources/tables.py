"""Parquet tables: features, labels, predictions, drift history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.scalars import round_binary


def save_table(df: DataFrame, path: str, by_date: str | None = None) -> None:
    """Overwrite a table; ``by_date`` adds a ``day`` partition from that column."""
    if by_date:
        df = df.withColumn("day", F.to_date(by_date))
        df.write.mode("overwrite").partitionBy("day").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def feature_schema(spark: SparkSession, path: str, skip: Sequence[str] = ("timestamp", "node", "is_anomaly")) -> list[str]:
    """Ordered feature names from the file footer; no rows are read."""
    return [c for c in spark.read.parquet(path).columns if c not in skip]


def load_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def labels_or_truth(spark: SparkSession, path: str, truth: DataFrame) -> tuple[DataFrame, str]:
    """Stored weak labels if present, else ``is_anomaly`` as the label."""
    stored = load_optional(spark, path)
    if stored is not None:
        return stored, "llm"
    return truth.withColumn("llm_label", F.col("is_anomaly").cast("int")), "ground_truth"


def append_drift_run(report: DataFrame, path: str, run_ts) -> None:
    """One row per drift run: score, number and names of drifted features."""
    drift_record(report, run_ts).write.mode("append").parquet(path)


def drift_record(report: DataFrame, run_ts) -> DataFrame:
    names = F.array_join("features_drifted", ",")
    return report.select(
        run_ts.alias("run_ts"),
        round_binary(F.col("drift_score"), 4).alias("drift_score"),
        F.size("features_drifted").alias("n_features_drifted"),
        F.when(names == "", "none").otherwise(names).alias("features_drifted"),
    )


def last_drift_score(history: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Score of the latest run; 0.0 before any run."""
    if history is None:
        return spark.range(1).select(F.lit(0.0).alias("drift_score"))
    return history.agg(F.coalesce(F.max_by("drift_score", "run_ts"), F.lit(0.0)).alias("drift_score"))

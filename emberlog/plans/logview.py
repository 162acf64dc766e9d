"""The ``events`` table seen as the log table every operator works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_columns() -> list:
    """Node, component, level, label, score and truth derived per event."""
    value = F.col("value")
    kind = F.col("event_type")
    user = F.col("user_id")
    level = (
        F.when((kind == "error") & (value >= 50), "FATAL")
        .when((kind == "error") & (value >= 20), "SEVERE")
        .when(kind == "error", "ERROR")
        .when((kind == "purchase") & (value < 10), "WARNING")
        .when(kind == "click", "warn")
        .when(kind == "signup", "DEBUG")
        .otherwise("INFO")
    )
    score = F.least(value / F.lit(200.0), F.lit(1.0))
    label = F.when((kind == "error") & (value >= 50), "KERNDTLB").otherwise("-")
    return [
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("R"), (user % 24).cast("string"), F.lit("-M"), (user % 2).cast("string")).alias("node"),
        F.upper(kind).alias("component"),
        F.col("props").alias("content"),
        level.alias("level"),
        label.alias("label"),
        (label != "-").alias("is_anomaly"),
        score.alias("anomaly_score"),
        (score >= 0.25).alias("is_predicted_anomaly"),
    ]


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(*log_columns())


# The same view for the SQL oracle.
LOG_VIEW_SQL = """
logs0 AS (
  SELECT event_id, ts AS timestamp,
         'R' || CAST(user_id % 24 AS VARCHAR) || '-M' || CAST(user_id % 2 AS VARCHAR) AS node,
         upper(event_type) AS component,
         props AS content,
         CASE WHEN event_type = 'error' AND value >= 50 THEN 'FATAL'
              WHEN event_type = 'error' AND value >= 20 THEN 'SEVERE'
              WHEN event_type = 'error' THEN 'ERROR'
              WHEN event_type = 'purchase' AND value < 10 THEN 'WARNING'
              WHEN event_type = 'click' THEN 'warn'
              WHEN event_type = 'signup' THEN 'DEBUG'
              ELSE 'INFO' END AS level,
         CASE WHEN event_type = 'error' AND value >= 50 THEN 'KERNDTLB' ELSE '-' END AS label,
         least(value / 200.0, 1.0) AS anomaly_score
  FROM events
),
logs AS (
  SELECT *,
         label <> '-' AS is_anomaly,
         anomaly_score >= 0.25 AS is_predicted_anomaly,
         CAST(CASE upper(level) WHEN 'WARN' THEN 1 WHEN 'WARNING' THEN 1 WHEN 'ERROR' THEN 2
              WHEN 'SEVERE' THEN 3 WHEN 'FATAL' THEN 4 ELSE 0 END AS BIGINT) AS severity_score,
         CASE WHEN anomaly_score < 0.3 THEN 'LOW' WHEN anomaly_score < 0.5 THEN 'MEDIUM'
              WHEN anomaly_score < 0.7 THEN 'HIGH' ELSE 'CRITICAL' END AS severidad
  FROM logs0
)
"""

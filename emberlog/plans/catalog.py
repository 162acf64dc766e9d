"""All registered queries, gathered from their modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.windows import add_rolling_features
from emberlog.plans import queries_boosting, queries_models, queries_scan, queries_tables  # noqa: F401
from emberlog.plans.registry import ORACLES, QUERIES, log_table

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_rolling_features(log_table(spark, sf_dir)).select(
        "event_id", "node", "total_count_5min", "error_count_5min", "unique_nodes_5min",
        F.round("error_rate_5min", 6).alias("error_rate_5min"),
    )

"""Registered queries and, where SQL can say the same, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.plans.logview import LOG_VIEW_SQL, log_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, logs: bool = True):
    """Register a query; ``logs`` puts the log view in front of its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            if logs:
                text = f"WITH {LOG_VIEW_SQL.strip()}" + (f", {text[5:]}" if text.startswith("WITH ") else f"\n{text}")
            ORACLES[name] = text
        return fn

    return add


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log view with severity score and alert severity."""
    return (
        log_view(spark, sf_dir)
        .withColumn("severity_score", S.severity_score(F.col("level")))
        .withColumn("severidad", S.ladder(F.col("anomaly_score"), S.ALERT_SCALE))
    )


def ts_text(column: str | Column = "timestamp") -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def ts_sql(column: str = "timestamp") -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"

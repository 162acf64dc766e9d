"""Row predicates and small lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_time_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both ends inclusive and optional; a null time matches only without bounds."""
    kind = df.schema["timestamp"].dataType
    if start:
        df = df.where(F.col("timestamp") >= F.lit(start).cast(kind))
    if end:
        df = df.where(F.col("timestamp") <= F.lit(end).cast(kind))
    return df


def alerts(df: DataFrame, min_score: float = 0.3, severities: Sequence[str] = ()) -> DataFrame:
    """Predicted anomalies at or over a score; an empty list keeps all severities."""
    out = df.where(F.col("is_predicted_anomaly") & (F.col("anomaly_score") >= min_score))
    return out.where(F.col("severidad").isin(list(severities))) if severities else out


def node_matches(node: Column, pattern: str) -> Column:
    """Case-insensitive regular expression search; null never matches."""
    return F.coalesce(node.rlike("(?i)" + pattern), F.lit(False))


def by_id(df: DataFrame, anomaly_id: str) -> DataFrame:
    """First incident with this id."""
    return df.where(F.col("anomaly_id") == anomaly_id).orderBy("timestamp").limit(1)


def with_labels_only(df: DataFrame, label: str = "llm_label") -> DataFrame:
    return df.dropna(subset=[label])


def error_slice(df: DataFrame, kind: str, truth: str = "is_anomaly", pred: str = "is_predicted_anomaly") -> DataFrame:
    """Rows of one confusion cell: FP, TP, FN or TN."""
    t, p = F.col(truth), F.col(pred)
    cells = {"TP": t & p, "FP": ~t & p, "FN": t & ~p, "TN": ~t & ~p}
    return df.where(cells[kind])


def require_rows(df: DataFrame, minimum: int) -> int:
    """Row count, or an error when there are too few labelled rows."""
    n = df.count()
    if n < minimum:
        raise ValueError(f"only {n} labelled samples, need at least {minimum}")
    return n

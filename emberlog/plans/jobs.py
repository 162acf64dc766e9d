"""Batch jobs composed of the operators."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import filters
from emberlog.functions import scalars as S
from emberlog.operators import drift
from emberlog.operators.classifier import WeakLabelClassifier
from emberlog.operators.detector import AnomalyDetector
from emberlog.operators.evaluation import evaluate
from emberlog.operators.features import FeatureModel
from emberlog.operators.joins import context_chunks, join_labels
from emberlog.operators.split import temporal_slices, temporal_split
from emberlog.session import materialize

ID_COLUMNS = ("timestamp", "node", "is_anomaly", "event_id")


def feature_names(df: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in ids]


def detect_job(
    logs: DataFrame, features: FeatureModel, detector: AnomalyDetector, window_minutes: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(anomalies, context chunks) for raw logs, with the fitted feature model.

    Logs carry event_id, timestamp, node, level, component, content, label.
    """
    logs = logs.withColumn("is_anomaly", S.label_flag(F.col("label")))
    rows = S.align(features.transform(logs, ["event_id"]), detector.columns, ["timestamp", "node", "event_id"])
    hits = detector.predict(rows).where("is_predicted_anomaly")
    hits = materialize(
        hits.select(
            S.incident_id(F.col("event_id"), prefix="", digits=32).alias("anomaly_id"), "event_id", "timestamp", "node", "anomaly_score",
            F.lit(True).alias("is_anomaly"),
        ),
        "detections",
    )
    context = context_chunks(
        hits, logs, window_minutes, ["event_id", "timestamp", "node", "level", "component", "content"]
    )
    return hits, context


def detect_response(hits: DataFrame, logs: DataFrame) -> DataFrame:
    """Totals of one detection run; rate 0 for an empty request."""
    n, a = logs.agg(F.count("*")).scalar(), F.count("*")
    return hits.agg(a.alias("total_anomalies")).select(
        n.alias("total_logs"), "total_anomalies",
        F.when(n > 0, F.col("total_anomalies") / n).otherwise(0.0).alias("anomaly_rate"),
    )


def holdout_predictions(features: DataFrame, detector: AnomalyDetector, test_fraction: float = 0.2) -> DataFrame:
    """Scores of the last part by time, scaled to 0..1."""
    _, test = temporal_split(features, test_fraction)
    scored = materialize(detector.predict(test).select(*ID_COLUMNS, "anomaly_score", "is_predicted_anomaly"), "holdout")
    return S.min_max_scale(scored, "anomaly_score", "anomaly_score")


def retrain_job(
    features: DataFrame, labels: DataFrame | None, detector: AnomalyDetector | None, learner: WeakLabelClassifier,
    min_samples: int = 100, model_path: str | None = None,
) -> DataFrame:
    """Fit the classifier on weak labels and compare it with the detector: one row."""
    names = feature_names(features)
    train, test = temporal_split(features, 0.2)
    f1_before = 0.0
    if detector is not None:
        base = detector.predict(test).withColumn("model", F.lit("baseline"))
        f1_before = evaluate(base).first()["f1"]
    if labels is not None:
        merged = filters.with_labels_only(join_labels(train, labels.select("timestamp", "node", "llm_label")))
        source = "llm"
    else:
        merged = train.withColumn("llm_label", F.col("is_anomaly").cast("int"))
        source = "ground_truth"
    merged = materialize(merged, "retrain-samples")
    n = filters.require_rows(merged, min_samples)
    start = time.monotonic()
    learner.fit(merged, names)
    took = round((time.monotonic() - start) * 1000, 1)
    after = evaluate(learner.predict(test).withColumn("model", F.lit("after"))).first()["f1"]
    if model_path:
        learner.save(model_path)
    row = ("active_learner_v1", float(f1_before), float(after), n, took, f"{source} ({n} samples)")
    schema = ("model_version string, f1_before double, f1_after double, n_samples_used long, "
              "retrain_time_ms double, labels_source string")
    return features.sparkSession.createDataFrame([row], schema)


def drift_health(features: DataFrame | None, spark=None, share: float = 0.8, threshold: float = 0.05) -> DataFrame:
    """Drift of the last part of the features against the first; no features, no drift."""
    if features is None:
        return drift.no_features_report(spark)
    reference = temporal_slices(features, (share,))[0]
    ks = drift.ks_per_feature(features, feature_names(features), ~reference)
    return drift.drift_report(ks, threshold)

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators.classifier import WeakLabelClassifier
from emberlog.operators.detector import AnomalyDetector
from emberlog.operators.features import fit_features
from emberlog.operators.incidents import history_labels, weak_labels
from emberlog.plans import jobs


def features_table(spark, n=300, seed=0):
    """One row a minute, 80 % normal then 20 % anomalies mixed in at the end and start."""
    rng = np.random.default_rng(seed)
    flag = np.arange(n) % 5 == 4
    pdf = pd.DataFrame({
        "timestamp": [datetime(2005, 6, 3) + timedelta(minutes=i) for i in range(n)], "node": [f"n{i % 4}" for i in range(n)],
        "is_anomaly": flag, "event_id": range(n), "f1": rng.normal(0, 1, n) + 6 * flag, "f2": rng.normal(0, 1, n),
    })
    return spark.createDataFrame(pdf, "timestamp timestamp_ntz, node string, is_anomaly boolean, event_id long, f1 double, f2 double")


def test_retrain_on_truth(spark):
    r = jobs.retrain_job(features_table(spark), None, None, WeakLabelClassifier(n_estimators=60)).first()
    assert r["labels_source"] == "ground_truth (240 samples)" and r["n_samples_used"] == 240
    assert r["f1_before"] == 0.0 and r["f1_after"] > 0.9 and r["model_version"] == "active_learner_v1"


def test_retrain_on_labels_with_baseline(spark, tmp_path):
    f = features_table(spark)
    detector = AnomalyDetector("isolation_forest", contamination=0.2, n_trees=40).fit(f, ["f1", "f2"])
    labels = weak_labels(f.where("event_id < 150"), f)
    r = jobs.retrain_job(f, labels, detector, WeakLabelClassifier(n_estimators=60), model_path=str(tmp_path / "m")).first()
    assert r["labels_source"] == "llm (150 samples)" and r["f1_before"] > 0
    assert WeakLabelClassifier.load(spark, str(tmp_path / "m")).columns == ["f1", "f2"]


def test_retrain_needs_samples(spark):
    f = features_table(spark, 40)
    with pytest.raises(ValueError):
        jobs.retrain_job(f, None, None, WeakLabelClassifier(n_estimators=1), min_samples=100)


def test_health_with_and_without_features(spark):
    f = features_table(spark, 200)
    assert not jobs.drift_health(f).first()["drift_detected"]
    moved = f.withColumn("f2", F.col("f2") + F.when(F.col("event_id") >= 160, 5.0).otherwise(0.0))
    r = jobs.drift_health(moved).first()
    assert r["drift_detected"] and r["features_drifted"] == ["f2"] and r["drift_score"] == 0.5
    assert jobs.drift_health(None, spark).first()["drift_score"] == 0.0


def test_holdout_scores_are_scaled(spark):
    f = features_table(spark)
    detector = AnomalyDetector("lof", contamination=0.2).fit(f.where("event_id < 240"), ["f1", "f2"])
    out = jobs.holdout_predictions(f, detector).toPandas()
    assert len(out) == 60 and out["anomaly_score"].min() == 0.0 and out["anomaly_score"].max() == pytest.approx(1.0)


def test_history_labels_shares(spark):
    df = spark.range(1000).select(
        F.col("id").alias("event_id"), F.lit(datetime(2005, 6, 3)).cast("timestamp_ntz").alias("timestamp"), F.lit("n").alias("node"),
        (F.col("id") / 1000).alias("anomaly_score"), F.lit(True).alias("is_predicted_anomaly"))
    got = {r["severidad"]: r["count"] for r in history_labels(df).groupBy("severidad").count().collect()}
    assert got == {"CRITICAL": 51, "HIGH": 150, "MEDIUM": 300, "LOW": 499}
    assert history_labels(df).where("anomaly_id rlike '^AN-[0-9A-F]{8}$'").count() == 1000


def test_detection_job(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        burst = 300 <= i < 320
        level = "FATAL" if burst else ["INFO", "INFO", "WARNING"][int(rng.integers(0, 3))]
        second = 30 * 300 + (i - 300) if burst else 30 * i
        rows.append((i, datetime(2005, 6, 3) + timedelta(seconds=second), f"n{i % 3}", level, "KERNEL", f"m{i}", "X" if burst else "-"))
    logs = spark.createDataFrame(
        rows, "event_id long, timestamp timestamp_ntz, node string, level string, component string, content string, label string")
    model = fit_features(logs.withColumn("is_anomaly", F.col("label") != "-"))
    train = model.transform(logs.withColumn("is_anomaly", F.col("label") != "-"), ["event_id"])
    detector = AnomalyDetector("isolation_forest", contamination=0.05, n_trees=60).fit(train, model.columns)
    hits, context = jobs.detect_job(logs, model, detector, window_minutes=2)
    found = {r["event_id"] for r in hits.collect()}
    assert len(found) == 20 and len(found & set(range(300, 330))) >= 15
    near = {r["anomaly_id"]: r["n"] for r in context.groupBy("anomaly_id").agg(F.sum(F.size("entries")).alias("n")).collect()}
    assert len(near) == 20 and min(near.values()) >= 1
    total = jobs.detect_response(hits, logs).first()
    assert (total["total_logs"], total["total_anomalies"], total["anomaly_rate"]) == (400, 20, 0.05)
    none = jobs.detect_response(hits.limit(0), logs.limit(0)).first()
    assert none["anomaly_rate"] == 0.0

"""Features and detectors in a Pipeline: fit, save, load, same scores."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from emberlog.operators.detector import AnomalyDetector
from emberlog.operators.features import fit_features
from emberlog.operators.split import temporal_split
from emberlog.operators.stages import Detector, LogFeatures
from emberlog.plans.registry import log_table


def scores(df):
    return {r["event_id"]: (round(r["anomaly_score"], 9), r["is_predicted_anomaly"]) for r in df.collect()}


@pytest.mark.parametrize("kind", ["isolation_forest", "lof"])
def test_a_saved_pipeline_scores_as_before(spark, sf_dir, tmp_path, kind):
    logs = log_table(spark, sf_dir).drop("severity_score", "severidad", "anomaly_score", "is_predicted_anomaly")
    train, test = temporal_split(logs.where("event_id < 400"))
    model = Pipeline(stages=[LogFeatures(), Detector(modelType=kind, contamination=0.05)]).fit(train)
    before = scores(model.transform(test))
    model.write().overwrite().save(str(tmp_path / kind))
    assert scores(PipelineModel.load(str(tmp_path / kind)).transform(test)) == before and len(before) == test.count()
    features = fit_features(train)
    direct = AnomalyDetector(kind, contamination=0.05).fit(features.transform(train, ["event_id"]), features.columns)
    assert scores(direct.predict(features.transform(test, ["event_id"]))) == before


def test_stages_keep_their_parameters(spark, tmp_path):
    stage = Detector(modelType="lof", contamination=0.1, inputCols=["a"])
    stage.write().overwrite().save(str(tmp_path / "d"))
    again = Detector.load(str(tmp_path / "d"))
    assert [again.getOrDefault(p) for p in ("modelType", "contamination", "inputCols", "seed")] == ["lof", 0.1, ["a"], 42]
    rows = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("unused"))
    assert again.fit(rows).held.columns == ["a"]

"""Streams over several files equal the batch result."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.operators.aggregates import hourly_series, score_moments
from emberlog.sources.stream import event_stream
from emberlog.streaming import live

SCHEMA = ("event_id long, timestamp timestamp_ntz, node string, level string, component string, content string, "
          "is_anomaly boolean, anomaly_score double")
BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Five files of forty events, ten seconds apart."""
    rng = np.random.default_rng(0)
    path = tmp_path_factory.mktemp("stream")
    rows = [
        (i, BASE + timedelta(seconds=10 * i), f"n{i % 3}", ["INFO", "WARN", "FATAL"][i % 3], "K", f"m{i}", bool(i % 9 == 0), float(rng.random()))
        for i in range(200)
    ]
    for f in range(5):
        spark.createDataFrame(rows[f * 40 : f * 40 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(str(path / "in"))
    return str(path / "in"), rows


def stream(spark, folder):
    schema = spark.read.parquet(folder[0]).schema
    return event_stream(spark, folder[0], schema, files_per_trigger=1)


def test_scores_counters_latest(spark, folder):
    rows = folder[1]
    out = live.run_available(live.score_events(stream(spark, folder)), "append", "t")
    assert out.count() == 200
    batch = live.score_events(spark.createDataFrame(rows, SCHEMA))
    assert sorted(out.select("event_id", "severity").collect()) == sorted(batch.select("event_id", "severity").collect())
    assert out.where("not is_anomaly and severity <> 'LOW'").count() == 0
    c = live.run_available(live.counters(stream(spark, folder)), "complete", "c").first()
    assert (c["n_events"], c["n_anomalies"]) == (200, 23) and c["rate"] == pytest.approx(0.115)
    last = live.run_available(live.latest_anomaly(live.score_events(stream(spark, folder))), "complete", "l")
    assert last.first()["event_id"] == 198
    shown = live.with_canned_summary(last).first()
    assert shown["slot"] == 22 % 4 and shown["resumen"] == live.CANNED_SUMMARIES[2][0]


def test_feed_keeps_the_newest_and_continues(spark, folder, tmp_path):
    root = str(tmp_path / "feed")
    feed = live.run_feed(stream(spark, folder), root=root).collect()
    assert [r["event_id"] for r in feed] == list(range(199, 149, -1))
    spark.createDataFrame([(500, BASE + timedelta(days=1), "n", "INFO", "K", "m", False, 0.1)], SCHEMA).write.mode("append").parquet(folder[0])
    again = live.run_feed(stream(spark, folder), root=root).collect()
    assert [r["event_id"] for r in again][:2] == [500, 199] and len(again) == 50


def test_sliding_windows_equal_batch_on_closed_windows(spark, folder):
    s = stream(spark, folder).withColumn("severity_score", S.severity_score(F.col("level")))
    got = live.run_available(live.rolling_stream(s), "append", "r").where("window_start >= '2024-01-01 00:00:00'").toPandas()
    first = got.sort_values("window_start").iloc[0]
    assert first["total_count"] == 30 and first["unique_nodes"] == 3
    assert first["fatal_count"] == 10 and first["warning_count"] == 10
    assert got["window_start"].is_unique


def test_late_rows_and_exact_nodes(spark, tmp_path):
    """Many nodes counted exactly, null nodes not; a row behind the watermark changes nothing."""
    path = str(tmp_path / "late")
    rows = [(k, BASE + timedelta(seconds=k % 60), f"n{k % 700}", "INFO", "K", "m", False, 0.1) for k in range(1400)]
    rows += [(5000, BASE, None, "FATAL", "K", "m", False, 0.1), (5001, BASE + timedelta(hours=1), "far", "INFO", "K", "m", False, 0.1)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)

    def windows():
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path).withColumn("severity_score", S.severity_score(F.col("level")))
        out = live.run_available(live.rolling_stream(s), "append", "late").toPandas()
        return out.set_index("window_start").sort_index()

    first = windows().loc[pd.Timestamp(BASE)]
    assert (first["total_count"], first["unique_nodes"], first["fatal_count"]) == (1401, 700, 1)
    for k in range(2):  # the watermark that drops rows is that of the batch before
        time.sleep(1.1)
        more = [(5500 + k, BASE + timedelta(hours=1, seconds=k), "far", "INFO", "K", "m", False, 0.1)]
        spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    late = [(6000, BASE, "late", "FATAL", "K", "m", False, 0.1), (6001, BASE + timedelta(hours=2), "far", "INFO", "K", "m", False, 0.1)]
    time.sleep(1.1)  # files are read by age
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    again = windows()
    assert again.loc[pd.Timestamp(BASE), "total_count"] == 1401 and again.loc[pd.Timestamp(BASE), "unique_nodes"] == 700
    assert again.index.is_unique and again.loc[pd.Timestamp(BASE + timedelta(hours=1)), "unique_nodes"] == 1


def test_export_row(spark):
    row = S.export_row(spark.createDataFrame([(1, BASE, "n", "INFO", "K", "m", False, 0.123449999)], SCHEMA)).first()
    assert row["timestamp"] == "2024-01-01 00:00:00" and row["anomaly_score"] == 0.1234


def test_moments_defaults(spark):
    df = spark.createDataFrame(pd.DataFrame({"is_anomaly": [False] * 3, "anomaly_score": [0.1, 0.2, 0.3]}))
    m = score_moments(df).first()
    assert m["normal_mean"] == pytest.approx(0.2) and m["normal_std"] == pytest.approx(0.1)
    assert (m["anomaly_mean"], m["anomaly_std"]) == (0.78, 0.12)


def test_hours_without_rows_count_zero(spark):
    rows = [(BASE, True), (BASE + timedelta(hours=3, minutes=5), False), (None, True)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, is_predicted_anomaly boolean")
    got = [(r["hour"].hour, r["anomalias"], r["total"], r["normales"]) for r in hourly_series(df).orderBy("hour").collect()]
    assert got == [(0, 1, 1, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 1, 1)]

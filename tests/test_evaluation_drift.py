from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import drift as D
from emberlog.operators import evaluation as EV
from emberlog.sources import tables


def scored(spark, truth, pred, score, model="m"):
    pdf = pd.DataFrame({"is_anomaly": truth, "is_predicted_anomaly": pred, "anomaly_score": score, "model": model})
    return spark.createDataFrame(pdf)


def test_perfect(spark):
    r = EV.evaluate(scored(spark, [0, 0, 0, 1, 1], [0, 0, 0, 1, 1], [0.1, 0.1, 0.1, 0.9, 0.9])).first()
    assert (r["precision"], r["recall"], r["f1"], r["aupr"]) == (1.0, 1.0, 1.0, 1.0)


@pytest.mark.parametrize("leaf_rows", [2, 100_000])
def test_imperfect(spark, monkeypatch, leaf_rows):
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(prefix, "FAN", 3)
    r = EV.evaluate(scored(spark, [0, 0, 1, 1, 1, 0], [0, 1, 1, 0, 1, 0], [0.1, 0.6, 0.8, 0.3, 0.9, 0.2])).first()
    assert r["n_true"] == 3 and r["n_pred"] == 3
    assert 0 < r["precision"] <= 1 and 0 < r["recall"] <= 1
    # 0.9 and 0.8 are hits, 0.6 is not, 0.3 is the third hit at rank four
    assert r["aupr"] == pytest.approx(round((1 + 1 + 3 / 4) / 3, 4))


def test_nothing_predicted_is_zero(spark):
    r = EV.confusion(scored(spark, [0, 1], [0, 0], [0.1, 0.2])).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_pr_curve_has_one_more_point_than_thresholds(spark):
    rows = EV.pr_curve(scored(spark, [0, 0, 1, 1], [0] * 4, [0.1, 0.4, 0.7, 0.9])).collect()
    assert len(rows) == 5 and sum(r["threshold"] is not None for r in rows) == 4
    last = [r for r in rows if r["threshold"] is None][0]
    assert (last["precision"], last["recall"]) == (1.0, 0.0)


def test_models_ranked_by_f1(spark):
    df = spark.createDataFrame([("LOF", 0.55), ("IF", 0.77), ("OCSVM", 0.62)], "model string, f1 double")
    assert [r["model"] for r in EV.compare_models(df).collect()] == ["IF", "OCSVM", "LOF"]


def frame(spark, n, means, sds, seed):
    rng = np.random.default_rng(seed)
    cols = ("error_rate", "burst_flag", "severity_mean")
    return spark.createDataFrame(pd.DataFrame({c: rng.normal(m, s, n) for c, m, s in zip(cols, means, sds)}))


@pytest.fixture(scope="module")
def reference(spark):
    return frame(spark, 300, (0.05, 0.1, 1.2), (0.01, 0.02, 0.3), 0).cache()


def test_no_drift_and_high_drift(spark, reference):
    same = D.drift_report(D.ks_two_tables(reference, frame(spark, 100, (0.05, 0.1, 1.2), (0.01, 0.02, 0.3), 1))).first()
    assert same["drift_score"] < 0.5 and same["n_features_total"] == 3
    high = D.drift_report(D.ks_two_tables(reference, frame(spark, 100, (0.8, 0.9, 3.5), (0.05, 0.05, 0.2), 2))).first()
    assert high["drift_detected"] and high["drift_score"] == 1.0
    assert high["features_drifted"] == ["burst_flag", "error_rate", "severity_mean"]
    assert high["recommendation"] == D.SEVERE and set(high["feature_scores"]) == set(high["features_drifted"])


@pytest.mark.parametrize("leaf_rows", [2, 100_000])
def test_statistic_equals_direct_ecdf_gap(spark, monkeypatch, leaf_rows):
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(prefix, "FAN", 3)
    rng = np.random.default_rng(9)
    a, b = rng.integers(0, 20, 400).astype(float), rng.integers(3, 24, 250).astype(float)
    ks = D.ks_two_tables(spark.createDataFrame(pd.DataFrame({"x": a})), spark.createDataFrame(pd.DataFrame({"x": b}))).first()
    grid = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), grid, "right") / 400 - np.searchsorted(np.sort(b), grid, "right") / 250).max()
    assert ks["ks"] == pytest.approx(gap)
    assert (ks["n_ref"], ks["n_cur"]) == (400, 250)


@pytest.mark.parametrize("open_rows", [0, 500_000])
def test_cells_give_the_exact_statistic(spark, monkeypatch, open_rows):
    """Ties, a hot value, a shifted column, heavy tails, infinities and NaN."""
    rng = np.random.default_rng(11)
    n = 3000
    cur = rng.random(n) < 0.3
    pdf = pd.DataFrame({
        "c": cur, "same": rng.normal(size=n), "moved": rng.normal(size=n) + 0.4 * cur,
        "hot": np.where(rng.random(n) < 0.4, 1.5, rng.normal(size=n)), "flat": 7.0, "whole": rng.integers(0, 6, n).astype(float),
        "tails": np.exp(rng.normal(size=n) * 8), "edges": rng.choice([-np.inf, 0.0, 1.0, np.inf], n),
    })
    monkeypatch.setattr(D, "CELLS", 16)
    monkeypatch.setattr(D, "OPEN_ROWS", open_rows)
    names = ["same", "moved", "hot", "flat", "whole", "tails", "edges"]
    got = D.ks_per_feature(spark.createDataFrame(pdf), names, F.col("c")).toPandas().set_index("feature")
    for c in names:
        a, b = np.sort(pdf.loc[~cur, c]), np.sort(pdf.loc[cur, c])
        grid = np.unique(pdf[c])
        want = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
        assert got.loc[c, "ks"] == pytest.approx(want, abs=1e-12), c
        assert (got.loc[c, "n_ref"], got.loc[c, "n_cur"]) == (len(a), len(b))


def test_share_counted_one_by_one_falls_with_the_rows(spark, monkeypatch):
    """Undrifted sides: the cells left open hold a smaller share of a larger table."""
    monkeypatch.setattr(D, "OPEN_ROWS", 0)
    shares = []
    for n in (5_000, 50_000, 400_000):
        rows = spark.range(n).select((F.xxhash64("id") % 3 == 0).alias("_cur"), F.randn(7).alias("x"))
        cells = D.refined_cells(D._addressed(rows, ["x"]))
        assert cells.rows == n and cells.open_rows <= 0.01 * n
        monkeypatch.setattr(D, "STEP_BITS", 99)  # without refinement
        flat = D.refined_cells(D._addressed(rows, ["x"]))
        monkeypatch.setattr(D, "STEP_BITS", 4)
        shares.append((cells.open_rows / n, flat.open_rows / n))
    assert shares[2][1] > 0.05 and shares[2][0] <= 0.01


def test_only_shared_columns_count(spark, reference):
    cur = reference.drop("burst_flag").withColumn("extra", F.lit(1.0))
    assert D.shared_columns(reference, cur) == ["error_rate", "severity_mean"]


def test_shift_is_found(spark, reference):
    moved = D.shift_features(reference, ["severity_mean"])
    r = D.drift_report(D.ks_two_tables(reference, moved)).first()
    assert r["features_drifted"] == ["severity_mean"]
    assert r["recommendation"] == D.LEVELS[1][1]


def test_history_and_last_score(spark, reference, tmp_path):
    path = str(tmp_path / "history")
    assert tables.last_drift_score(tables.load_optional(spark, path), spark).first()[0] == 0.0
    ks = D.ks_two_tables(reference, reference)
    tables.append_drift_run(D.drift_report(ks), path, F.lit(1))
    tables.append_drift_run(D.drift_report(ks.withColumn("p_value", F.lit(0.01))), path, F.lit(2))
    rows = {r["run_ts"]: r for r in spark.read.parquet(path).collect()}
    assert rows[1]["features_drifted"] == "none" and rows[2]["n_features_drifted"] == 3
    assert tables.last_drift_score(tables.load_optional(spark, path), spark).first()[0] == 1.0


def test_no_features_report(spark):
    r = D.no_features_report(spark).first()
    assert r["drift_score"] == 0.0 and not r["drift_detected"] and r["recommendation"] == D.NO_FEATURES

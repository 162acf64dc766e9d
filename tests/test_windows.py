"""Both window plans against a direct count, on data with ties, nulls and a burst."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators.features import FeatureModel, fit_features
from emberlog.operators.windows import add_rolling_features

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("node", T.StringType()), T.StructField("component", T.StringType()),
        T.StructField("level", T.StringType()), T.StructField("content", T.StringType()),
        T.StructField("label", T.StringType()), T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("severity_score", T.ByteType()),
    ]
)


def bursty_rows(n=600, seed=1):
    """A third of the rows at one instant on one node; null times and nodes."""
    rng = np.random.default_rng(seed)
    base = datetime(2005, 6, 3, 15)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            ts, node = base + timedelta(minutes=20), "R00"
        else:
            ts = base + timedelta(seconds=int(rng.integers(0, 7200)), microseconds=int(rng.integers(0, 3)) * 333_333)
            node = f"R{rng.integers(0, 6):02d}"
        if i % 40 == 1:
            ts = None
        if i % 55 == 2:
            node = None
        sev = int(rng.integers(0, 5))
        level = ["INFO", "WARN", "ERROR", "SEVERE", "FATAL"][sev]
        rows.append((i, ts, node, f"C-{i % 3} x", level, f"m{i}", "-" if sev < 4 else "X", sev == 4, sev))
    return rows


def direct(rows, minutes):
    out = {}
    for r in rows:
        if r[1] is None:
            peers = [x for x in rows if x[1] is None]
        else:
            lo = r[1] - timedelta(minutes=minutes)
            peers = [x for x in rows if x[1] is not None and lo <= x[1] <= r[1]]
        sev = [x[8] for x in peers]
        out[r[0]] = (
            len(peers), sum(s >= 2 for s in sev), sum(s == 1 for s in sev), sum(s >= 3 for s in sev),
            round(sum(sev) / len(sev), 9), len({x[2] for x in peers if x[2] is not None}),
        )
    return out


@pytest.mark.parametrize("block_rows", [2_000_000, 0])
def test_frames_equal_direct_count(spark, block_rows):
    rows = bursty_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = add_rolling_features(df, block_rows=block_rows).collect()
    assert len(got) == len(rows)
    for w in (1, 5, 15):
        want = direct(rows, w)
        for g in got:
            have = (g[f"total_count_{w}min"], g[f"error_count_{w}min"], g[f"warning_count_{w}min"], g[f"fatal_count_{w}min"],
                    round(g[f"avg_severity_{w}min"], 9), g[f"unique_nodes_{w}min"])
            assert have == want[g["event_id"]], (w, g["event_id"])


def test_pipeline_schema_nulls_and_reload(spark, tmp_path):
    df = spark.createDataFrame(bursty_rows(300, 3), SCHEMA)
    model = fit_features(df)
    model.save(str(tmp_path / "m"))
    again = FeatureModel.load(spark, str(tmp_path / "m"))
    new = df.withColumn("node", F.lit("never seen")).withColumn("component", F.lit("other"))
    a, b = model.transform(df, ["event_id"]), again.transform(new, ["event_id"])
    assert a.columns == b.columns
    assert {"error_count_5min", "fatal_count_1min", "burst_flag", "node_error_ratio", "comp_c_0_x"} <= set(a.columns)
    types = dict(a.dtypes)
    assert all(types[c] == "float" for c in model.columns)
    pdf = a.toPandas()
    assert len(pdf) == 300
    assert not pdf[model.columns].isna().any().any()
    assert not b.toPandas()[model.columns].isna().any().any()


def test_robust_scale_zero_range_divides_by_one(spark):
    from emberlog.operators.features import robust_bounds, robust_scale

    pdf = pd.DataFrame({"k": range(5), "a": [1.0, 2.0, 3.0, 4.0, 100.0], "b": [7.0, 7.0, 7.0, 7.0, 9.0]})
    df = spark.createDataFrame(pdf)
    bounds = robust_bounds(df, ["a", "b"])
    assert bounds == {"a": (3.0, 2.0), "b": (7.0, 1.0)}
    rows = robust_scale(df, bounds, ["k"]).orderBy("k").collect()
    assert [r["b"] for r in rows] == [0, 0, 0, 0, 2]
    assert rows[4]["a"] == pytest.approx(48.5)


def test_largest_block_fits_a_python_worker_share():
    """A block task holds at most twice BLOCK_ROWS pairs; 4 of them share 4,000 MB."""
    import tracemalloc

    from emberlog.operators import windows

    rows = 2 * windows.BLOCK_ROWS
    block_us = 120 * 15 * windows.MINUTE_US
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 48, rows)
    pdf = pd.DataFrame({"us": np.sort(rng.integers(block_us, 2 * block_us, rows)),
                        "node": np.array([f"R{k % 24}-M{k % 2}" for k in range(48)], dtype=object)[codes],
                        **{c: rng.integers(0, 3, rows) for c in windows.SUMS}, "block": 1})
    tracemalloc.start()
    try:
        windows._block_frames(block_us, windows.WINDOW_MINUTES)(pdf)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1000 * 2**20

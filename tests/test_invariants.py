"""Results that must not depend on splits, time zone, table size or a missing side."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.functions.responses import parse_answers
from emberlog.operators import boundary, drift, forest, neighbors
from emberlog.operators.prefix import epoch_us, range_totals, time_at
from emberlog.sources import text


def test_event_ids_do_not_depend_on_splits(spark, tmp_path):
    lines = [f"- {k} 2005.06.03 R{k % 9} 2005-06-03-15.42.50.363779 R{k % 9} RAS KERNEL INFO line {k} " + "x" * (k % 70) for k in range(4000)]
    for part in range(3):
        (tmp_path / f"f{part}.log").write_text("\n".join(lines[part * 1300 : part * 1300 + 1300 if part < 2 else None]) + "\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("128m", "16k", "3k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = text.load_logs(spark, str(tmp_path)).select("event_id", "content").collect()
            got.append({r["event_id"]: r["content"].split()[1] for r in rows})
            head = text.load_logs(spark, str(tmp_path), nrows=1500).select("event_id").collect()
            assert sorted(r["event_id"] for r in head) == list(range(1500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert all(g == {k: str(k) for k in range(4000)} for g in got)


def test_microseconds_do_not_depend_on_the_session_zone(spark):
    times = ["2024-03-10 02:30:00", "2024-03-10 03:30:00", "1969-12-31 23:59:59.999999", "2005-06-03 15:42:50.363779"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        us = [r[0] for r in df.select(epoch_us(F.col("t"))).collect()]
        same = [df.where(F.col("t") == time_at(u, df.schema["t"].dataType)).count() for u in us]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert us == [1710037800000000, 1710041400000000, -1, 1117813370363779] and same == [1, 1, 1, 1]


def test_spans_that_share_an_instant(spark):
    events = spark.createDataFrame([(5, 1)] * 300 + [(9, 1), (2, 1)], "us long, n int")
    spans = spark.createDataFrame([(k, 5, 5) for k in range(200)] + [(900, 0, 9), (901, 6, 8)], "span_id long, lo long, hi long")
    got = {r["span_id"]: (r["n"], r["n_before"]) for r in range_totals(events, spans, ["n"]).collect()}
    assert got == {**{k: (300, 1) for k in range(200)}, 900: (302, 0), 901: (0, 301)}


@pytest.mark.parametrize("direct_below", [0, 10**9])
def test_drift_without_one_side(spark, direct_below):
    rows = spark.createDataFrame([(float(k), True) for k in range(40)], "x double, cur boolean")
    for side in (F.col("cur"), ~F.col("cur")):
        r = drift.ks_per_feature(rows, ["x"], side, direct_below).collect()
        assert [(x["ks"], x["p_value"], sorted((x["n_ref"], x["n_cur"]))) for x in r] == [(1.0, 1.0, [0, 40])]


def test_forest_draws_the_rows_it_is_asked_for(spark):
    rows = spark.range(3000).select(F.col("id").alias("event_id"), (F.col("id") * 1.0).alias("x"))
    trees = forest.fit_forest(rows, ["x"], "event_id", n_trees=12, take=1700)
    sizes = trees.where("depth = 0").select("size").collect()
    assert [r["size"] for r in sizes] == [1700] * 12
    cuts = {r["cut"] for r in trees.where("depth = 0").collect()}
    assert len(cuts) == 12


def test_boundary_stops_when_it_has_converged(spark):
    rng = np.random.default_rng(0)
    data = [(k, *map(float, v)) for k, v in enumerate(rng.normal(0, 1, (300, 3)))]
    rows = spark.createDataFrame(data, "event_id long, a double, b double, c double")
    flags = []
    for tolerance in (1e-4, 1e-7):
        model = boundary.fit_boundary(rows, ["a", "b", "c"], nu=0.05, dims=64, tolerance=tolerance)
        # at the optimum the rows on the boundary have a score of zero, up to the tolerance
        flags.append({r["event_id"] for r in rows.withColumn("s", model.score()).where(F.col("s") > 0.01 * model.rho).collect()})
    assert flags[0] and len(flags[0] & flags[1]) >= 0.9 * len(flags[0] | flags[1])


def test_answers_with_text_behind_the_object(spark):
    texts = ['{"resumen": "a"} y {"severidad": "HIGH"}', '{"resumen": "b", "severidad": "LOW"} {"x"}', '{"resumen": "c", "severidad": "MEDIUM"}', '[{"severidad": "HIGH"}]']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, response string")
    got = {r["id"]: (r["resumen"], r["severidad"]) for r in parse_answers(df).collect()}
    assert got[0] == ("a", "HIGH") and got[1] == ("b", "LOW") and got[2] == ("c", "MEDIUM")
    assert parse_answers(df).where("id = 1").first()["causa_probable"] == "N/A"


@pytest.mark.parametrize("kind", ["grid", "far"])
def test_neighbours_equal_brute_force_on_ties_and_far_from_the_origin(spark, kind, monkeypatch):
    monkeypatch.setattr(neighbors, "ROWS_PER_CELL", 10)
    monkeypatch.setattr(neighbors, "PLACED_ROWS", 30)
    rng = np.random.default_rng(9)
    data = rng.integers(0, 4, (160, 3)).astype(float) if kind == "grid" else rng.normal(1e9, 3.0, (160, 3))
    rows = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(data)], "id long, vec array<double>")
    train, asked = rows.where("id < 120"), rows.where("id >= 120")
    cells, tops = neighbors.build_cells(train, 120)
    assert cells.select("cell").distinct().count() > 2
    got = {}
    for r in neighbors.nearest_neighbours(asked, cells, neighbors.tree_of(cells, tops), 7).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    for k in range(120, 160):
        dist = np.sqrt(((data[k] - data[:120]) ** 2).sum(1))
        want = sorted(range(120), key=lambda j: (dist[j], j))[:7]
        assert [n for _, n in sorted(got[k])] == want


def test_cells_hold_as_many_rows_in_a_larger_table(spark, monkeypatch):
    """Ten times the rows, a third of them equal: as many rows a cell, ten times the cells, and few pivots on top."""
    monkeypatch.setattr(neighbors, "ROWS_PER_CELL", 50)
    seen = {}
    for n in (2_000, 20_000):
        rng = np.random.default_rng(1)
        data = rng.normal(size=(n, 3))
        data[: n // 3] = 1.0
        train = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "vec": list(data)}), "id long, vec array<double>")
        rows, tops = neighbors.build_cells(train, n)
        sizes = rows.where(f"id >= {n // 3}").groupBy("cell").count().toPandas()["count"]
        assert rows.count() == n and len(tops) <= round((n / 50) ** 0.5)
        seen[n] = (sizes.mean(), len(sizes))
    assert 0.5 < seen[20_000][0] / seen[2_000][0] < 2 and 5 < seen[20_000][1] / seen[2_000][1] < 20

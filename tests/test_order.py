"""Splits, positions, ranks, quantiles and samples on ties, nulls and hot values."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators.prefix import exact_quantiles, range_totals, running_totals
from emberlog.operators.ranking import percent_rank_average, top_k_per_group, uniform_sample, with_row_position
from emberlog.operators.split import temporal_slices, temporal_split

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tied(spark):
    """A third of the rows at one instant, wide 64-bit ids, some null times."""
    rng = np.random.default_rng(5)
    ids = [int(x) for x in rng.choice(2**62, 900, replace=False)]
    ids = [i if n % 2 else -i for n, i in enumerate(ids)]
    rows = []
    for n, i in enumerate(ids):
        ts = BASE + timedelta(hours=5) if n % 3 == 0 else BASE + timedelta(seconds=int(rng.integers(0, 40000)))
        rows.append((i, None if n % 50 == 0 else ts))
    df = spark.createDataFrame(rows, "event_id long, timestamp timestamp_ntz").cache()
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or BASE, r[0]))
    return df, [r[0] for r in order]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.45, 0.5, 0.6, 0.8, 0.99, 1.0])
def test_split_is_exact_at_any_cut(tied, share):
    df, order = tied
    got = {r["event_id"] for r in df.where(temporal_slices(df, (share,))[0]).collect()}
    assert got == set(order[: int(len(order) * share)])


def test_split_parts_cover_everything(tied):
    df, order = tied
    train, test = temporal_split(df, 0.2)
    assert train.count() == int(900 * 0.8) and train.count() + test.count() == 900


def test_split_filter_reaches_the_scan(spark, tied, tmp_path):
    df, _ = tied
    path = str(tmp_path / "t")
    df.write.parquet(path)
    for part in temporal_split(spark.read.parquet(path), 0.7):
        assert "Or(" in part._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1]


def test_positions(tied):
    df, order = tied
    got = {r["event_id"]: r["row_pos"] for r in with_row_position(df).collect()}
    assert got == {i: n for n, i in enumerate(order)}


@pytest.mark.parametrize("fine", [False, True])
def test_running_totals_levels(spark, fine):
    rng = np.random.default_rng(2)
    us = np.sort(rng.choice(3 * 3_600_000_000, 400, replace=False)) - 3_600_000_000
    pdf = pd.DataFrame({"us": us, "ord": 0, "n": rng.integers(0, 9, 400)})
    got = running_totals(spark.createDataFrame(pdf), ["n"], fine=fine).toPandas().sort_values("us")
    assert (got["run_n"].to_numpy() == pdf["n"].cumsum().to_numpy()).all()


@pytest.mark.parametrize("fine", [False, True])
def test_range_totals_equal_nested_loop(spark, fine):
    rng = np.random.default_rng(3)
    ev = pd.DataFrame({"us": rng.integers(0, 10_000_000, 300), "g": rng.choice(["a", "b"], 300), "n": 1})
    sp = pd.DataFrame({"span_id": range(50), "lo": rng.integers(0, 9_000_000, 50)})
    sp["hi"] = sp["lo"] + rng.integers(0, 3_000_000, 50)
    sp["g"] = rng.choice(["a", "b", "c"], 50)
    got = range_totals(spark.createDataFrame(ev), spark.createDataFrame(sp), ["n"], ["g"], fine).toPandas().set_index("span_id")
    for s in sp.itertuples():
        mine = ev[ev.g == s.g]
        assert got.loc[s.span_id, "n"] == ((mine.us >= s.lo) & (mine.us <= s.hi)).sum()
        assert got.loc[s.span_id, "n_before"] == (mine.us < s.lo).sum()


@pytest.mark.parametrize("leaf_rows", [7, 100_000])
def test_percent_rank_and_quantiles_with_hot_value(spark, monkeypatch, leaf_rows):
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(prefix, "FAN", 3)
    rng = np.random.default_rng(4)
    x = np.where(rng.random(1000) < 0.4, 0.5, rng.normal(size=1000))
    df = spark.createDataFrame(pd.DataFrame({"event_id": range(1000), "s": x, "t": rng.integers(0, 3, 1000).astype(float)}))
    got = percent_rank_average(df, "s").toPandas().sort_values("event_id")
    assert np.allclose(got["pct"], pd.Series(x).rank(pct=True))
    q = exact_quantiles(df, ["s", "t"], [0.0, 0.25, 0.5, 0.953, 1.0]).toPandas().set_index("feature")
    for c, data in (("s", x), ("t", df.toPandas()["t"].to_numpy())):
        assert np.allclose(q.loc[c, ["q0", "q1", "q2", "q3", "q4"]].astype(float), np.quantile(data, [0, 0.25, 0.5, 0.953, 1.0]))


def test_quantiles_survive_a_bad_sketch(spark, monkeypatch):
    """Brackets that miss the quantile only cost another pass."""
    from emberlog.operators import prefix

    x = np.random.default_rng(6).normal(size=500)
    x[:40] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": np.arange(500.0)}))
    monkeypatch.setattr(prefix, "_brackets", lambda *a: {"a": [(-9.0, -8.0)], "b": [(100.0, 130.0), (249.0, 250.0)]})
    q = exact_quantiles(df, ["a", "b"], [0.25, 0.5]).toPandas().set_index("feature")
    assert np.allclose(q.loc["a", ["q0", "q1"]].astype(float), np.nanquantile(x, [0.25, 0.5]))
    assert np.allclose(q.loc["b", ["q0", "q1"]].astype(float), [124.75, 249.5])


def test_sample_is_uniform_repeatable_and_sized(spark):
    df = spark.range(20_000).withColumnRenamed("id", "event_id")
    a = {r[0] for r in uniform_sample(df, 500).collect()}
    b = {r[0] for r in uniform_sample(df.repartition(13), 500).collect()}
    assert a == b and len(a) == 500
    assert 8000 < np.mean(list(a)) < 12000
    assert uniform_sample(df, 50_000).count() == 20_000


def test_top_k_per_group_prunes_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("g"), "id")
    out = top_k_per_group(df, ["g"], [F.col("id").desc()], 5)
    assert [r["id"] for r in out.orderBy("id").collect()] == [995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_leaves_stay_small_whatever_the_keys(spark, monkeypatch):
    """One far id and a third of the rows at one instant; the number of leaves grows with the rows, their size doesn't."""
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "LEAF_ROWS", 100)
    monkeypatch.setattr(prefix, "FAN", 4)
    largest = []
    for n in (2_000, 20_000):
        ids = [*range(n - 1), 2**62]
        rows = [(i, BASE if k % 3 else BASE + timedelta(seconds=k)) for k, i in enumerate(ids)]
        df = spark.createDataFrame(rows, "event_id long, timestamp timestamp_ntz")
        placed = prefix.range_leaves(df.withColumn("_us", prefix.epoch_us(F.col("timestamp"))), ["_us", "event_id"], prefix.leaves_for(n), "leaves")
        sizes = [r["count"] for r in placed.groupBy("_leaf").count().collect()]
        assert len(sizes) > 0.8 * n / 100
        largest.append(max(sizes))
        got = {r["event_id"]: r["row_pos"] for r in with_row_position(df).collect()}
        assert got == {i: k for k, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert max(largest) < 3 * 100


def test_tree_totals_open_no_window_beyond_the_fan(spark, monkeypatch):
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "FAN", 5)
    totals = spark.range(137).select((F.col("id") % 2).alias("g"), F.col("id").alias("_leaf"), (F.col("id") * 3).alias("_t_n"))
    got = {(r["g"], r["_leaf"]): r["_off_n"] for r in prefix.totals_before(totals, ["n"], ["g"], 137).collect()}
    assert got == {(i % 2, i): sum(3 * j for j in range(i) if j % 2 == i % 2) for i in range(137)}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ordered_totals_over_many_leaves(spark, monkeypatch, by):
    from emberlog.operators import prefix

    monkeypatch.setattr(prefix, "LEAF_ROWS", 50)
    monkeypatch.setattr(prefix, "FAN", 3)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "k": rng.permutation(3000) * 1e-3, "n": rng.integers(1, 5, 3000)})
    pdf.loc[0, "k"] = 1e12  # one far key
    got = prefix.ordered_totals(spark.createDataFrame(pdf), "k", ["n"], by).toPandas().sort_values("k")
    want = pdf.sort_values("k")
    run, whole = (want.groupby("g")["n"].cumsum(), want.groupby("g")["n"].transform("sum")) if by else (want["n"].cumsum(), want["n"].sum())
    assert (got["run_n"].to_numpy() == run.to_numpy()).all() and (got["all_n"].to_numpy() == np.broadcast_to(whole, 3000)).all()

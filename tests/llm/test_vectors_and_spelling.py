"""Nearest rows, whitening and spelling variants against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import multiindex as M
from emberlog.llm import spelling as S
from emberlog.llm import whitening as H
from emberlog.llm.queries import QUERIES
from emberlog.llm.tables import table

VECTORS = "vec_id long, embedding array<float>, label int"


def skewed_vectors(n=600, width=8, seed=1):
    """Rows with many exact copies, two directions, ties, nulls and rows that take no part."""
    g = np.random.default_rng(seed)
    rows = [(k, g.normal(size=width).astype(np.float32).tolist()) for k in range(n)]
    hot = g.normal(size=width).astype(np.float32).tolist()
    rows += [(n + k, hot) for k in range(n // 2)]  # a third of all rows are copies
    rows += [(3 * n, hot), (3 * n, hot), (3 * n + 20, [0.0] * width), (3 * n + 40, None), (3 * n + 60, [None] + hot[1:]), (3 * n + 80, [float("nan")] + hot[1:])]
    rows += [(3 * n + 100, [float("inf")] + hot[1:]), (None, hot), (None, None), (3 * n + 120, hot[:3]), (3 * n + 140, [])]
    return rows


def whole(rows, width, zero=False):
    """What takes part, padded, as doubles; equal rows once."""
    out = {}
    for k, v in rows:
        if v is None or any(c is None or not np.isfinite(c) for c in v) or not (zero or any(v)):
            continue
        v = np.array(list(v) + [0.0] * (width - len(v)), np.float32).astype(float)
        out[(k, v.tobytes())] = (k, v)
    return list(out.values())


def brute_nearest(rows, every, k):
    out = {}
    for i, v in rows:
        if i is None or i % every:
            continue
        scored = [(-float((v * w).sum()), j is None, j or 0) for j, w in rows if j != i]
        out[i] = [(None if null else j, -s) for s, null, j in sorted(scored)[:k]]
    return out


def lists_of(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_nearest_rows_find_nearly_all_and_score_exactly(spark):
    rows = skewed_vectors()
    got = lists_of(M.nearest_rows(spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS), every=20))
    there = whole(rows, 8)
    want = brute_nearest(there, 20, 20)
    vectors = {k: v for k, v in there}
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.9 * 20 * len(want)
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0] is None, x[0])) and len(set(near)) == 20 and all(i != q for i, _ in near)
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), rel=1e-12, abs=1e-12) for i, s in near)


def test_a_full_budget_is_the_exact_answer(spark):
    rows = skewed_vectors(300)
    asks = F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False))
    index = M.build(spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS), asks, k=7)
    everything = M.MultiIndex(index.books, index.counts, index.coded, index.width, int(index.counts.sum()))
    got, want = lists_of(M.search(everything, asks, 7)), brute_nearest(whole(rows, 8), 10, 7)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}


def test_nearest_rows_of_small_and_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert M.nearest_rows(empty).columns[:4] == ["query_id", "rank", "vec_id", "score"] and M.nearest_rows(empty).count() == 0
    assert M.nearest_rows(spark.createDataFrame([(0, None, 1), (20, [0.0], 1)], VECTORS)).count() == 0
    few = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1), (2, [-1.0], 1), (None, [2.0], 1)], VECTORS)
    assert [(r["vec_id"], r["score"]) for r in M.nearest_rows(few).orderBy("rank").collect()] == [(1, 2.0), (None, 2.0), (2, -1.0)]
    clash = few.select("*", *[F.lit(9).alias(c) for c in ("v", "cell", "tile", "kind", "hash", "rank", "score", "query_id", "n")])
    assert M.nearest_rows(clash).count() == 3
    doubles = few.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert M.nearest_rows(doubles).count() == 3


def test_the_heap_takes_cells_by_summed_distance():
    g = np.random.default_rng(5)
    da, db, counts = g.normal(size=7), g.normal(size=9), g.integers(0, 4, 63)
    cells, last = M.traverse(da, db, counts, 40)
    sums = (da[:, None] + db[None, :]).ravel()
    order = [c for c in np.argsort(sums, kind="stable") if counts[c]]
    assert cells == order[: len(cells)] and counts[cells].sum() >= 40 > counts[cells[:-1]].sum() and last == sums[cells[-1]]
    assert len(M.traverse(da, db, counts, 10**9)[0]) == (counts > 0).sum()


def test_tiles_split_crowded_cells():
    counts = np.array([3, 0, 100_000_000, 5, 9])
    first, parts = M.lay_tiles(counts)
    most = M.TILE_ROWS
    assert parts.tolist() == [1, 1, -(-100_000_000 // most), 1, 1]
    assert first[2] == 1 and first[3] == first[4] == 1 + parts[2]


def test_recall_of_the_registered_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    got = lists_of(QUERIES["op11_nearest_rows"](spark, sf))
    ids, v = np.array([k for k, _ in rows]), np.array([x for _, x in rows], float)
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({i for i, _ in got[q]} & set(ids[np.argsort(-s, kind="stable")[:20]].tolist()))
    assert len(got) == (ids % 20 == 0).sum() and hits >= 0.9 * 20 * len(got)


# ---------------------------------------------------------------- whitening


def reference_whitening(rows, width, components=16):
    kept = [(k, np.floor(64 * v).astype(np.int64) + 1_000_000) for k, v in rows]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, s = len(fit), [int(c) for c in fit.sum(axis=0)]
    centred = fit - np.array(s, float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, s, e[::-1][:components], u[:, ::-1][:, :components], e.sum()


def check_whitening(got, rows, width, components):
    kept, n, s, e, u, total = reference_whitening(rows, width, components)
    assert len(got) == len(kept) * len(e)
    mine = defaultdict(list)
    for r in got:
        mine[(r["vec_id"], r["component"])].append(r)
    sign = {}
    for k, x in kept:
        deviation = sum((n * int(a) - b) ** 2 for a, b in zip(x, s))
        want = (x - np.array(s, float) / n) @ u / np.sqrt(e)
        for c in range(1, len(e) + 1):
            same = [r for r in mine[(k, c)] if r["deviation"] == deviation]
            assert same and all(r["n"] == n and r["explained"] == pytest.approx(e[c - 1] / total, rel=1e-9) and r["identity_error"] < 1e-9 for r in same)
            if abs(want[c - 1]) > 0.1:
                turn = sign.setdefault(c, np.sign(want[c - 1] * same[0]["whitened"]))
                assert any(r["whitened"] == pytest.approx(turn * want[c - 1], rel=1e-6, abs=1e-7) for r in same)


def test_whitening_of_skewed_rows(spark):
    rows = skewed_vectors(200)
    got = H.whiten(spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS).repartition(5)).collect()
    alive = [(k, np.array(list(v) + [0.0] * (8 - len(v)), np.float32).astype(float)) for k, v in rows if v is not None and not any(c is None or not np.isfinite(c) for c in v)]
    check_whitening(got, alive, 8, 16)


def test_whitening_of_the_registered_query(spark, sf_dir):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in table(spark, sf_dir, "embeddings").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, sf_dir).collect(), rows, 64, 16)


def test_whitening_keeps_its_digits_where_the_covariance_loses_them(spark):
    """Scales 10^6 apart: squaring their condition would leave no digit of the small one."""
    g = np.random.default_rng(3)
    x = np.column_stack([g.normal(size=400) * 1e7, g.normal(size=400) * 30, np.full(400, 2.0)])
    x[:, 1] += x[:, 0]  # nearly dependent
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = H.whiten(frame).collect()
    assert {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-6 for r in got)
    fit = np.floor(64 * x)
    s = np.linalg.svd(fit - fit.mean(axis=0), compute_uv=False)
    assert next(r["explained"] for r in got if r["component"] == 2) == pytest.approx(s[1] ** 2 / (s**2).sum(), rel=1e-4)


def test_whitening_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert H.whiten(empty).collect() == [] and H.whiten(empty).columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert H.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)).collect() == []  # one distinct row
    assert H.whiten(spark.createDataFrame([(1, [], 0), (2, None, 0)], VECTORS)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0), (None, [3.0, 2.0], 0)], VECTORS)
    clash = two.select("*", *[F.lit(1).alias(c) for c in ("x", "n", "i", "component", "deviation")])
    got = H.whiten(clash).collect()
    assert sorted(abs(r["whitened"]) for r in got) == pytest.approx([1, 1, 1]) and {r["n"] for r in got} == {2} and {r["explained"] for r in got} == {1.0}
    huge = spark.createDataFrame([(1, [1e300, 1.0], 0), (2, [-1e300, 3.0], 0), (3, [5.0, 4.0], 0)], "vec_id long, embedding array<double>, label int")
    assert {r["deviation"] for r in H.whiten(huge).where("vec_id < 3").collect()} == {None}


# ---------------------------------------------------------------- spelling


def brute_variants(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    form = {}
    for w in n:
        around = [v for v in n if v != w and near(v, w)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
        out[w] = len(around)
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return sorted(rows)


def spelled():
    text = lambda w, k: " ".join([w] * k)
    rows = [(1, text("kitten_kitten", 400)), (2, text("Kittens", 60) + " " + text("kitten.", 30)), (3, text("kiitten", 7) + text(" mitten", 25))]
    rows += [(4, text("sitten", 5) + " " + text("kkitten", 5)), (5, text("kitte", 50)), (6, text("ÉCOLES", 9) + " " + text("écoles", 50) + " " + text("écolés", 7))]
    rows += [(7, None), (None, "nothing here"), (None, text("banana", 6)), (8, ""), (9, text("baanana", 6)), (10, text("baaanana", 6) + " " + text("banan", 9))]
    rows += [(11, "x" * 40_000), (12, text("y" * 300, 5)), (13, text("y" * 299 + "z", 30)), (14, "straße×÷ " * 8), (15, "stra$e " * 8), (15, "strasse " * 6), (15, "strasse " * 6)]
    # chains of forms, and many documents, so that some occurrences lose a letter
    rows += [(100 + k, " ".join([w] * m)) for k in range(60) for w, m in (("aaaaaa", 500), ("aaaaab", 20), ("aaaabb", 1))]
    rows += [(1000 + k, "garden gardens garden " + "".join(chr(97 + (k * 7 + j) % 26) for j in range(7))) for k in range(600)]
    return rows


def test_spelling_variants_equal_brute_force(make_docs):
    got = sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in S.variants(make_docs(spelled()).repartition(6)).collect())
    want = brute_variants(spelled())
    assert got == want
    by = {r[0]: r for r in want}
    assert by["aaaabb"][1:3] == ("aaaaab", "aaaaaa") and by["baanana"][4] == 2 and by["kittens"][1] == "kitten"


def test_spelling_of_the_registered_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in QUERIES["op12_spelling_variants"](spark, sf_dir).collect())
    assert got == brute_variants(rows)


def test_spelling_of_odd_tables(spark, make_docs):
    assert S.variants(make_docs([])).collect() == [] and S.variants(make_docs([(1, None), (None, "")])).collect() == []
    clash = make_docs([(1, "garden " * 40 + "gardon " * 5)]).select("*", *[F.lit("q").alias(c) for c in ("word", "n", "form", "id", "run", "slot", "h")])
    assert sorted((r["word"], r["form"]) for r in S.variants(clash).collect()) == [("garden", None), ("gardon", "garden")]


def test_a_slot_holds_at_most_one_word_a_letter(spark, make_docs):
    vocabulary = S.words(make_docs(spelled()))
    largest = S.slots(vocabulary).groupBy("slot").agg(F.count("*").alias("n"), F.count_if("whole").alias("w")).agg(F.max("n"), F.max("w")).first()
    assert largest[0] <= 91 and largest[1] == 1

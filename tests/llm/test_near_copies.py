"""Near copies and components against brute force."""

from __future__ import annotations

import random
import re

from emberlog.llm import nearcopies as N
from emberlog.llm.graph import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()


def brute(rows, num, den):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t))
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def variant(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed=3):
    rng = random.Random(seed)
    rows, i = [], 0
    for cluster, copies, edits in ((200, 6, 1), (120, 12, 2), (90, 40, 2), (60, 3, 1)):
        words = [f"w{rng.randrange(500)}" for _ in range(cluster)]
        for _ in range(copies):
            rows.append((i, variant(rng, words, rng.randrange(edits + 1))))
            i += 1
    rows += [(i + k, " ".join(f"w{rng.randrange(500)}" for _ in range(40))) for k in range(40)]
    i += 40
    rows += [(i, None), (i + 1, ""), (i + 2, "one two"), (i + 3, "One  TWO"), (i + 4, " \t\n"), (i + 5, "a " * 30_000)]
    rng.shuffle(rows)
    return rows


def check(spark, rows, num, den, **how):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component long")
    got = N.near_duplicates(docs, num, den, **how).collect()
    want = brute(rows, num, den)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"]), r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = sorted(r["n_shingles"] for r in got)
    assert sizes == sorted(len(shingle_set(t)) for _, t in rows)


def test_components_equal_brute_force(spark):
    check(spark, corpus(), 85, 100)


def test_groups_over_a_chunk_are_joined_exactly(spark):
    """Every group is cut into chunks of five, every node branches."""
    check(spark, corpus(4), 85, 100, small=2, chunk=5)


def test_repeated_ids_and_rows_without_id(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A B C D E F G"), (None, "a b c d e f g"), (None, "z"), (3, "q r s t u"), (2, "q r s t u")]
    check(spark, rows, 80, 100)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(docs).collect() == [] and N.keep_one(docs).collect() == []


def test_keep_one_keeps_columns_and_clean_documents(spark, make_docs):
    rows = corpus(5)
    docs = make_docs(rows)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute(rows, 80, 100)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_recall_bound():
    assert N.missed(0.85) < 0.01 and N.missed(0.8) < 0.02


def test_trees_follow_the_threshold(make_docs, monkeypatch):
    for s in (0.7, 0.8, 0.85, 0.95):
        assert N.missed(s, N.trees_for(s)) <= N.MISS < N.missed(s, N.trees_for(s) - 1)
    assert N.trees_for(1.0) == 1
    asked, sketch = [], N.sketches
    monkeypatch.setattr(N, "sketches", lambda docs, k, n: asked.append(n) or sketch(docs, k, n))
    N.keep_one(make_docs([(1, "a b c d e f")]))
    assert N.missed(0.8, asked[0] // N.DEPTH) <= N.MISS


def test_components_of_a_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["v"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}


def test_words_that_cancel_in_a_polynomial_hash_are_no_link(make_docs):
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(make_docs(rows), num=85, den=100).collect()}
    assert got == {1: 1, 2: 2, 3: 1}

"""Mixing and sharding against their laws and the one-by-one schedule."""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import mixing as M
from emberlog.llm import sharding as S


def corpus():
    rows = [(k, " ".join(f"w{j}" for j in range((k * 37) % 300)), f"s{k % 7}") for k in range(300)]
    rows += [(1000 + k, "hot " * 200, "hot") for k in range(150)]  # one source holds a third
    rows += [(2000, None, "s1"), (2001, "", None), (2002, "a b c", None), (2003, " \n ", "s2"), (None, "no id here", "s3"), (3000, "twice", "s4"), (3000, "twice", "s4")]
    return rows


def water(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    cut, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in cut]
        level = (total - sum(cut.values())) / max(sum(weight[s] for s in rest), 1)
        over = [s for s in rest if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: cut.get(s, weight[s] * level) for s in names}
        cut.update({s: 3.0 * sizes[s] for s in over})


def test_targets_and_taken_words(make_docs):
    rows = corpus()
    got = M.taken_words(make_docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, source = Counter(), {}
    for i, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
        source[i] = s
    want, taken = water(dict(sizes)), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= M.BLOCK_WORDS for s in want)
    again = M.taken_words(make_docs(rows).repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["taken"])
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr) and len(set(map(key, got))) > 300


def test_quotas_and_capacities_hold_and_runs_are_disjoint(make_docs):
    _, sources, drawn = M.mix(make_docs(corpus()), block_words=16, shards=5)
    rows = drawn.collect()
    per_shard = Counter(r["shard"] for r in rows)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and set(per_shard) == set(range(5))
    assert len({(r["row"], r["block"], r["pass"]) for r in rows}) == len(rows)
    times = Counter((r["row"], r["block"]) for r in rows)
    assert max(times.values()) <= 3


def test_split_is_hypergeometric(spark):
    """Over many seeds, a source's share of a shard has the mean and variance of drawing without replacement."""
    quotas = spark.createDataFrame([(0, 40), (1, 60), (2, 20)], "rank long, quota long")
    drawn = defaultdict(list)
    for seed in range(60):
        total = np.zeros(4, int)
        for r in M.split_quotas(quotas, 4, seed).collect():
            assert sum(r["counts"]) == {0: 40, 1: 60, 2: 20}[r["rank"]]
            drawn[r["rank"]].append(r["counts"][0])
            total += r["counts"]
        assert total.tolist() == [30, 30, 30, 30]
    for rank, k in ((0, 40), (1, 60), (2, 20)):
        p = k / 120
        sd = np.sqrt(30 * p * (1 - p) * 90 / 119)
        assert abs(np.mean(drawn[rank]) - 30 * p) < 4 * sd / np.sqrt(60)
        assert 0.6 < np.std(drawn[rank]) / sd < 1.5


def test_hypergeometric_inverts_its_distribution(spark):
    from math import comb

    n, k, d = 30, 12, 9
    p = [comb(k, x) * comb(n - k, d - x) / comb(n, d) for x in range(d + 1)]
    grid = spark.range(4000).select(M.hypergeometric(F.lit(n), F.lit(k), F.lit(d), (F.col("id") + 0.5) / 4000).alias("x"))
    got = {r["x"]: r["count"] / 4000 for r in grid.groupBy("x").count().collect()}
    assert all(abs(got.get(x, 0) - p[x]) < 2e-3 for x in range(d + 1))


def test_mixed_documents_are_whole_rows(make_docs):
    docs = make_docs(corpus())
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(v for i, v in times.items() if i != 3000) <= 3
    texts = {r["text"] for r in docs.collect()}
    assert all(r["text"] in texts and r["text"].strip() for r in out.collect())


def test_blocks_are_shuffled_inside_their_shard(make_docs):
    _, _, drawn = M.mix(make_docs(corpus()), block_words=16, shards=5)
    rows = M.shuffled(drawn).collect()
    assert len(rows) == drawn.count()
    for shard in range(5):
        own = sorted((r for r in rows if r["shard"] == shard), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        keys = [r["local_key"] % (1 << 64) for r in own]
        assert keys == sorted(keys)
        hot = [r["place"] for r in own if r["source"] == "hot"]  # not in one run
        assert np.mean(np.diff(hot) > 1) > 0.1


def test_first_places_are_rows_of_the_shuffle(make_docs):
    got = M.taken_words(make_docs(corpus())).collect()
    first = [(r["first_shard"], r["first_place"]) for r in got if r["taken"]]
    assert len(set(first)) == len(first) and all(s in range(M.SHARDS) and p >= 0 for s, p in first)
    assert all(r["first_shard"] is None and r["first_place"] is None and not r["n_shards"] for r in got if not r["taken"])


def test_mixed_documents_keep_columns_of_any_name(make_docs):
    docs = make_docs(corpus())
    names = ["_pass", "_times", "_th", "_id", "_source", "units", "part", "shard", "local_key", "row", "th", "doc", "a.b", "size"]
    wide = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce("text", F.lit(""))).alias(n) for n in names])
    out = M.mixed_documents(wide)
    assert out.columns == wide.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n} of {r['text']}" for r in rows for n in names)
    plain = M.mixed_documents(docs)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in plain.collect())


def test_mixed_documents_come_in_the_order_of_the_mix(make_docs):
    docs = make_docs([(i, t, s) for i, t, s in corpus() if i != 3000])
    rows, _, drawn = M.mix(docs, None, 4, once=True)
    placed = M.shuffled(drawn).collect()
    out = M.mixed_documents(docs, shards=4).collect()
    assert [r["doc_id"] for r in out] == [r["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["place"]))]


def test_mix_of_nothing(make_docs):
    docs = make_docs([])
    assert M.taken_words(docs).collect() == [] and M.mixed_documents(docs).collect() == []
    words = M.taken_words(make_docs([(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in words] == [(0, 0.0, 0)] * 2


def one_by_one(sizes, shards):
    heap = [(0, k) for k in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, k))
    return sorted(x for x, _ in heap)


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_equal_groups_equal_the_one_by_one_schedule(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 60, 3000) if seed % 2 else np.concatenate([rng.integers(500, 9000, 40), np.full(2000, 7), np.ones(900, int)])
    values, counts = np.unique(sizes, return_counts=True)
    deal = S.longest_first(values[::-1], counts[::-1], (values * counts)[::-1], 16)
    assert deal.sum(1).tolist() == counts[::-1].tolist()
    assert sorted((deal * values[::-1, None]).sum(0).tolist()) == one_by_one(sizes.tolist(), 16)


def test_shards(make_docs):
    rows = corpus()
    got = S.assign_shards(make_docs(rows)).collect()
    assert len(got) == len(rows)
    load, slots, groups, bytes_of = Counter(), defaultdict(list), defaultdict(set), Counter()
    by_crc = {zlib.crc32((t or "").encode()): t or "" for _, t, _ in rows}
    for r in got:
        text = by_crc[r["text_crc32"]]
        assert r["size"] == len(text.encode()) + 1 and r["law"] == "bytes" and r["grown_shard"] is None
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[text].add(r["shard"])
        bytes_of[text] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    assert sorted(load[k] for k in range(16)) == one_by_one(bytes_of.values(), 16)


def test_shards_of_nothing(make_docs):
    assert S.assign_shards(make_docs([])).collect() == []

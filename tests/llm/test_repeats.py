"""Repeated byte strings against brute force; suffix arrays and common prefixes by themselves."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from emberlog.llm import suffixes as S


def brute(rows):
    """Rows (doc_id, text); equal rows are one document."""
    order = sorted(set((i if i is not None else S.LAST, t or "") for i, t in rows))
    seen, out = set(), {}
    ids = [i for i, _ in order]
    assert len(set(ids)) == len(ids), "rows of one id are ordered by hash"
    for i, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    passage = " ".join(word() for _ in range(60))
    rows, i = [], 0
    for _ in range(40):
        text = " ".join(word() for _ in range(rng.randrange(5, 120)))
        if rng.random() < 0.5:
            cut = rng.randrange(len(text))
            at = rng.randrange(80)
            text = text[:cut] + passage[at : at + rng.randrange(60, 260)] + text[cut:]
        rows.append((i, text))
        i += 1
    base = " ".join(word() for _ in range(150))
    for _ in range(12):  # near copies
        at = rng.randrange(len(base) - 3)
        rows.append((i, base[:at] + "#" + base[at + 1 :]))
        i += 1
    rows += [(i, base), (i + 1, base), (i + 2, "a" * 700), (i + 3, "ab" * 300), (i + 4, None), (i + 5, ""), (i + 6, "x" * 99), (i + 7, "x" * 100), (i + 8, "x" * 101)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_bytes", [S.SHARD_BYTES, 300])
def test_equals_brute_force(spark, shard_bytes):
    """With shards of 300 bytes most grams span several shards, so windows are merged by binary search."""
    rows = corpus(7)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, size int").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.remove_repeats(docs, shard_bytes).collect()}
    assert got == brute(rows)


def test_equal_rows_and_rows_without_id(spark):
    text = "q" * 60 + "r" * 90
    rows = [(1, text), (1, text), (None, text), (2, text)]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    own = brute([(1, text)])[1][1]
    assert got == [(False, 1, own), (False, 1, own), (False, 2, 150), (True, 0, 150)]


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 2 + seed, 700).astype(np.uint8)
    data[200:400] = data[0:200]
    raw = data.tobytes()
    order = S.suffix_array(data)
    assert order.tolist() == sorted(range(len(raw)), key=lambda p: raw[p:])
    prefixes = S.common_prefixes(data, order)

    def shared(a, b):
        n = 0
        while n < 100 and a + n < len(raw) and b + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert prefixes.tolist() == [0] + [shared(order[k - 1], order[k]) for k in range(1, len(raw))]

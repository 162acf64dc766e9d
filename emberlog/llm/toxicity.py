"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the bag of its byte n-grams (3 to 6, with end marks) and itself;
n-grams share a table of embeddings by hash, so a misspelling shares most of its
vectors with the word it comes from. A word's vector is the mean over its bag,
the vector of a passage of ``PASSAGE`` words the mean over its different words
(filled up with zeros, so that a word said over and over weighs as one), and a linear softmax over that gives the
probability; a text is as toxic as its worst passage, whatever its length.

Embeddings and softmax are trained together, in numpy, by full-batch descent on
a bounded sample of labelled documents (``per_class`` of each class, drawn by id
hash); every step learns from each document's worst passage so far, which for
clean documents is the most misleading one. Embeddings start from how much more
often an n-gram occurs in toxic texts, in standard errors. Both classes weigh
alike. Scoring needs one number per n-gram bucket, the embedding's product with
the softmax, and covers every word of every text.

Defined cases: null and empty texts have no words and get the bias's
probability; without labels of both classes the share of toxic labels is the
score (0.5 without any label). Labels that repeat count as toxic if one is; rows
that repeat are scored alike. Extra columns pass through or are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K
from emberlog.llm.tables import id_fold

PER_CLASS, BUCKETS, DIM, EPOCHS, RATE = 1000, 1 << 18, 4, 60, 0.03
LEAST_TEXTS, NOISE, DECAY, PASSAGE, SHARP = 3, 3.0, 0.002, 32, 8.0
LOW_N, HIGH_N = 3, 6
REJECT = 0.7


def distinct_words(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Index of one occurrence of each distinct word, and every word's place among them."""
    _, one, where = np.unique(w.hash, return_index=True, return_inverse=True)
    return one, where


def ngrams(data: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int):
    """Per n, the buckets of all n-grams of the marked words, and their offsets by word."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size + 2)])
    chars = np.full(at[-1], ord("<"), np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    chars[np.repeat(at[:-1] + 1, size) + inside] = K.LOWER[data[np.repeat(start, size) + inside]]
    chars[at[1:] - 1] = ord(">")
    code = K.mix(chars.astype(np.uint64) + K.GOLDEN)
    left = np.repeat(at[1:], size + 2) - np.arange(at[-1])  # bytes to the word's end
    rolled = code.copy()
    for n in range(2, HIGH_N + 1):
        rolled[: len(rolled) - n + 1] = rolled[: len(rolled) - n + 1] * K.STEP + code[n - 1 :]
        if n >= LOW_N:
            has = left >= n
            count = np.maximum(size + 3 - n, 0)
            yield (K.mix(rolled[has] + K.salt(n)) & np.uint64(buckets - 1)).astype(np.int64), np.concatenate([[0], np.cumsum(count)])
    whole = np.add.reduceat(code * K.powers(int(size.max()) + 2)[np.repeat(size + 2, size + 2) - left], at[:-1])
    yield (K.mix(whole) & np.uint64(buckets - 1)).astype(np.int64), np.arange(len(size) + 1)


def passages(first: np.ndarray, where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words of every passage: (words, offsets of the passages in them, offsets of the texts in the passages)."""
    n = np.diff(first)
    count = -(-n // length)
    text_edge = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    passage = np.repeat(text_edge[:-1], n) + at // length
    size = int(where.max()) + 1 if len(where) else 1
    pair = np.sort(passage * np.int64(size) + where)
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else pair
    return pair % size, np.searchsorted(pair // size, np.arange(text_edge[-1] + 1)), text_edge


def _bags(texts: pa.Array, buckets: int):
    """The mean word of every text over n-gram buckets, sparse: (text, bucket, share), sorted."""
    data, at = K.text_bytes(texts)
    rows, ids, shares = [], [], []
    for lo, _, part, offs in K.pieces(data, at, 1 << 18):
        w = K.words(part, offs)
        if not len(w.start):
            continue
        one, where = distinct_words(w)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
        pair, tf = np.unique(doc * len(one) + where, return_counts=True)
        pdoc, pword = pair // len(one), pair % len(one)
        grams = list(ngrams(part, w.start[one], w.end[one], buckets))
        per_word = sum(np.diff(first) for _, first in grams)
        share = tf / np.diff(w.first)[pdoc] / per_word[pword]
        key, value = [], []
        for flat, first in grams:
            n = np.diff(first)[pword]
            key.append(np.repeat(pdoc, n) * buckets + flat[np.repeat(first[pword], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
            value.append(np.repeat(share, n))
        key, to = np.unique(np.concatenate(key), return_inverse=True)
        rows.append(key // buckets + lo)
        ids.append(key % buckets)
        shares.append(np.bincount(to, weights=np.concatenate(value)).astype(np.float32))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(shares)


def _evidence(row: np.ndarray, col: np.ndarray, labels: np.ndarray, n_cols: int) -> np.ndarray:
    """Per n-gram, by how many standard errors its share of toxic texts exceeds that of others, beyond ``NOISE``."""
    pos, neg = labels.sum(), (1 - labels).sum()
    in_pos = np.bincount(col, weights=labels[row], minlength=n_cols)
    in_all = np.bincount(col, minlength=n_cols)
    p = in_all / len(labels)
    z = (in_pos / pos - (in_all - in_pos) / neg) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / pos + 1 / neg))
    return np.sign(z) * np.maximum(np.abs(z) - NOISE, 0)


def _train(texts: pa.Array, labels: np.ndarray, buckets: int, dim: int, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, what an n-gram adds to the toxic margin of its word; the bias."""
    weights = np.zeros(buckets, np.float32)
    row, ids, _ = _bags(texts, buckets)
    often = np.bincount(ids, minlength=buckets) >= LEAST_TEXTS
    used = np.flatnonzero(often)
    if not len(used):
        return weights, np.zeros(1)
    number = np.cumsum(often) - 1
    start = _evidence(row[often[ids]], number[ids[often[ids]]], labels, len(used))
    # words as runs of kept n-grams
    data, at = K.text_bytes(texts)
    w = K.words(data, at)
    one, where = distinct_words(w)
    grams = list(ngrams(data, w.start[one], w.end[one], buckets))
    per_word = sum(np.diff(first) for _, first in grams).astype(np.float32)
    owner = np.concatenate([np.repeat(np.arange(len(one)), np.diff(first)) for _, first in grams])
    flat = np.concatenate([flat for flat, _ in grams])
    owner, flat = owner[often[flat]], number[flat[often[flat]]]
    order = np.argsort(owner, kind="stable")
    owner, flat = owner[order], flat[order]
    known, known_first = np.unique(owner, return_index=True)
    said, edge, doc_edge = passages(w.first, where, PASSAGE)
    with_words = np.flatnonzero(np.diff(doc_edge))
    doc_of = np.repeat(np.arange(len(labels)), np.diff(doc_edge))

    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.01, (len(used), dim)).astype(np.float32)
    emb[:, 0] += start / max(np.abs(start).max(), 1e-9)
    soft = rng.normal(0, 0.1, (dim, 2)).astype(np.float32)
    soft[0] = [-SHARP * PASSAGE, SHARP * PASSAGE]
    params = [emb, soft, np.array([1.0, -1.0], np.float32)]
    speed = [np.zeros_like(p) for p in params]
    balance = np.array([1 - labels.mean(), labels.mean()])
    importance = (0.5 / balance[labels] / len(labels)).astype(np.float32)[:, None]
    target = np.eye(2, dtype=np.float32)[labels]
    vec = np.zeros((len(one), dim), np.float32)
    for epoch in range(epochs):
        emb, soft, bias = params
        vec[known] = np.add.reduceat(emb[flat], known_first) / per_word[known, None]
        bag = np.add.reduceat(vec[said], edge[:-1]) / PASSAGE
        margin = bag @ (soft[:, 1] - soft[:, 0])
        worst = np.full(len(labels), -1)
        top = np.maximum.reduceat(margin, doc_edge[:-1][with_words])
        hit = np.flatnonzero(margin == np.repeat(top, np.diff(doc_edge)[with_words]))
        at_doc, first_hit = np.unique(doc_of[hit], return_index=True)
        worst[at_doc] = hit[first_hit]
        has = worst >= 0
        chosen = np.where(has[:, None], bag[worst], 0)
        logit = chosen @ soft + bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d_logit = (p - target) * importance
        d_bag = (d_logit @ soft.T)[has] / PASSAGE
        lo, n = edge[worst[has]], edge[worst[has] + 1] - edge[worst[has]]
        words = said[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        doc = np.repeat(np.arange(len(lo)), n)
        d_vec = np.stack([np.bincount(words, weights=d_bag[doc, i], minlength=len(one)) for i in range(dim)], 1) / per_word[:, None]
        touched = np.flatnonzero(d_vec.any(1)[owner])
        d_emb = np.stack([np.bincount(flat[touched], weights=d_vec[owner[touched], i], minlength=len(used)) for i in range(dim)], 1)
        # One step length per block, not per number: n-grams that many texts share
        # move far, those of a few hardly move.
        for q, v, g in zip(params, speed, (d_emb, chosen.T @ d_logit, d_logit.sum(0))):
            v *= 0.8
            v += 0.2 * g
            scale = max(float(np.abs(v).max()), 1e-9)
            q -= RATE * (1 - epoch / epochs) * max(float(np.abs(q).max()), 1.0) * v / scale
        params[0] *= 1 - DECAY
    emb, soft, bias = params
    weights[used] = emb @ (soft[:, 1] - soft[:, 0])
    return weights, np.array([bias[1] - bias[0]], np.float64)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Train on at most ``per_class`` documents of each class among ``labels`` (``doc_id, toxic``).

    The driver gets the model: ``buckets`` floats.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    neg, pos = counts.get(0, 0), counts.get(1, 0)
    share = float(np.log((pos + 1e-6) / (neg + 1e-6))) if pos + neg else 0.0
    constant = np.zeros(buckets, np.float32), float(np.clip(share, -10, 10))
    if not pos or not neg:
        return constant
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    ids = F.broadcast(drawn[0].unionAll(drawn[1]))  # at most 2 * per_class rows
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def train(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks().sort_by("doc_id")
        y = table.column("toxic").to_numpy().astype(np.int64)
        if len(set(y.tolist())) == 2:
            weights, bias = _train(table.column("text"), y, buckets, dim, epochs)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array(bias)], ["weights", "bias"])

    model = sample.repartition(1).mapInArrow(train, "weights binary, bias double").collect()
    if not model:
        return constant
    return np.frombuffer(model[0]["weights"], np.float32), float(model[0]["bias"])


def text_scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of a toxic text for every row of a text column."""
    data, at = K.text_bytes(column)
    out = np.zeros(len(column))
    for lo, hi, part, offs in K.pieces(data, at):
        w = K.words(part, offs)
        margin = np.zeros(hi - lo)
        if len(w.start):
            one, where = distinct_words(w)
            total, count = np.zeros(len(one)), np.zeros(len(one))
            for ids, first in ngrams(part, w.start[one], w.end[one], len(weights)):
                total += K.sums_by_row(weights[ids].astype(np.float64), first)
                count += np.diff(first)
            said, edge, text_edge = passages(w.first, where, PASSAGE)
            bag = K.sums_by_row((total / count)[said], edge) / PASSAGE
            filled = np.flatnonzero(np.diff(text_edge))
            margin[filled] = np.maximum.reduceat(bag, text_edge[:-1][filled])
        out[lo:hi] = 1 / (1 + np.exp(-np.clip(margin + bias, -500, 500)))
    return out


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` per row."""
    weights, bias = model

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text_scores(batch.column("text"), weights, bias))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def clean(docs: DataFrame, model: tuple[np.ndarray, float], reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that score below ``reject``, all columns, without a shuffle."""
    weights, bias = model

    def run(batches):
        for batch in batches:
            yield batch.filter(pc.less(pa.array(text_scores(batch.column("text"), weights, bias)), reject))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels of the training folds: crc32 of the id, modulo 3, is not 1."""
    return labels.where(id_fold("doc_id", 3) != 1).select("doc_id", "toxic")

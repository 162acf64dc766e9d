"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs (lines that are not blank). Each
paragraph hashes to a wide vector of 32-bit lanes; a document's fingerprint is
the sum of its paragraphs' vectors modulo 2 ** 32, lane by lane. So the order of
paragraphs doesn't matter, and adding or taking away a paragraph adds or
subtracts its vector (``changed``) without the rest of the text.

The first ``EXACT`` lanes of a paragraph's vector are the 512 bits of its
SHA-512: documents of different multisets agree in all of them only by a
collision of such sums, which nobody is expected to meet. In the other ``LIKE`` lanes a
paragraph adds +1 or -1 for each of its 3-word shingles, so the cosine of two
sums estimates how much the two documents share (``likeness``: 1 for equal
fingerprints, about 0 for unrelated ones).

``with_next`` gives every document its successor by doc_id without a global
window: documents go to key ranges, and each range also gets the first document
of the next one.

Defined cases: a null text is an empty one; rows of one doc_id follow each other
by text hash, rows without id come last; a single document follows itself; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K
from emberlog.llm.tables import shuffle_parts
from emberlog.operators.prefix import with_bucket

EXACT, LIKE, SHINGLE, MOST_RANGES, DRAWN = 16, 128, 3, 65_536, 32


def paragraphs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the lines of all rows, and the row of each line."""
    breaks = np.flatnonzero(data == 10) + 1
    edges = np.union1d(breaks, at)
    return edges, np.searchsorted(at, edges[:-1], "right") - 1


def fingerprints(column: pa.Array) -> np.ndarray:
    """Lanes (rows by EXACT + LIKE) of every text of a column."""
    data, offsets = K.text_bytes(column)
    out = np.zeros((len(column), EXACT + LIKE), np.uint32)
    for lo, hi, part, at in K.pieces(data, offsets):
        n = hi - lo
        if not len(part):
            continue
        edge, row = paragraphs(part, at)
        w = K.words(part, edge, lower=False)
        solid = np.diff(w.first) > 0
        size = np.diff(edge)
        body = size - (part[edge[1:] - 1] == 10)
        raw = part.tobytes()
        wide = b"".join(hashlib.sha512(raw[at_ : at_ + size_]).digest() for at_, size_ in zip(edge[:-1][solid].tolist(), body[solid].tolist()))
        lanes = np.frombuffer(wide, ">u4").reshape(-1, EXACT).astype(np.uint32)
        first = np.searchsorted(row[solid], np.arange(n + 1))
        run = np.concatenate([np.zeros((1, EXACT), np.uint32), np.cumsum(lanes, axis=0, dtype=np.uint32)])
        out[lo:hi, :EXACT] = run[first[1:]] - run[first[:-1]]
        values, sfirst = K.shingles(w, SHINGLE)
        owner = np.repeat(row, np.diff(sfirst))
        lane = (values % np.uint64(LIKE)).astype(np.int64)
        sign = ((values >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
        sums = np.bincount(owner * LIKE + lane, weights=sign, minlength=n * LIKE).astype(np.int64)
        out[lo:hi, EXACT:] = (sums & 0xFFFFFFFF).astype(np.uint32).reshape(n, LIKE)
    return out


def as_text(lanes: np.ndarray) -> list[str]:
    return [x.astype(">u4").tobytes().hex() for x in lanes]


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def changed(fingerprint: str, inserted: list[str] = (), deleted: list[str] = ()) -> str:
    """The fingerprint after paragraphs are added and taken away."""
    lanes = from_text(fingerprint)
    for texts, add in ((inserted, True), (deleted, False)):
        if texts:
            sums = fingerprints(pa.array(list(texts), pa.string())).sum(0, dtype=np.uint32)
            lanes = lanes + sums if add else lanes - sums
    return as_text(lanes[None])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of lanes; 1 where the fingerprints are equal."""
    x, y = (v[:, EXACT:].view(np.int32).astype(np.float64) for v in (a, b))
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), norm, out=np.zeros(len(x)), where=norm > 0)
    return np.where((a == b).all(1), 1.0, np.clip(cosine, 0.0, 1.0))


def _cuts(rows: DataFrame, ranges: int) -> list[float]:
    """Range borders at even steps of about ``DRAWN * ranges`` ids drawn by hash; they only balance the work."""
    n = rows.where("doc_id is not null").count()
    share = min(1 << 30, (DRAWN * ranges << 30) // max(n, 1) + 1)
    drawn = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).select("doc_id").distinct()
    ids = np.sort(np.array([r[0] for r in drawn.collect() if r[0] is not None], np.float64))
    return sorted(set(ids[np.linspace(0, len(ids) - 1, ranges + 1)[1:-1].astype(int)].tolist())) if len(ids) else []


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, text`` in order of id by key range (``_bucket``); each range ends with a ``last`` row, its successor."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = min(MOST_RANGES, 4 * shuffle_parts(spark))
    placed = with_bucket(rows, "doc_id", _cuts(rows, ranges)).withColumn("_bucket", F.coalesce("_bucket", F.lit(float(ranges))))
    firsts = placed.groupBy("_bucket").agg(F.min("doc_id").alias("doc_id")).orderBy("_bucket").collect()  # a row per range
    if not firsts:
        return placed.withColumn("last", F.lit(False))
    starts = spark.createDataFrame(
        [(b["_bucket"], firsts[i - 1]["_bucket"], b["doc_id"]) for i, b in enumerate(firsts)], "_bucket double, before double, doc_id long")
    known = [b["doc_id"] for b in firsts if b["doc_id"] is not None]
    heads = placed.where(F.col("doc_id").isin(known) | F.col("doc_id").isNull())
    heads = heads.join(F.broadcast(starts.withColumnRenamed("doc_id", "id")), "_bucket").where("doc_id <=> id")  # a row per range
    heads = heads.groupBy("before").agg(F.min(F.struct(F.xxhash64("text"), "doc_id", "text")).alias("h"))
    heads = heads.select(F.col("h.doc_id").alias("doc_id"), F.col("h.text").alias("text"), F.col("before").alias("_bucket"), F.lit(True).alias("last"))
    both = placed.select("doc_id", "text", "_bucket", F.lit(False).alias("last")).unionByName(heads)
    return both.repartition(shuffle_parts(spark), "_bucket").sortWithinPartitions(
        "_bucket", "last", F.asc_nulls_last("doc_id"), F.xxhash64("text"))


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _compare(batches):
    """Pairs of neighbours; the row whose successor is not there yet waits."""
    wait: tuple | None = None  # bucket, id, text

    def flush(ids, texts, nexts):
        edited = []
        for text, after in zip(texts, nexts):
            cut = len(text) // 4
            edited.append(text[: len(text) - cut] + after[:cut])
        own, new, following = (fingerprints(pa.array(t, pa.string())) for t in (texts, edited, nexts))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(as_text(own)), pa.array(as_text(new)),
             pa.array(likeness(own, new)), pa.array(likeness(own, following))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    for batch in batches:
        ids, texts, nexts, held = [], [], [], 0
        for bucket, last, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("_bucket", "last", "doc_id", "text"))):
            if wait is not None and wait[0] == bucket:
                ids.append(wait[1])
                texts.append(wait[2])
                nexts.append(text)
                held += len(text)
            wait = None if last else (bucket, doc_id, text)
            if held > K.PIECE_BYTES:
                yield flush(ids, texts, nexts)
                ids, texts, nexts, held = [], [], [], 0
        if ids:
            yield flush(ids, texts, nexts)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint, that of its text ended by the next document's beginning, and both likenesses."""
    return with_next(docs).mapInArrow(_compare, COMPARED)

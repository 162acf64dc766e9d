"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers, ``floor(64 * c) + 1000000``, so that the fit list (each
distinct row once), its size and its sums are exact. The rows stay where they
are; what a pass over them returns is a Gram matrix, ``width * width`` numbers,
added up by cell in a grouped sum. Each pass solves the centred rows against the
triangle known so far, ``Y = X / R``, takes the Cholesky factor of ``Y'Y`` and
composes it into ``R``. The first factor is shifted, which makes it exist
whatever the condition of the rows; the following passes make ``Y`` orthonormal
to rounding. Then ``X = Q R``, and the singular value decomposition of the small
``R`` has the components (right vectors) and the eigenvalues ``s^2 / n``, without
ever squaring the condition of the rows.

One more pass measures the covariance of the whitened fit list, a last one
projects every row. The driver holds a few matrices of the vectors' width.

Defined cases: null vectors and vectors that hold a null or a number that is not
finite are left out; shorter vectors are filled up with zeros; entries beyond
2^53 after scaling count as 2^53. Equal rows count once in the fit list and are
all returned; a null id stays a null id. A component whose deviation is under
1e-10 of the first one's is rounding only (constant or dependent entries, one
distinct row) and is not returned, so a table of equal rows and an empty table
give no rows. ``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.vectors import extent, finite, matrix, padded
from emberlog.session import materialize

SCALE, OFFSET, EDGE = 64.0, 1_000_000, 2.0**53
COMPONENTS, PASSES, CLOSE, RANK = 16, 6, 1e-13, 1e-10
LOW_BITS = 26
PIECE = 1 << 21
UNIT = np.finfo(np.float64).eps / 2
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_entries(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(EDGE)), F.lit(-EDGE))) + F.lit(OFFSET))


@dataclass(frozen=True)
class Centre:
    """Exact mean of the fit list: ``base + rest / n`` in every dimension, ``0 <= rest < n``."""

    n: int
    base: np.ndarray
    rest: tuple[int, ...]

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        return cls(n, np.array([s // n for s in sums], np.int64), tuple(s % n for s in sums))

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows, rounded once."""
        return (x - self.base) - np.array([r / self.n for r in self.rest])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S)^2``, exactly; null beyond a long."""
        near = x - self.base
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if x.shape[1] * most * most < 1 << 63:
            return ((near * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        wide = ((near.astype(object) * self.n - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in wide]


def _pieces(batch: pa.RecordBatch, width: int):
    """The integer rows of a batch, a few megabytes at a time."""
    step = max(1, PIECE // max(width, 1))
    for lo in range(0, batch.num_rows, step):
        part = batch.slice(lo, step)
        yield part, matrix(part.column("x"), width, np.int64)


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and sums by dimension; sums travel in two halves, so that none overflows."""

    def run(batches):
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            for _, x in _pieces(batch, width):
                n += len(x)
                low += (x & ((1 << LOW_BITS) - 1)).sum(axis=0)
                high += (x >> LOW_BITS).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(low), pa.array(high)], ["i", "n", "low", "high"])

    rows = fit.mapInArrow(run, "i long, n long, low long, high long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    sums = {r["i"]: (r["high"] << LOW_BITS) + r["low"] for r in rows}
    return (rows[0]["n"] if rows else 0), [sums.get(i, 0) for i in range(width)]


def gram(fit: DataFrame, centre: Centre, turn: np.ndarray) -> np.ndarray:
    """``Y'Y`` of the centred rows times ``turn``, with a last column of ones, summed over all tasks."""
    width, k = turn.shape

    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for _, x in _pieces(batch, width):
                y = np.column_stack([centre.rows(x) @ turn, np.ones(len(x))])
                total += y.T @ y
        i, j = np.triu_indices(k + 1)
        if total[k, k]:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    out = np.zeros((k + 1, k + 1))
    for r in fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def upper_factor(g: np.ndarray, shift: float) -> np.ndarray:
    """The triangle ``R`` with ``R'R = g + shift``; a larger shift where rounding leaves ``g`` indefinite."""
    size = max(float(np.trace(g)), np.finfo(np.float64).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, len(g) * UNIT * size)


def triangle(fit: DataFrame, centre: Centre) -> np.ndarray:
    """``R`` of the QR factorisation of the centred fit list."""
    width = len(centre.base)
    r = np.eye(width)
    for step in range(PASSES):
        g = gram(fit, centre, np.linalg.inv(r) if step else r)[:width, :width]
        if step and np.abs(g - np.eye(width)).max() <= CLOSE * width:
            break
        shift = 0.0 if step else 11 * (centre.n * width + width * (width + 1)) * UNIT * float(np.trace(g))
        r = upper_factor(g, shift) @ r
    return r


@dataclass(frozen=True)
class Whitening:
    """Directions (columns, divided by their deviation), eigenvalues over their total, and how far from white the fit list is."""

    centre: Centre
    turn: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    n, sums = exact_sums(fit, width)
    if n < 2 or not width:
        return None
    centre = Centre.of(n, sums)
    _, s, directions = np.linalg.svd(triangle(fit, centre))
    some = min(components, int((s > RANK * s[0]).sum()))
    directions = directions[:some].T
    directions = directions * np.where(directions[np.abs(directions).argmax(axis=0), np.arange(some)] < 0, -1, 1)  # one sign for reruns
    turn = directions / (s[:some] / np.sqrt(n))
    g = gram(fit, centre, turn) / n
    mean = g[some, :some]
    error = np.abs(g[:some, :some] - np.outer(mean, mean) - np.eye(some)).max()
    return Whitening(centre, turn, s[:some] ** 2 / (s**2).sum(), float(error))


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row with a finite vector and each component: ``OUT``."""
    kept = rows.where(finite(vector))
    _, low, width = extent(kept, vector)
    kind = rows.schema[vector].dataType.elementType.simpleString()
    entries = kept.select(F.col("vec_id").cast("long").alias("vec_id"), integer_entries(padded(vector, kind, low, width)).alias("x"))
    model = fit_whitening(materialize(entries.select("x").distinct(), "fit-list"), width, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], OUT)
    k = model.turn.shape[1]

    def run(batches):
        for batch in batches:
            for part, x in _pieces(batch, width):
                m = len(x)
                take = pa.array(np.repeat(np.arange(m), k))
                deviation = pa.array(model.centre.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.centre.n)), deviation.take(take), pa.array((model.centre.rows(x) @ model.turn).ravel()),
                    pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))], [c.split()[0] for c in OUT.split(", ")])

    return entries.mapInArrow(run, OUT)

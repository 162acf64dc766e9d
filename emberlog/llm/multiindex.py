"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart, by codebooks learned on a
bounded sample (``SAMPLE`` rows by hash); a pair of codes is a cell, and every
row is in the cell of its own codes. A query sorts both codebooks by distance
(the negative inner product with its half, since nearness is the inner product)
and takes pairs from a heap by summed distance until the cells taken hold
``budget`` rows; entries of those cells are reranked by exact inner products of
the original vectors, in double precision.

``budget`` is measured, not set: for ``CALIBRATE`` queries by hash the true
neighbours are found over all rows, and the budget is the smallest one that
would have reached ``recall`` of them. It is a number of rows visited and does
not drop any of them; a crowded cell is taken whole.

Cells are laid out in *tiles* of nearly equal rows (a crowded cell is dealt to
several by hash), at least ``TILES`` and of at most ``TILE_ROWS`` rows. A query goes to the
tiles that hold one of its cells, with its last summed distance, which tells its
cells there; a task holds one tile, and the queries stream past it sorted behind
the tile's entries. So memory is bounded whatever the number of queries, and no
code or cell is a hot key.

Defined cases: vectors that are null, all zeros, or hold a null or a number that
is not finite take no part; shorter vectors are filled up with zeros. Rows equal
in id and vector are one row; rows of one id with different vectors are rows of
their own, and where such an id is a query each of its vectors has a list. A
query never finds rows of its own id. A null id is a candidate, behind equal
scores, and never a query. Equal scores go by id; equal vectors score alike to
the last bit, wherever they are. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm.tables import shuffle_parts
from emberlog.llm.vectors import extent, finite, matrix, padded
from emberlog.session import materialize

NEIGHBOURS, RECALL = 20, 0.97
SAMPLE, LLOYD, CALIBRATE = 16384, 12, 256
CODES, CELL_ROWS = 256, 16
TILES, TILE_ROWS = 64, 65536
PAIRS, EXACT_PAIRS = 1 << 21, 1 << 15
FOUND = "query_id long, query_hash long, vec_id long, score double"


@dataclass(frozen=True)
class Books:
    """A codebook for each half."""

    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def halves(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return v[:, :cut], v[:, cut:]

    def encode(self, v: np.ndarray) -> np.ndarray:
        """Cell of every row: the nearest code of each half."""
        codes = [np.argmax(h @ b.T - (b**2).sum(axis=1) / 2, axis=1) for h, b in zip(self.halves(v), (self.first, self.second))]
        return codes[0] * len(self.second) + codes[1]

    def distances(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every query's halves to all codes."""
        a, b = self.halves(v)
        return -(a @ self.first.T), -(b @ self.second.T)


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks, rows by cell, the coded rows (``vec_id, v, cell``) and the rows a query visits."""

    books: Books
    counts: np.ndarray
    coded: DataFrame
    width: int
    budget: int = 0


def lloyd(points: np.ndarray, k: int, rounds: int = LLOYD) -> np.ndarray:
    """At most ``k`` centroids of the points, started from different points."""
    distinct = np.unique(points, axis=0) if points.shape[1] else points[:1]
    codes = distinct[np.random.default_rng(11).permutation(len(distinct))[:k]]
    for _ in range(rounds if len(distinct) > k else 0):
        near = np.argmax(points @ codes.T - (codes**2).sum(axis=1) / 2, axis=1)
        sums = np.zeros_like(codes)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(codes))
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return codes


def learn_books(rows: DataFrame, width: int, codes: int, sample: int = SAMPLE) -> Books:
    """Codebooks from at most ``sample`` rows, in one task; the driver gets ``codes * width`` numbers."""
    drawn = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).select("v")

    def train(batches):
        v = np.concatenate([matrix(b.column("v"), width) for b in batches] or [np.zeros((0, width))])
        if len(v):
            v = v[np.lexsort(v.T)]
            halves = [lloyd(h, codes) for h in (v[:, : width // 2], v[:, width // 2 :])]
            yield pa.RecordBatch.from_arrays([pa.array([h.tobytes()]) for h in halves] + [pa.array([len(h)]) for h in halves], ["a", "b", "n_a", "n_b"])

    row = drawn.repartition(1).mapInArrow(train, "a binary, b binary, n_a long, n_b long").first()
    return Books(np.frombuffer(row["a"]).reshape(row["n_a"], -1), np.frombuffer(row["b"]).reshape(row["n_b"], -1))


def traverse(da: np.ndarray, db: np.ndarray, counts: np.ndarray, budget: int) -> tuple[list[int], float]:
    """Cells by summed distance from a heap until they hold ``budget`` rows; the last sum. Empty cells are passed over."""
    order_a, order_b = np.argsort(da, kind="stable").tolist(), np.argsort(db, kind="stable").tolist()
    da, db = da.tolist(), db.tolist()
    heap, cells, held, last = [(da[order_a[0]] + db[order_b[0]], 0, 0)], [], 0, -np.inf
    while heap and held < budget:
        last, i, j = heapq.heappop(heap)
        cell = order_a[i] * len(db) + order_b[j]
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if j + 1 < len(db):
            heapq.heappush(heap, (da[order_a[i]] + db[order_b[j + 1]], i, j + 1))
        if not j and i + 1 < len(da):
            heapq.heappush(heap, (da[order_a[i + 1]] + db[order_b[0]], i + 1, 0))
    return cells, last


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, each summed in the same way wherever it stands."""
    out = np.empty(len(a))
    for lo in range(0, len(a), EXACT_PAIRS):
        out[lo : lo + EXACT_PAIRS] = (a[lo : lo + EXACT_PAIRS] * b[lo : lo + EXACT_PAIRS]).sum(axis=1)
    return out


def nearest(scores: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, entry rows and exact scores of each query's ``k`` best; ``scores`` are rounded anyhow, -inf leaves a pair out.

    ``order`` is the place of an entry among equal scores.
    """
    m, n = scores.shape
    bar = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(m, -np.inf)
    slack = 1e-12 * np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(vectors.shape[1], 1)
    q, e = np.nonzero((scores >= (bar - slack)[:, None]) & (scores > -np.inf))
    exact = np.concatenate([dots(queries[q[lo : lo + EXACT_PAIRS]], vectors[e[lo : lo + EXACT_PAIRS]]) for lo in range(0, len(q), EXACT_PAIRS)] or [np.zeros(0)])
    best = np.lexsort((order[e], -exact, q))
    q, e, exact = q[best], e[best], exact[best]
    first = np.searchsorted(q, np.arange(m))
    some = np.arange(len(q)) - first[q] < k
    return q[some], e[some], exact[some]


def id_places(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (null: smallest long, never a query's) and places by id, nulls last."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    plain = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
    place = np.empty(len(plain), np.int64)
    place[np.lexsort((plain, null))] = np.arange(len(plain))
    return plain, place


def _coded_rows(rows: DataFrame, books: Books, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(books.encode(matrix(batch.column("v"), width)).astype(np.int32))], ["vec_id", "v", "cell"])

    return rows.mapInArrow(run, f"vec_id long, v {rows.schema['v'].dataType.simpleString()}, cell int")


def true_neighbours(coded: DataFrame, queries: list, width: int, k: int) -> DataFrame:
    """``query, place, cell`` of the ``k`` best entries over all rows, for a bounded list of query rows."""
    own = np.array([r["vec_id"] for r in queries], np.int64)
    asked = np.array([r["v"] for r in queries], np.float64).reshape(len(queries), width)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, max(k, PAIRS // len(asked))):
                part = batch.slice(lo, max(k, PAIRS // len(asked)))
                ids, place = id_places(part.column("vec_id"))
                v = matrix(part.column("v"), width)
                scores = np.where(own[:, None] == ids[None, :], -np.inf, asked @ v.T)
                q, e, exact = nearest(scores, asked, ids, v, place, k)
                yield pa.RecordBatch.from_arrays([pa.array(q), part.column("vec_id").take(pa.array(e)), pa.array(exact), part.column("cell").take(pa.array(e))], ["query", "vec_id", "score", "cell"])

    found = coded.mapInArrow(run, "query long, vec_id long, score double, cell int")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.select("query", "cell", rank.alias("place")).where(F.col("place") <= k)


def measured_budget(coded: DataFrame, books: Books, counts: np.ndarray, asks: Column, width: int, k: int, recall: float) -> int:
    """Fewest rows to visit so that ``recall`` of the true neighbours of at most ``CALIBRATE`` queries lie in the cells taken."""
    queries = coded.where(asks).orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(CALIBRATE).select("vec_id", "v").collect()
    if not queries:
        return 0
    truth = true_neighbours(coded, queries, width, k).collect()
    da, db = books.distances(np.array([r["v"] for r in queries], np.float64).reshape(len(queries), width))
    cells: dict[int, list[int]] = {}
    for r in truth:
        cells.setdefault(r["query"], []).append(r["cell"])
    ahead = []
    for q, inside in cells.items():
        sums = (da[q][:, None] + db[q][None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(counts[order]) - counts[order]
        ahead += before[inside].tolist()
    ahead.sort()
    enough = ahead[max(0, int(np.ceil(recall * len(ahead))) - 1)] + 1 if ahead else 1
    return max(int(enough), 4 * k)


def build(table: DataFrame, asks: Column, vector: str = "embedding", k: int = NEIGHBOURS, recall: float = RECALL) -> MultiIndex | None:
    """Index of all rows of ``table`` (``vec_id``, ``vector``), with a budget measured on rows that ``asks`` (a condition on ``vec_id``)."""
    kept = table.where(finite(vector) & F.exists(vector, lambda x: x != 0))
    n, low, width = extent(kept, vector)
    if not n:
        return None
    kind = table.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), padded(vector, kind, low, width).cast(f"array<{kind}>").alias("v"))
    books = learn_books(rows, width, int(np.clip(round((n / CELL_ROWS) ** 0.5), 1, CODES)))
    coded = materialize(_coded_rows(rows.distinct(), books, width), "coded")
    counts = np.zeros(books.cells, np.int64)
    for r in coded.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most CODES^2
        counts[r["cell"]] = r["n"]
    return MultiIndex(books, counts, coded, width, measured_budget(coded, books, counts, asks, width, k, recall))


def lay_tiles(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tile and number of tiles of every cell: neighbouring cells share a tile, a crowded one has several of its own."""
    most = int(np.clip(-(-counts.sum() // TILES), 1, TILE_ROWS))
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    tile = held = 0
    for cell in np.flatnonzero(counts):
        n = counts[cell]
        if held and held + n > most:
            tile, held = tile + 1, 0
        first[cell], parts[cell] = tile, -(-n // most)
        if n > most:
            tile += parts[cell]
        else:
            held += n
    return first, parts


def _routed(index: MultiIndex, asks: Column) -> DataFrame:
    """Entries (``kind`` 0) in their tile and queries (1) in every tile they visit."""
    first, parts = lay_tiles(index.counts)
    books, counts, width, budget = index.books, index.counts, index.width, index.budget
    v_type = index.coded.schema["v"].dataType.simpleString()
    out = f"tile int, kind int, vec_id long, hash long, reach double, cell int, v {v_type}"
    names = ["tile", "kind", "vec_id", "hash", "reach", "cell", "v"]

    def entries(batches):
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            n = len(cell)
            tile = first[cell] + np.mod(batch.column("hash").to_numpy(), parts[cell])
            yield pa.RecordBatch.from_arrays([pa.array(tile.astype(np.int32)), pa.array(np.zeros(n, np.int32)), batch.column("vec_id"), batch.column("hash"), pa.array(np.zeros(n)), batch.column("cell"), batch.column("v")], names)

    def queries(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                da, db = books.distances(matrix(part.column("v"), width))
                rows, tiles, reach = [], [], []
                for i in range(part.num_rows):
                    cells, last = traverse(da[i], db[i], counts, budget)
                    begin, n = first[cells], parts[cells]
                    seen = np.unique(begin) if n.max(initial=1) == 1 else np.unique(np.concatenate([np.arange(b, b + c) for b, c in zip(begin, n)]))
                    rows.append(np.full(len(seen), i))
                    tiles.append(seen)
                    reach.append(np.full(len(seen), last))
                take, n = pa.array(np.concatenate(rows)), sum(map(len, tiles))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tiles).astype(np.int32)), pa.array(np.ones(n, np.int32)), part.column("vec_id").take(take), part.column("hash").take(take),
                    pa.array(np.concatenate(reach)), part.column("cell").take(take), part.column("v").take(take)], names)

    rows = index.coded.withColumn("hash", F.xxhash64("vec_id", "v"))
    return rows.mapInArrow(entries, out).unionAll(rows.where(asks).mapInArrow(queries, out))


class _Tile:
    """The entries of one tile, by cell, and the reranking of the queries that reach it."""

    def __init__(self, parts: list, books: Books, width: int):
        ids = pa.concat_arrays([p.column("vec_id") for p in parts])
        cell = np.concatenate([p.column("cell").to_numpy() for p in parts])
        by_cell = np.argsort(cell, kind="stable")
        self.column = ids.take(pa.array(by_cell))
        self.ids, self.place = id_places(self.column)
        self.vectors = np.concatenate([matrix(p.column("v"), width) for p in parts])[by_cell]
        self.cells, first = np.unique(cell[by_cell], return_index=True)
        self.first = np.append(first, len(cell))
        self.books, self.width = books, width

    def search(self, part: pa.RecordBatch, k: int):
        """Every query's best entries among the cells it takes here."""
        asked, own, reach = matrix(part.column("v"), self.width), part.column("vec_id").to_numpy(), part.column("reach").to_numpy()
        step = max(1, PAIRS // len(self.ids))
        for lo in range(0, len(asked), step):
            q = asked[lo : lo + step]
            da, db = self.books.distances(q)
            sums = da[:, self.cells // len(self.books.second)] + db[:, self.cells % len(self.books.second)]
            takes = sums <= (reach[lo : lo + step] + 1e-12 * (1 + np.abs(reach[lo : lo + step])))[:, None]
            scores = np.full((len(q), len(self.ids)), -np.inf)
            for c in np.flatnonzero(takes.any(axis=0)):
                who, entry = np.flatnonzero(takes[:, c]), slice(self.first[c], self.first[c + 1])
                scores[who, entry] = q[who] @ self.vectors[entry].T
            scores[own[lo : lo + step, None] == self.ids[None, :]] = -np.inf
            i, e, exact = nearest(scores, q, self.ids, self.vectors, self.place, k)
            rows = pa.array(i + lo)
            yield pa.RecordBatch.from_arrays([part.column("vec_id").take(rows), part.column("hash").take(rows), self.column.take(pa.array(e)), pa.array(exact)], [c.split()[0] for c in FOUND.split(", ")])


def search(index: MultiIndex, asks: Column, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score`` (and ``query_hash``, which tells the vectors of one id apart)."""
    books, width = index.books, index.width

    def tiles(batches):
        tile, parts, held = None, [], None
        for batch in batches:
            number, kind = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(number)] if len(number) else []):
                if number[lo] != tile:
                    tile, parts, held = number[lo], [], None
                if kind[lo] == 0:
                    parts.append(batch.slice(lo, hi - lo))
                elif parts:
                    held = held or _Tile(parts, books, width)
                    yield from held.search(batch.slice(lo, hi - lo), k)

    routed = _routed(index, asks).repartition(shuffle_parts(index.coded.sparkSession), "tile").sortWithinPartitions("tile", "kind")
    found = routed.mapInArrow(tiles, FOUND)
    rank = F.row_number().over(W.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score", "query_hash").where(F.col("rank") <= k)


def nearest_rows(table: DataFrame, every: int = 20, vector: str = "embedding", k: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows found for every row whose id is divisible by ``every``."""
    asks = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    index = build(table, asks, vector, k, recall)
    if index is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_hash long")
    return search(index, asks, k)

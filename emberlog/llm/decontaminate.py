"""Benchmark passages in documents: SimHash of item-sized windows, Hamming multi-index, exact check.

An item is a sequence of words (A-Z lowered); its windows in a document are the
runs of as many words; a document of fewer words than the item is the one window
of that item as a whole. A window's 64-bit SimHash sums word and word-pair hashes.
A multi-index over the items' fingerprints (``BLOCKS`` blocks of 16 bits, each
listed under all values that differ in at most ``RADIUS // BLOCKS`` bits) names
every item within ``RADIUS`` bits of a window: a fingerprint that near differs in
no more than that in some block. Named items are checked exactly: the weighted
similarity of the two multisets of 5-word shingles, sum of minima over sum of
maxima, must reach ``threshold``. A similarity above 0 needs a common shingle, so
windows that share none with an item they are compared to are never
fingerprinted; that skips no pair the check could accept.

The benchmark goes through in blocks of ``block_items`` items (a bounded closure
each), all documents against every block. Documents are never shuffled.

Defined cases: null or empty texts and items without words match nothing; an
item of fewer than five words is one shingle, found by equality; items that
repeat, or share an id, are reported alike, once per id and document row; an
item without an id counts by its text and is reported under the null id. A
passage that occurs more than once in a document is reported where it is most
similar, then first. Extra columns are ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K

THRESHOLD, K_WORDS, RADIUS, BLOCKS, BLOCK_ITEMS = 0.8, 5, 19, 4, 512
LANES = np.arange(64, dtype=np.uint64)


def _near_values(bits: int) -> np.ndarray:
    """All 16-bit masks of at most ``bits`` set bits."""
    return np.array([sum(1 << i for i in c) for n in range(bits + 1) for c in combinations(range(16), n)], np.int64)


def _votes(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    return (((h[:, None] >> LANES) & np.uint64(1)).astype(np.int8) << 1) - 1


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash for every word with its successor."""
    return K.mix(h[:-1] * K.STEP + K.mix(h[1:] + K.GOLDEN))


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << LANES).sum(1, dtype=np.uint64)


def fingerprint(h: np.ndarray) -> np.uint64:
    """SimHash of one word sequence."""
    return _pack(_votes(h).sum(0, dtype=np.int64)[None] + _votes(_pairs(h)).sum(0, dtype=np.int64)[None])[0]


class Items:
    """The multi-index over a block of items ``(item_id, text)``."""

    def __init__(self, items: list[tuple[int | None, str]]):
        data, at = K.text_bytes(pa.array([t or "" for _, t in items], pa.string()))
        w = K.words(data, at)
        size = np.diff(w.first)
        keep = [i for i in range(len(items)) if size[i]]
        self.ids = [items[i][0] for i in keep]
        self.size = size[keep]
        own = [w.hash[w.first[i] : w.first[i + 1]] for i in keep]
        self.prints = np.array([fingerprint(h) for h in own], np.uint64)
        shingle, sfirst = K.shingles(w, K_WORDS)
        self.bags = [Counter(shingle[sfirst[i] : sfirst[i + 1]].tolist()) for i in keep]
        # shingle -> items that have it
        flat = np.concatenate([np.array(list(b), np.uint64) for b in self.bags]) if keep else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(keep)), [len(b) for b in self.bags])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.flat & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.runs = sorted({min(int(s), K_WORDS) for s in self.size})  # shingle lengths in use
        near = _near_values(RADIUS // BLOCKS)
        keys, items_of = [], []
        for b in range(BLOCKS):
            value = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            keys.append(((value[:, None] ^ near) + (b << 16)).ravel())
            items_of.append(np.repeat(np.arange(len(keep)), len(near)))
        keys, items_of = np.concatenate(keys), np.concatenate(items_of)
        order = np.argsort(keys, kind="stable")
        self.listed = items_of[order]
        self.first = np.searchsorted(keys[order], np.arange((BLOCKS << 16) + 1))

    def windows(self, w: K.Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, words) of the windows that share a shingle with an item of their length, or a longer one if they are a whole row."""
        starts, sizes = [], []
        for k in self.runs:
            h, hfirst = K.shingles(w, k)
            maybe = np.flatnonzero(self.sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(self.flat, h[maybe]), np.searchsorted(self.flat, h[maybe], "right")
            maybe, lo, n = maybe[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            if not len(maybe):
                continue
            item = self.owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            row = np.searchsorted(hfirst, np.repeat(maybe, n), "right") - 1
            at = np.repeat(maybe, n) - hfirst[row] + w.first[row]
            size = self.size[item]
            fits, short = np.minimum(size, K_WORDS) == k, size > np.diff(w.first)[row]
            few = np.unique(row[fits & short])
            starts.append(w.first[few])
            sizes.append(np.diff(w.first)[few])
            hit = np.unique(np.stack([row, at, size])[:, fits & ~short], axis=1)
            row, at, size = hit
            low = np.maximum(w.first[row], at + k - size)
            high = np.minimum(at, w.first[row + 1] - size)
            n = np.maximum(high - low + 1, 0)
            starts.append(np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            sizes.append(np.repeat(size, n))
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate(starts), np.concatenate(sizes)]), axis=1)
        return both[0], both[1]

    def prints_of(self, w: K.Words, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Fingerprints of windows, from running sums over the words they touch."""
        touched = np.zeros(len(w.hash) + 1, np.int32)
        np.add.at(touched, start, 1)
        np.add.at(touched, start + size, -1)
        place = np.flatnonzero(np.cumsum(touched)[:-1] > 0)
        to = np.zeros(len(w.hash) + 1, np.int64)
        to[place] = np.arange(len(place))
        h = w.hash[place]
        pair = np.zeros(len(h), np.uint64)
        pair[:-1] = _pairs(h)
        zero = np.zeros((1, 64), np.int32)
        words = np.concatenate([zero, np.cumsum(_votes(h), 0, dtype=np.int32)])
        pairs = np.concatenate([zero, np.cumsum(_votes(pair), 0, dtype=np.int32)])
        a = to[start]
        return _pack(words[a + size] - words[a] + pairs[a + size - 1] - pairs[a])

    def within(self, prints: np.ndarray, size: np.ndarray, whole: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within RADIUS bits that have one length, or a longer item where the window is a whole row."""
        whole = np.broadcast_to(whole, len(prints))
        found = []
        for b in range(BLOCKS):
            key = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64) + (b << 16)
            n = self.first[key + 1] - self.first[key]
            item = self.listed[np.repeat(self.first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            win = np.repeat(np.arange(len(prints)), n)
            same = (self.size[item] == size[win]) | (whole[win] & (self.size[item] > size[win]))
            found.append(win[same] * np.int64(len(self.ids)) + item[same])
        pair = np.unique(np.concatenate(found))
        win, item = pair // max(len(self.ids), 1), pair % max(len(self.ids), 1)
        far = np.bitwise_count(prints[win] ^ self.prints[item])
        near = far <= RADIUS
        return win[near], item[near], far[near]

    def matches(self, column: pa.Array, threshold: float) -> Iterator[tuple[int, int | None, float, int, int, int]]:
        """(row, item id, similarity, first word, words, distance), the best one per row and item id."""
        data, at = K.text_bytes(column)
        for base, _, part, offs in K.pieces(data, at):
            w = K.words(part, offs)
            start, size = self.windows(w)
            for p in range(0, len(start), 20_000):
                yield from self._checked(w, start[p : p + 20_000], size[p : p + 20_000], base, threshold)

    def _checked(self, w: K.Words, start, size, base: int, threshold: float):
        prints = self.prints_of(w, start, size)
        rows = np.searchsorted(w.first, start, "right") - 1
        for win, item, far in zip(*self.within(prints, size, size == np.diff(w.first)[rows])):
            s, n, row = int(start[win]), int(size[win]), int(rows[win])
            run = K.Words(w.start, w.end, w.hash[s : s + n], np.array([0, n]))
            bag, other = Counter(K.shingles(run, K_WORDS)[0].tolist()), self.bags[item]
            low = (bag & other).total()
            high = bag.total() + other.total() - low
            if low >= threshold * high:
                yield base + row, self.ids[item], low / high, s - int(w.first[row]), n, int(far)


def _best(found) -> dict[tuple[int, int | None], tuple]:
    """The most similar, then first, match per row and item id."""
    best: dict[tuple[int, int | None], tuple] = {}
    for row, item, sim, at, n, far in found:
        if (row, item) not in best or (-sim, at) < (-best[row, item][0], best[row, item][1]):
            best[row, item] = (sim, at, n, far)
    return best


def item_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in blocks; the driver holds one partition of it at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").toLocalIterator()
    pairs = ((r[0], r[1]) for r in rows)
    while block := list(islice(pairs, block_items)):
        yield block


LEAK = "doc_id long, item_id long, similarity double, word_start long, n_words long, hamming int"


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """A row per document row and item whose passage it holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def finder(block):
        def run(batches):
            index = Items(block)
            for batch in batches:
                best = _best(index.matches(batch.column("text"), threshold))
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[r], i, *v) for (r, i), v in best.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()))],
                    ["doc_id", "item_id", "similarity", "word_start", "n_words", "hamming"])
        return run

    found = None
    for block in item_blocks(benchmark, block_items):
        part = rows.mapInArrow(finder(block), LEAK)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else spark.createDataFrame([], LEAK)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, all columns, without a shuffle."""

    def keeper(block):
        def run(batches):
            index = Items(block)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in index.matches(batch.column("text"), threshold):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
        return run

    for block in item_blocks(benchmark, block_items):
        docs = docs.mapInArrow(keeper(block), docs.schema)
    return docs

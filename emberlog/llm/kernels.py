"""Numpy kernels over Arrow text columns: words, shingles and n-grams as 64-bit hashes.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, with A-Z lowered. A
null text counts as the empty text. Work goes through a column in pieces of a
few megabytes (a longer document is a piece of its own), so the arrays stay
small whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0x100000001B3 * 2 + 0x5DEECE66D)  # odd multiplier of the rolling hashes
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of a few documents: byte starts and ends, hashes; document ``d`` owns words ``first[d]:first[d + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the ``n + 1`` offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(data: np.ndarray, at: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``most`` bytes, or one longer row: (first row, end row, bytes, offsets)."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def salt(i: int) -> np.uint64:
    """The i-th of a row of well-spread constants."""
    return np.uint64(i * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), STEP, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(data: np.ndarray, at: np.ndarray, lower: bool = True) -> Words:
    """Words of the rows of a piece; none crosses a row."""
    n = len(data)
    first_of = np.zeros(n + 1, dtype=bool)
    first_of[at] = True  # a row begins here (or the piece ends)
    space = IS_SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1] | first_of[1:n]
    start = np.flatnonzero(begins)
    ends = ~space
    ends[:-1] &= space[1:] | first_of[1:n]
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    if not len(start):
        return Words(start, end, np.zeros(0, np.uint64), first)
    size = end - start
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    chars = data[np.repeat(start, size) + inside]
    # eight bytes are a block; blocks are mixed by place before they are summed, so no two texts cancel by their shape
    shifted = (LOWER[chars] if lower else chars).astype(np.uint64) << ((inside & 7) << 3).astype(np.uint64)
    opens = np.flatnonzero((inside & 7) == 0)
    blocks = mix(np.bitwise_or.reduceat(shifted, opens) + (inside[opens] >> 3).astype(np.uint64) * GOLDEN + STEP)
    sums = np.add.reduceat(blocks, np.searchsorted(opens, np.cumsum(size) - size))
    return Words(start, end, mix(sums + size.astype(np.uint64) * GOLDEN), first)


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words by row, and their ``first`` offsets; a row of fewer words is one run."""
    count = np.diff(w.first)
    runs = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], runs) + np.repeat(w.first[:-1], runs)
    size = np.repeat(np.minimum(count, k), runs)
    out = size.astype(np.uint64) * GOLDEN
    for i in range(k):
        has = size > i
        turn = mix(w.hash[np.minimum(at + i, max(len(w.hash) - 1, 0))] + salt(i + 1)) if len(at) else out
        out = np.where(has, out * STEP + turn, out)
    return mix(out), first


def distinct_by_row(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, and their offsets."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(len(first)))


def sums_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Totals of ``values`` by row; an empty row has 0."""
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return run[first[1:]] - run[first[:-1]]


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))

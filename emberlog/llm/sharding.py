"""Shards of near-equal bytes by longest-processing-time scheduling.

Documents of equal text form a group that stays together. Groups go, largest
first, to the least-loaded shard, which a heap names (ties: the lowest shard).
Groups of one size are interchangeable, so the schedule is made over the
histogram of group sizes: a run of m equal groups is dealt in one step (all
levels below the final water line at once, the last ones through the heap),
which gives the loads of the one-by-one schedule. Sizes keep ``BITS`` leading
bits in the histogram, so it has at most 2 ** (BITS - 1) rows per power of two,
whatever the table; below 2 ** BITS bytes sizes are exact. Each group then finds
its shard from its rank among groups of its size, and each document its slot
from its rank in the shard; both ranks are taken in cells of sqrt(n) rows.

Defined cases: a null text is an empty one (size 1, crc32 0, one group with
empty texts); rows that repeat are documents of their own, in their text's
group; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.ranks import cell_of, ranked
from emberlog.session import materialize

SHARDS, BITS = 16, 14


def longest_first(sizes: np.ndarray, counts: np.ndarray, totals: np.ndarray, shards: int) -> np.ndarray:
    """How many groups of each size (sorted falling) every shard gets.

    ``sizes`` order the work, ``totals / counts`` are the mean bytes of a group
    of that size, by which loads grow.
    """
    load = [0.0] * shards
    out = np.zeros((len(sizes), shards), np.int64)
    for row in range(len(sizes)):
        m, s = int(counts[row]), float(totals[row]) / float(counts[row])
        if m > 4 * shards:
            now = np.array(load)
            # below this water line every shard would still be the least loaded
            order = np.sort(now)
            fill = (m * s + np.cumsum(order)) / np.arange(1, shards + 1)
            line = fill[np.flatnonzero(fill >= order)[-1]] - 2 * s
            take = np.maximum(0, np.floor((line - now) / s)).astype(np.int64)
            out[row] += take
            load = (now + take * s).tolist()
            m -= int(take.sum())
        heap = [(x, k) for k, x in enumerate(load)]
        heapq.heapify(heap)
        for _ in range(m):
            x, k = heap[0]
            heapq.heapreplace(heap, (x + s, k))
            load[k] += s
            out[row, k] += 1
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = materialize(rows, "texts")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    drop = F.greatest(F.lit(0), F.length(F.bin("bytes")) - BITS)
    groups = groups.withColumn("about", F.call_function("shiftleft", F.call_function("shiftright", F.col("bytes"), drop), drop))
    groups = materialize(groups.withColumn("h", F.xxhash64("digest")), "groups")
    sizes = groups.groupBy("about").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).toPandas().sort_values("about", ascending=False)
    deal = longest_first(sizes["about"].to_numpy(), sizes["n"].to_numpy(), sizes["bytes"].to_numpy(), shards)
    plan = pd.DataFrame({"about": sizes["about"].to_numpy(np.int64), "n": sizes["n"].to_numpy(np.int64), "ends": np.cumsum(deal, axis=1).tolist()})
    plan = docs.sparkSession.createDataFrame(plan, "about long, n long, ends array<long>")
    cells = groups.join(plan, "about").withColumn("cell", cell_of(F.col("h"), F.col("n")))
    cells = cells.withColumn("o", F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    placed = ranked(cells, ["about"], "cell", ["o", "digest"])
    shard = F.size(F.filter("ends", lambda e: e <= F.col("position")))
    placed = rows.join(placed.select("digest", shard.alias("shard")), "digest")
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard", F.xxhash64("doc_id", "digest").alias("h")), "placed")
    per_shard = placed.groupBy("shard").agg(F.count("*").alias("n"))
    slots = placed.join(per_shard, "shard").withColumn("cell", cell_of(F.col("h"), F.col("n")))
    slots = slots.withColumn("o", F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    return ranked(slots, ["shard"], "cell", ["o", "doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

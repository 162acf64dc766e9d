"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct 5-word shingles. Documents with equal sets
form a class; classes are joined, not their copies.

1. One pass computes set size, set digest and ``trees * depth`` minwise values.
2. Trees. In tree ``t`` a class walks down the path of its minwise values
   ``t0, t1, ...``; classes on one path share a node. A node of one class ends. A
   node of at most ``small`` classes is compared exhaustively. A larger one
   branches by the next minwise value, down to ``depth``. Two sets of similarity
   s meet in a tree with probability at least s ** depth, so ``trees``
   independent trees reach the recall asked for (``missed``); unless given, there
   are as many as the threshold needs to miss at most ``MISS`` (``trees_for``).
3. Comparing in a node means comparing minwise values (a candidate link needs an
   estimate well below the threshold). A node that is still large at the last
   level has so much in common that all its classes become candidates.
4. Candidate links of all trees give candidate groups (connected components).
   Each text of a group is fetched once; full sets are compared, with integers,
   until all links are known up to connectivity: a found component is expanded
   member by member against what it has not reached yet. Groups over ``chunk``
   classes are cut: every chunk is joined inside and with the group's pivot, and
   only classes that the pivot's component has not reached are compared with the
   other chunks. No pairs are ever emitted, only spanning links.

Defined cases: null or empty text or no words: empty set, linked with nothing.
Rows that repeat a doc_id are one vertex. A row without id is linked with
nothing, its component is null and it is kept. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K
from emberlog.llm.graph import components
from emberlog.llm.tables import shuffle_parts
from emberlog.session import materialize

TREES, DEPTH, SMALL, CHUNK, MISS = 10, 5, 32, 1024, 0.003
SKETCH = "doc_id long, th long, n_shingles long, d1 long, d2 long, sig binary"


def missed(similarity: float, trees: int = TREES, depth: int = DEPTH) -> float:
    """Upper bound on the chance that no tree brings two sets of this similarity together."""
    return (1 - similarity**depth) ** trees


def trees_for(similarity: float, depth: int = DEPTH, miss: float = MISS) -> int:
    """The least number of trees for which ``missed`` is at most ``miss``."""
    meet = similarity**depth
    return 1 if meet >= 1 else max(1, int(np.ceil(np.log(miss) / np.log1p(-meet))))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = K.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * K.GOLDEN)
    return base[:n], base[n:] | np.uint64(1)


def _sketch_rows(batches, k: int, n_hash: int):
    xor, mul = _seeds(n_hash)
    for batch in batches:
        data, at = K.text_bytes(batch.column("text"))
        for lo, hi, part, offs in K.pieces(data, at):
            values, first = K.shingles(K.words(part, offs), k)
            sets, sfirst = K.distinct_by_row(values, first)
            size = np.diff(sfirst)
            has = size > 0
            sig = np.zeros((hi - lo, n_hash), np.uint32)
            if has.any():
                begin = sfirst[:-1][has]
                for i in range(n_hash):
                    sig[has, i] = np.minimum.reduceat(((sets ^ xor[i]) * mul[i]) >> np.uint64(32), begin)
            d1 = K.sums_by_row(K.mix(sets + K.GOLDEN), sfirst)
            d2 = K.sums_by_row(K.mix(sets ^ K.salt(7)), sfirst)
            rows = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("th"), pa.array(size.astype(np.int64)), K.signed(d1), K.signed(d2),
                 pa.array([x.tobytes() if h else None for x, h in zip(sig, has)], pa.binary())],
                ["doc_id", "th", "n_shingles", "d1", "d2", "sig"])


def sketches(docs: DataFrame, k: int = 5, n_hash: int = TREES * DEPTH) -> DataFrame:
    """Per row: id, text hash, set size, set digest, minwise values (null for an empty set)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return rows.mapInArrow(lambda b: _sketch_rows(b, k, n_hash), SKETCH)


def _step(node: str, depth: int, level: int):
    """The path after the next minwise value of the row's tree."""
    at = (F.col("t") * depth + level) * 4 + 1
    return F.xxhash64(node, F.col("sig").substr(at, F.lit(4)))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes of two classes or more, with the node's size."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return rows.drop("size").join(sizes, "node")


def _small_links(batches, cut: int):
    """Candidate links inside small nodes; rows come sorted by node."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        node = table.column("node").to_numpy()
        last = int(np.searchsorted(node, node[-1]))
        held = table.slice(last)
        yield from _links_of(table.slice(0, last), cut)
    if held is not None:
        yield from _links_of(held, cut)


def _links_of(table: pa.Table, cut: int):
    n = table.num_rows
    if n < 2:
        return
    table = table.combine_chunks()
    node, v = table.column("node").to_numpy(), table.column("v").to_numpy()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(n, -1)
    a, b = [], []
    for d in range(1, n):
        i = np.flatnonzero(node[:-d] == node[d:])
        if not len(i):
            break
        for p in range(0, len(i), 100_000):
            j = i[p : p + 100_000]
            j = j[(sig[j] == sig[j + d]).sum(1) >= cut]
            a.append(v[j])
            b.append(v[j + d])
    a, b = np.concatenate(a), np.concatenate(b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def candidate_links(classes: DataFrame, threshold: float, trees: int = TREES, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """Links ``a, b`` between classes ``v`` (with ``sig``) that some tree puts together."""
    n_hash = trees * depth
    cut = int(np.ceil(n_hash * threshold - 3.5 * np.sqrt(n_hash * threshold * (1 - threshold))))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("t")
    light = classes.select("v", "th", "sig", tree).select("v", "th", "t", F.xxhash64("t", F.col("sig").substr(F.col("t") * (depth * 4) + 1, F.lit(4))).alias("node"))
    shared = _sized(light).join(classes.select("v", "th", "sig"), ["v", "th"])
    rows = materialize(shared.select("v", "t", "node", "size", "sig"), "nodes")
    links, spread = [], shuffle_parts(classes.sparkSession)
    for level in range(1, depth + 1):
        leaves = rows.where(F.col("size") <= small).select("node", "v", "sig")
        leaves = leaves.repartition(spread, "node").sortWithinPartitions("node")
        links.append(leaves.mapInArrow(lambda b: _small_links(b, cut), "a long, b long"))
        large = rows.where(F.col("size") > small)
        if level == depth:
            pivots = large.groupBy("node").agg(F.min("v").alias("b"))
            links.append(large.join(pivots, "node").select(F.col("v").alias("a"), "b"))
            break
        if large.isEmpty():
            break
        down = large.withColumn("node", _step("node", depth, level))
        rows = materialize(_sized(down).select("v", "t", "node", "size", "sig"), "nodes")
    out = links[0]
    for more in links[1:]:
        out = out.unionAll(more)
    return out.where("a <> b").distinct()


def _reach(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Per set, the number of its connected component under |A & B| * den >= num * |A | B|."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    comp = np.full(m, -1, np.int64)
    marks = np.zeros(int(flat.max()) + 1, np.int32)
    first = np.concatenate([[0], np.cumsum(size)])
    own = [flat[first[i] : first[i + 1]] for i in range(m)]
    rest, rest_flat, rest_first = np.arange(m), flat, first
    for seed in range(m):
        if comp[seed] >= 0:
            continue
        comp[seed] = seed
        queue = [seed]
        while queue:
            x = queue.pop()
            open_ = comp[rest] < 0
            if 2 * open_.sum() <= len(rest):
                rest = rest[open_]
                if not len(rest):
                    break
                rest_flat = np.concatenate([own[i] for i in rest])
                rest_first = np.concatenate([[0], np.cumsum(size[rest])])
                open_ = np.ones(len(rest), bool)
            marks[own[x]] = 1
            both = K.sums_by_row(marks[rest_flat].astype(np.int64), rest_first)
            marks[own[x]] = 0
            hit = rest[open_ & (both * den >= num * (size[rest] + size[x] - both))]
            comp[hit] = seed
            queue.extend(hit.tolist())
    return comp


def _verified(batches, k: int, num: int, den: int):
    """Spanning links of every ``part``; rows come sorted by part. Sets, not texts, are held for an open part."""
    part_now, ids, sets = None, [], []

    def links():
        comp = _reach(sets, num, den) if len(sets) > 1 else np.zeros(len(sets), np.int64)
        mine = np.array(ids, np.int64)
        other = mine[comp] if len(sets) > 1 else mine
        keep = mine != other
        return pa.RecordBatch.from_arrays([pa.array(mine[keep]), pa.array(other[keep])], ["a", "b"])

    for batch in batches:
        part, v = batch.column("part").to_numpy(), batch.column("v").to_numpy()
        data, at = K.text_bytes(batch.column("text"))
        for lo, hi, piece, offs in K.pieces(data, at):
            values, sfirst = K.distinct_by_row(*K.shingles(K.words(piece, offs), k))
            for i in range(lo, hi):
                if part[i] != part_now:
                    if len(sets) > 1:
                        yield links()
                    part_now, ids, sets = part[i], [], []
                ids.append(int(v[i]))
                sets.append(values[sfirst[i - lo] : sfirst[i - lo + 1]].copy())
    if len(sets) > 1:
        yield links()


def _verify(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Rows ``part, v, text`` to spanning links, a part at a time."""
    n = shuffle_parts(rows.sparkSession)
    sorted_rows = rows.repartition(n, "part").sortWithinPartitions("part")
    return sorted_rows.mapInArrow(lambda b: _verified(b, k, num, den), "a long, b long")


def near_links(docs: DataFrame, classes: DataFrame, num: int, den: int, k: int = 5, chunk: int = CHUNK, **tree) -> DataFrame:
    """Verified links ``a, b`` that span the components of the classes."""
    groups = components(candidate_links(classes, num / den, **tree))
    members = groups.join(classes.select("v", "th"), "v")
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = members.join(sizes, "component").withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("v"), F.xxhash64("text").alias("th"), "text")
    members = materialize(members.join(texts, ["v", "th"]).dropDuplicates(["v", "th"]), "members")
    own = F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    placed = members.withColumn("c", F.explode(F.when(F.col("v") == F.col("component"), every).otherwise(F.array(own))))
    links = materialize(_verify(placed.select(F.xxhash64("component", "c").alias("part"), "v", "text"), k, num, den), "links")
    large = members.where("chunks > 1")
    if large.isEmpty():
        return links
    found = components(links).select("v", F.col("component").alias("found"))
    large = large.join(found, "v", "left").withColumn("found", F.coalesce("found", "v"))
    pivots = large.where("v = component").select("component", F.col("found").alias("reached")).distinct()
    apart = materialize(large.join(pivots, "component").where("found <> reached").drop("found", "reached"), "apart")
    counts = apart.groupBy("component").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    i_own = F.pmod(F.xxhash64(F.col("v"), F.lit(1)), F.col("parts")).cast("int")
    left = apart.join(counts, "component").withColumn("i", i_own).withColumn("c", F.explode(every))
    right = large.drop("found").join(counts, "component").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("c", own)
    cross = left.unionByName(right).dropDuplicates(["component", "i", "c", "v", "th"])
    more = _verify(cross.select(F.xxhash64("component", "i", "c").alias("part"), "v", "text"), k, num, den)
    return links.unionAll(materialize(more, "links"))


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100, k: int = 5, trees: int | None = None, depth: int = DEPTH,
                    small: int = SMALL, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; link: |A & B| / |A | B| >= num / den."""
    trees = trees_for(num / den, depth) if trees is None else trees
    rows = materialize(sketches(docs, k, trees * depth), "sketches")
    linked = rows.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("sig").alias("sig"))
    classes = materialize(classes.select(F.col("rep.doc_id").alias("v"), F.col("rep.th").alias("th"), "d1", "d2", "sig"), "classes")
    near = near_links(docs, classes, num, den, k, chunk, trees=trees, depth=depth, small=small)
    copies = linked.join(classes.select("v", "d1", "d2"), ["d1", "d2"]).where("doc_id <> v")
    edges = near.select("a", "b").unionAll(copies.select(F.col("doc_id").alias("a"), F.col("v").alias("b")))
    found = components(edges)
    out = rows.join(found, rows["doc_id"] == found["v"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.expr("doc_id <=> component_id"))


def keep_one(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near copies: the smallest doc_id of each component stays.

    Rows that repeat an id stay or go together, but for rows equal in id and
    text, of which one stays.
    """
    gone = near_duplicates(docs, num, den).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])

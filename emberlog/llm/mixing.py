"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources by code point (null last) weigh 1, 2, 3, repeating. All words of the
table are shared out by weight; a target stops at ``most_passes`` times its
source's words and the excess is shared again (``source_targets``).

A document is cut into blocks of ``block_words`` words (or is one block). Each
source's blocks stand in an order drawn by hash. Whole passes over a source come
first, then a prefix of its order up to the block that brings the words nearest
to the target: that fixes the exact number of blocks a source gives, its quota.

The tree deals quotas to output shards of equal capacity. Its root is all
sources, with the shards' capacities; a node halves its sources, and how many
blocks of each shard the left half gives is one draw from the multivariate
hypergeometric distribution, the right half gives the rest. Leaves are sources.
So every source's quota and every shard's capacity hold exactly, and the table
of counts is distributed as if all blocks had been shuffled together and cut
into shards, yet no step handles more than one node's ``shards`` counts. A shard
then takes the next run of each source's order, which keeps the runs disjoint,
and shuffles its own blocks: ``place`` numbers them from 0 by ``local_key``.

Only DataFrame expressions are used. Draws come from hashes of content, so
reruns agree. Defined cases: a null or empty text has no words, no blocks, and
is never taken; an empty table gives no rows; rows equal in id and text are
drawn separately. Extra columns are ignored by ``mix`` and ``taken_words`` and
kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm.ranks import cell_of, ranked
from emberlog.llm.tables import shuffle_parts
from emberlog.session import materialize

BLOCK_WORDS, SHARDS, MOST_PASSES, WEIGHTS = 64, 16, 3, 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, block_words: int | None, once: bool = False) -> DataFrame:
    """One row per document: row number, id, source, text hash, words, blocks; ``once``: for equal rows together."""
    rows = docs.select(F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("th"), n_words(F.col("text")).alias("size"))
    rows = rows.distinct() if once else rows
    blocks = F.ceil(F.col("size") / block_words) if block_words else (F.col("size") > 0)
    rows = rows.withColumn("blocks", blocks.cast("long")).withColumn("row", F.monotonically_increasing_id())
    return materialize(rows, "sized")  # written once: the row numbers are used twice


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last; ranges of names, not one window."""
    last = F.col("source").isNull().cast("int")
    spread = sources.withColumn("last", last).repartitionByRange(min(8, shuffle_parts(sources.sparkSession)), "last", "source")
    spread = materialize(spread.withColumn("part", F.spark_partition_id()), "sources")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = spread.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    inside = W.partitionBy("part").orderBy("last", "source")
    return spread.join(offsets, "part").select("source", "source_size", "blocks", (F.col("off") + F.row_number().over(inside) - 1).alias("rank"))


def source_targets(rows: DataFrame, most_passes: int = MOST_PASSES) -> DataFrame:
    """``source, source_size, blocks, rank, target``: shares by weight, cut at ``most_passes`` times the source.

    The level a unit of weight gets only rises when cut sources give up their
    excess, so a scalar is iterated until no further source is cut.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("blocks").alias("blocks"))
    sources = materialize(_numbered(sources).withColumn("weight", F.col("rank") % WEIGHTS + 1), "sources")
    limit = F.col("source_size") * most_passes
    total, level, cut_before = None, 0.0, -1
    while True:
        cut = F.col("weight") * F.lit(level) > limit
        row = sources.agg(F.sum("source_size").alias("total"), F.sum(F.when(cut, limit).otherwise(0)).alias("spent"),
                          F.sum(F.when(cut, 0).otherwise(F.col("weight"))).alias("weight"), F.sum(cut.cast("long")).alias("cut")).first()
        total = row["total"] or 0
        if row["cut"] == cut_before or not row["weight"]:
            break
        cut_before, level = row["cut"], (total - row["spent"]) / row["weight"]
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share > limit, limit.cast("double")).otherwise(share))


def _log_factorial(x: Column) -> Column:
    stirling = (x + 0.5) * F.log(x) - x + F.lit(0.9189385332046727) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(x < 2, F.lit(0.0)).otherwise(stirling)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` blocks, ``marked`` of them marked, are marked: inversion of ``u``.

    The sum of probabilities runs from the mode outwards, larger neighbour first.
    """
    def named(**columns: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    def walk(v: Column) -> Column:
        n, k, d, low, high, mode = (v[c] for c in ("n", "k", "d", "low", "high", "mode"))

        def step(s, _):
            r, l = s["r"], s["l"]
            right = F.when(r < high, s["pr"] * (k - r) * (d - r) / ((r + 1) * (n - k - d + r + 1))).otherwise(-1.0)
            left = F.when(l > low, s["pl"] * l * (n - k - d + l) / ((k - l + 1) * (d - l + 1))).otherwise(-1.0)

            def to(p):
                up = p["right"] >= p["left"]
                gain = F.greatest(p["right"], p["left"])
                return named(l=F.when(up, l).otherwise(l - 1), r=F.when(up, r + 1).otherwise(r), pl=F.when(up, s["pl"]).otherwise(p["left"]),
                             pr=F.when(up, p["right"]).otherwise(s["pr"]), u=s["u"] - gain, x=F.when(up, r + 1).otherwise(l - 1), done=s["u"] <= gain)

            return F.when(s["done"], s).otherwise(_let(named(right=right, left=left), to))

        log_p = sum((_let(x, _log_factorial) for x in (k, n - k, d, n - d)), F.lit(0.0)) - sum(
            (_let(x, _log_factorial) for x in (n, mode, k - mode, d - mode, n - k - d + mode)), F.lit(0.0))
        sd = F.sqrt(d * (k / n) * (1 - k / n) * (n - d) / F.greatest(n - 1, F.lit(1.0)))
        steps = F.least(high - low, F.ceil(40 * sd) + 40).cast("int")
        start = _let(F.exp(log_p), lambda p: named(l=mode, r=mode, pl=p, pr=p, u=v["u"] - p, x=mode, done=v["u"] <= p))
        return F.aggregate(F.slice(F.sequence(F.lit(0), steps), 2, steps), start, step, lambda s: s["x"])

    numbers = named(n=total.cast("double"), k=marked.cast("double"), d=draws.cast("double"), u=u)
    bounds = lambda v: named(n=v["n"], k=v["k"], d=v["d"], u=v["u"], low=F.greatest(F.lit(0.0), v["d"] - (v["n"] - v["k"])), high=F.least(v["d"], v["k"]))
    mode = lambda v: F.least(v["high"], F.greatest(v["low"], F.floor((v["d"] + 1) * (v["k"] + 1) / (v["n"] + 2)).cast("double")))
    drawn = _let(_let(_let(numbers, bounds), lambda v: named(**{c: v[c] for c in ("n", "k", "d", "u", "low", "high")}, mode=mode(v))), walk)
    sure = (marked <= 0) | (draws <= 0) | (total <= 0)
    return F.when(sure, F.lit(0).cast("long")).when(marked >= total, draws).when(draws >= total, marked).otherwise(drawn.cast("long"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.call_function("shiftrightunsigned", F.xxhash64(*parts), F.lit(11)).cast("double") + 0.5) / float(1 << 53)


def _left_share(counts: Column, draws: Column, shards: int, *seed: Column) -> Column:
    """One multivariate draw: of a node's blocks by shard, those that the left half of its sources gives."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(total.alias("n"), draws.cast("long").alias("d"), F.array().cast("array<long>").alias("out"))

    def step(s, i):
        def after(v):
            return F.struct((s["n"] - v["have"]).alias("n"), (s["d"] - v["x"]).alias("d"), F.concat(s["out"], F.array(v["x"])).alias("out"))

        drawn = _let(F.element_at(counts, i), lambda have: F.struct(have.alias("have"), hypergeometric(s["n"], have, s["d"], _uniform(*seed, i)).alias("x")))
        return _let(drawn, after)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["out"])


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """``rank, counts``: per source (``rank, quota``), its blocks in each shard; shard sizes differ by one at most."""
    quotas = materialize(quotas.select("rank", F.col("quota").cast("long").alias("quota")), "quotas")
    row = quotas.agg(F.sum("quota").alias("all"), F.max("rank").alias("top")).first()
    total, depth = row["all"] or 0, int(row["top"] or 0).bit_length()
    share = [total // shards + (1 if k < total % shards else 0) for k in range(shards)]
    nodes = quotas.limit(1).select(F.lit(0).cast("long").alias("node"), F.lit(share).cast("array<long>").alias("counts"))
    for level in range(1, depth + 1):
        node = F.shiftright(F.col("rank").cast("long"), depth - level)
        totals = quotas.groupBy(node.alias("child")).agg(F.sum("quota").alias("draws"))
        left = totals.where("child % 2 = 0").select((F.col("child") / 2).cast("long").alias("node"), "draws")
        halves = nodes.join(left, "node", "left").select(
            "node", "counts", _left_share(F.col("counts"), F.coalesce("draws", F.lit(0)), shards, F.lit(seed), F.lit(level), F.col("node")).alias("left"))
        halves = materialize(halves, "halves")
        right = F.zip_with("counts", "left", lambda a, b: a - b)
        nodes = halves.select((F.col("node") * 2).alias("node"), F.col("left").alias("counts")).unionAll(
            halves.select((F.col("node") * 2 + 1).alias("node"), right.alias("counts")))
    return nodes.join(quotas.select(F.col("rank").cast("long").alias("node"), "quota"), "node").select(F.col("node").alias("rank"), "counts")


def drawn_blocks(rows: DataFrame, sources: DataFrame, block_words: int | None = BLOCK_WORDS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """Every drawn block: ``row, doc_id, source, block, words, pass, shard, local_key``."""
    plan = sources.where("source_size > 0").select(
        "source", "rank", F.col("blocks").alias("all_blocks"), F.floor(F.col("target") / F.col("source_size")).cast("long").alias("passes"),
        "target", "source_size")
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    words = F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words) if block_words else F.col("size")
    blocks = rows.where("blocks > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    blocks = blocks.select("row", "doc_id", "source", "block", words.alias("words"), F.xxhash64(F.lit(seed), "doc_id", "th", "block").alias("h"))
    blocks = blocks.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # leading bits order hashes as unsigned numbers; flipping the sign bit does the same inside a cell
    blocks = blocks.withColumn("cell", cell_of(F.col("h"), F.col("all_blocks"))).withColumn("o", F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    order = ranked(blocks, ["rank"], "cell", ["o", "doc_id", "block", "row"], ["words"])
    again = F.col("words_before") + F.col("words") / 2 <= F.col("rest")
    order = order.withColumn("times", F.col("passes") + again.cast("long")).where("times > 0")
    order = materialize(order.select("row", "doc_id", "source", "rank", "block", "words", "position", "all_blocks", "times", "h"), "order")
    counts = split_quotas(order.groupBy("rank").agg(F.sum("times").alias("quota")), shards, seed)
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice("counts", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x))
    ends = counts.select("rank", ends.alias("ends"))
    units = order.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    units = units.withColumn("at", F.col("pass") * F.col("all_blocks") + F.col("position")).join(ends, "rank")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("at")))
    return units.select("row", "doc_id", "source", "block", "words", "pass", shard.alias("shard"),
                        F.xxhash64(F.lit(seed + 1), "h", "pass").alias("local_key"))


def shuffled(drawn: DataFrame) -> DataFrame:
    """Drawn blocks with ``place``, their number in the shard by ``local_key``: from 0, without gaps."""
    drawn = materialize(drawn, "drawn")
    sizes = drawn.groupBy("shard").agg(F.count("*").alias("shard_blocks"))
    cells = drawn.join(sizes, "shard").withColumn("cell", cell_of(F.col("local_key"), F.col("shard_blocks")))
    cells = cells.withColumn("o", F.col("local_key").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    return ranked(cells, ["shard"], "cell", ["o", "doc_id", "block", "pass", "row"]).select(*drawn.columns, F.col("position").alias("place"))


def mix(docs: DataFrame, block_words: int | None = BLOCK_WORDS, shards: int = SHARDS, most_passes: int = MOST_PASSES, seed: int = 7,
        once: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, sources, drawn blocks)`` of the mix."""
    rows = sized(docs, block_words, once)
    sources = source_targets(rows, most_passes)
    return rows, sources, drawn_blocks(rows, sources, block_words, shards, seed)


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """Per document, what the mix takes of it: ``doc_id, size, source_size, target, taken, n_shards, first_shard, first_place``.

    The last two name the first block taken in the order of shards and their
    places; null where nothing is taken.
    """
    rows, sources, drawn = mix(docs, **how)
    taken = shuffled(drawn).groupBy("row").agg(
        F.sum("words").alias("taken"), F.bit_count(F.expr("bit_or(shiftleft(1L, shard))")).alias("n_shards"), F.min(F.struct("shard", "place")).alias("first"))
    sources = sources.select(F.col("source").alias("of"), "source_size", "target")
    return rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("n_shards", F.lit(0)).cast("int").alias("n_shards"),
        F.col("first.shard").cast("int").alias("first_shard"), F.col("first.place").alias("first_place"))


def mixed_documents(docs: DataFrame, shards: int = SHARDS, most_passes: int = MOST_PASSES, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` the mix takes, whole, as often as it takes them (a document is one block), in the mix's order.

    Each shard of the tree is cut by leading bits of ``local_key`` into slices,
    a partition each, and a slice is sorted by ``local_key``: partitions follow
    each other by shard, then place. Rows equal in id, text and source count as one
    document, and each is taken alike. The rows travel as one struct beside the
    mix's own columns, so their names can't clash with those.
    """
    rows, _, drawn = mix(docs, None, shards, most_passes, seed, once=True)
    taken = drawn.join(rows.select("row", "th"), "row").groupBy("doc_id", "source", "th").agg(
        F.collect_list(F.struct("shard", "local_key")).alias("units"))  # at most ``most_passes`` and one
    each = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    same = (F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & F.col("doc.source").eqNullSafe(F.col("source")) & (F.xxhash64("doc.text") == F.col("th")))
    units = each.join(taken, same).select("doc", F.inline("units"))
    bits = max(0, (shuffle_parts(docs.sparkSession) // shards).bit_length() - 1)
    slice_ = F.call_function("shiftrightunsigned", F.col("local_key"), F.lit(64 - bits)).cast("int") if bits else F.lit(0)
    units = units.withColumn("part", F.col("shard").cast("int") * (1 << bits) + slice_)
    order = F.col("local_key").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return units.repartitionById(shards << bits, "part").sortWithinPartitions("part", order).select("doc.*")

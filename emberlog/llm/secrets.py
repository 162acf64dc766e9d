"""Secrets in texts, told from copied examples by who else holds them.

Four kinds of candidates are found by pattern: ``assign`` (a named value),
``access`` (access key ids), ``hex`` (long hex runs) and ``owned`` (other long
mixed tokens). Each candidate's value is hashed; over the whole corpus the
distinct repositories and owners that hold a hash are counted. Exact copies of a
text are one holder: of its owners, the one who holds most texts with the value
(ties: the least name). A value of more than ``most_owners`` owners or more than
``most_repositories`` repositories is a widely copied example; one that stays with
its owner and looks random is live. ``owned`` spans are reported only where that
test says live; base kinds are always reported.

Only DataFrame expressions are used. Positions (code points) are running sums of
the pieces between matches. Holders are first reduced by (hash, text, owner);
frequencies are counted by (hash, owner, repository), then per owner, then per
hash, so a hash that a third of all rows hold is combined before every shuffle;
the joins back are ones Spark can split by skew.

Defined cases: a null text is an empty one; a null owner is an owner of its own;
rows that repeat are reported alike; an empty table gives no rows. Extra columns
are ignored. A text that is edited, however little, is another text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.session import materialize

# fixed values: the patterns, in the order in which spans of one start are listed
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": (ASSIGN, 2, 12),  # pattern, group of the value, least length of the value
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
    "owned": (r"[A-Za-z0-9+/_-]+", 0, 20),
}
# texts without such a run have no candidate of the kind
NEEDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}", "owned": r"[A-Za-z0-9+/_-]{20}"}
# for runs, asking for the least length at once finds the same matches as dropping short ones
LONG_RUN = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}", "owned": r"[A-Za-z0-9+/_-]{20,}"}
MOST_OWNERS, MOST_REPOSITORIES, LEAST_VARIETY = 1, 8, 8


def _matches(text: Column, kind: str) -> Column:
    """Per match of a kind: code points before it since the last match, its length, its value's length and hash."""
    pattern, group, least = PATTERNS[kind]
    pattern = LONG_RUN.get(kind, pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    zipped = F.arrays_zip(gaps.alias("g"), whole.alias("m"), value.alias("v"))
    found = F.transform(zipped, lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"),
        (F.length(x["v"]) >= least).alias("long"), F.xxhash64(x["v"]).alias("hash"), _varied(x["v"]).alias("varied")))
    none = F.array().cast("array<struct<kind:string,gap:int,size:int,long:boolean,hash:bigint,varied:boolean>>")
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(none)


def _varied(value: Column) -> Column:
    """Whether a value looks drawn at random: digits and letters, many different characters."""
    letters = F.array_distinct(F.split(value, ""))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(letters) >= LEAST_VARIETY)


def candidates(docs: DataFrame, repository: str, owner: str) -> tuple[DataFrame, DataFrame]:
    """All rows (numbered) and all candidate spans, each with its row, position, hash, repository, owner and the text's digest."""
    text = F.coalesce("text", F.lit(""))
    all_ = F.concat(*[_matches(text, k) for k in KINDS])
    rows = docs.select("doc_id", F.col(repository).cast("string").alias("repository"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.xxhash64(text).alias("text"), all_.alias("found"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")  # numbered once
    spans = rows.where(F.size("found") > 0).select("row", "repository", "owner", "text", F.posexplode("found").alias("i", "f")).select("row", "repository", "owner", "text", "i", "f.*")
    upto = W.partitionBy("row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = spans.repartition("row").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    spans = spans.withColumn("start", F.col("end") - F.col("size")).where("long").drop("i", "gap", "long")
    return rows, materialize(spans, "spans")


def homes(spans: DataFrame) -> DataFrame:
    """``hash, owner, repository``: one holder for each value and distinct text."""
    held = spans.groupBy("hash", "text", "owner").agg(F.min("repository").alias("repository"))
    texts = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    most = F.min(F.struct((-F.col("n")).alias("n"), "owner", "repository")).alias("home")
    return held.join(texts, ["hash", "owner"]).groupBy("hash", "text").agg(most).select("hash", "home.owner", "home.repository")


def ownership(spans: DataFrame) -> DataFrame:
    """``hash, repositories, owners``: distinct holders of each value over the corpus."""
    held = spans.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def scan(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: spans with ``kind, start, end, repositories, owners, live`` by row number."""
    rows, spans = candidates(docs, repository, owner)
    spans = spans.join(ownership(homes(spans)), "hash")
    stays = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    return rows, spans.withColumn("live", F.col("varied") & stays).where("kind <> 'owned' or live")


def secret_report(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES
) -> DataFrame:
    """Counts per kind, digest of the base spans and list of all spans per document."""
    rows, spans = scan(docs, repository, owner, most_owners, most_repositories)
    number = F.element_at(F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair]), F.col("kind"))
    marked = spans.select("row", F.struct(F.col("start"), number.alias("k"), F.col("end"), "kind", "live").alias("s"))
    per_row = marked.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("s"))  # the matches of one text
    is_base = lambda x: x["kind"] != "owned"
    # an added span that overlaps a base span says nothing new
    alone = lambda x: is_base(x) | ~F.exists("s", lambda y: is_base(y) & (y["start"] < x["end"]) & (x["start"] < y["end"]))
    per_row = per_row.select("row", F.filter("s", alone).alias("s"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    out = rows.select("row", "doc_id").join(per_row, "row", "left").withColumn("s", F.coalesce("s", F.array().cast(per_row.schema["s"].dataType)))
    count = lambda test: F.size(F.filter("s", test)).cast("long")
    of_kind = lambda kind: lambda x: x["kind"] == kind
    return out.select(
        "doc_id", *[count(of_kind(k)).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.filter("s", is_base)), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"), count(lambda x: ~x["live"]).alias("n_copied"))

"""Spelling variants by permuterm rotations.

A word gets an end mark and is written in all its rotations. Two words that
differ in one replaced letter have rotations that are equal but for their last
letter, the edited one; a word and the same word with one letter more have a
rotation where one is the other without its last letter. So every word enters a
*slot* for each letter, its rotation without that letter (the prefix range that
skips the edited letter), and a slot for each whole rotation. Slots are sorted
and scanned in one window. A slot holds at most one whole word and one word for
each letter of the alphabet, 91 rows, whatever the corpus.

No pair of words is written. In a slot the letter rows are each other's
replacement neighbours and the whole word's insertions; each row takes their
number and the best one that isn't itself (first or second in the slot). A
repeated letter could be the inserted one at several places, so an insertion
counts only in the slot of its run's first letter; then every pair meets once
and numbers just add up over a word's slots.

Roots follow the chain of forms by doubling its steps: n grows five times at
every step, so no chain of long counts has more than 27.

Defined cases: null texts have no words, a null id is written as the empty text
in front of the colon; rows that repeat count again; texts of any length are
read whole; equal n goes by code-point order. An empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_TIMES, FACTOR, DROP_EVERY, END = 6, 5, 5, 199, "$"


def words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word, n``: letter runs of whole texts, one letter dropped from every ``drop_every``-th by hash.

    Runs shorter than ``least_letters`` cannot become words and are not matched.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_letters},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "cast(h % length(run) as int)"
    word = f"if(h % {drop_every} = 0, concat(substring(run, 1, {at}), substring(run, {at} + 2)), run)"
    found = hashed.select(F.expr(word).alias("word")).where(F.length("word") >= least_letters)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def slots(vocabulary: DataFrame) -> DataFrame:
    """``slot, word, less, whole, opens``: every rotation whole, and without its last letter."""
    turned = f"concat(substring(word, i + 1), '{END}', substring(word, 1, {{upto}}))"
    whole = f"transform(sequence(0, length(word)), i -> struct({turned.format(upto='i')} AS slot, true AS whole, true AS opens))"
    opens = "i = 1 OR substring(word, i, 1) <> substring(word, i - 1, 1)"
    letter = f"transform(sequence(1, length(word)), i -> struct({turned.format(upto='i - 1')} AS slot, false AS whole, {opens} AS opens))"
    return vocabulary.select("word", (-F.col("n")).alias("less"), F.expr(f"inline(concat({whole}, {letter}))")).select("slot", "word", "less", "whole", "opens")


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``word, n_near, best`` (``less, word`` of the most frequent near word) of every word that has near words."""
    slot = W.partitionBy("slot")
    scan = slot.orderBy("whole", "less", "word")
    everything = scan.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    me, letter = F.struct("less", "word"), ~F.col("whole")
    seen = slots(vocabulary).select(
        "word", "whole", "opens",
        F.row_number().over(scan).alias("place"), F.count("*").over(everything).alias("rows"),
        F.count_if(letter).over(everything).alias("letters"), F.count_if(letter & F.col("opens")).over(everything).alias("openers"),
        F.first(me).over(everything).alias("first"), F.nth_value(me, 2).over(everything).alias("second"),
        F.min(F.when(letter & F.col("opens"), me)).over(everything).alias("first_opener"),
        F.max(F.when(F.col("whole"), me)).over(everything).alias("entire"),
    ).where("rows > 1")
    inserted = F.col("opens") & F.col("entire").isNotNull()
    replaced = F.when(F.col("place") > 1, F.col("first")).when(F.col("letters") > 1, F.col("second"))
    met = seen.select(
        "word",
        F.when(F.col("whole"), F.col("openers")).otherwise(F.col("letters") - 1 + inserted.cast("int")).alias("near"),
        F.when(F.col("whole"), F.col("first_opener")).otherwise(F.least(replaced, F.when(inserted, F.col("entire")))).alias("best"),
    ).where("near > 0")
    return met.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` by pointer doubling; a word that is nobody's ``word`` is a root."""
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialize(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(docs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    vocabulary = materialize(words(docs), "words")
    known = vocabulary.join(neighbours(vocabulary), "word", "left")
    far = -F.col("best.less") >= factor * F.col("n")
    known = materialize(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far, F.col("best.word")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

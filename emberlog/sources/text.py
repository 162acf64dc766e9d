"""Log text: ten whitespace-separated fields per line, the tenth free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions import scalars as S

# The fields of a line, in order.
LINE_FIELDS = (
    "label", "timestamp_int", "date", "node", "datetime_str", "node_repeat", "type", "component", "level", "content",
)
# The characters that separate fields (Unicode white space and the ASCII separators).
BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines, numbered ``_line`` from 0 by file name and place in the file.

    A scan knows a line's order only inside its split. Splits are counted (one
    row each), and the counts before a split turn the order into the number, so
    it is a function of the files, not of how they were split.
    """
    raw = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    split = ["_file", "_split"]
    before = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    starts = raw.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    starts = starts.select(*split, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return raw.join(starts, split).select("value", (F.col("_seq") + F.col("_shift")).alias("_line"))


def head_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` physical lines; only the first files by name that hold as many are read."""
    files, most = sorted(spark.read.text(path).inputFiles()), 1
    while most < len(files) and spark.read.text(files[:most]).limit(n).count() < n:
        most *= 2
    return read_lines(spark, files[:most] or path).where(F.col("_line") < n)


def split_line(value: Column) -> Column:
    """Up to ten fields; the tenth keeps its inner and trailing blanks."""
    return F.split(F.regexp_replace(value, "^" + BLANKS, ""), BLANKS, 10)


def enough_fields(fields: Column) -> Column:
    """At least nine; an empty ninth is only the blanks behind the eighth."""
    return (F.size(fields) == 10) | ((F.size(fields) == 9) & (F.element_at(fields, -1) != ""))


def valid_line(value: Column) -> Column:
    """Non-blank with at least nine fields."""
    return enough_fields(split_line(value))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Typed log table; lines with fewer than nine fields are dropped.

    ``event_id`` is the line's number over all files by name: the same whenever
    the same files are read, however they are split.
    """
    # one row out per complete line: split once, where a filter in front would split again
    complete = F.filter(F.array(split_line(F.col("value"))), enough_fields)
    fields = lines.select(F.col("_line").alias("event_id"), F.explode(complete).alias("f"))
    named = fields.select("event_id", *[F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(LINE_FIELDS)])
    typed = named.select(
        "event_id", "label",
        S.safe_long(F.col("timestamp_int")).alias("timestamp_int"),
        "date", "node", "type", "component", "level", "content",
        S.label_flag(F.col("label")).alias("is_anomaly"),
        S.parse_timestamp(F.col("datetime_str"), F.col("date")).alias("timestamp"),
    )
    return typed


def load_logs(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    """Parse log text; ``nrows`` counts physical lines. A missing path raises."""
    return parse_lines(read_lines(spark, path) if nrows is None else head_lines(spark, path, nrows))


def load_sample(spark: SparkSession, path: str, n: int = 10_000) -> DataFrame:
    return load_logs(spark, path, nrows=n)


def chronological(logs: DataFrame, *ties: str) -> DataFrame:
    """Sort by time, unknown times last (a distributed range sort)."""
    return logs.orderBy(F.col("timestamp").asc_nulls_last(), *ties)

"""Per-row expressions over log columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Log level to severity score.
SEVERITY_SCORES = {"INFO": 0, "WARNING": 1, "WARN": 1, "ERROR": 2, "SEVERE": 3, "FATAL": 4}

# Timestamp patterns of the log text.
TIMESTAMP_PATTERN = "yyyy-MM-dd-HH.mm.ss.SSSSSS"
DATE_PATTERN = "yyyy.MM.dd"

# Lower bounds of the severity names on each scale, highest first.
STREAM_SCALE = ((0.85, "CRITICAL"), (0.70, "HIGH"), (0.55, "MEDIUM"))
ALERT_SCALE = ((0.7, "CRITICAL"), (0.5, "HIGH"), (0.3, "MEDIUM"))
PERCENTILE_SCALE = ((0.95, "CRITICAL"), (0.80, "HIGH"), (0.50, "MEDIUM"))

# Severity name to weak label.
WEAK_LABELS = {"CRITICAL": 1, "HIGH": 1, "MEDIUM": 0, "LOW": 0}

# Columns that never count as features.
NON_FEATURES = (
    "timestamp", "timestamp_int", "date", "node", "type", "component", "level", "content",
    "label", "is_anomaly", "datetime_str", "node_repeat", "severity_score",
)


def label_flag(label: Column) -> Column:
    return label != F.lit("-")


def parse_timestamp(text: Column, date: Column | None = None) -> Column:
    """Log timestamp, else the date alone, else null."""
    parsed = F.try_to_timestamp(text, F.lit(TIMESTAMP_PATTERN))
    if date is not None:
        parsed = F.coalesce(parsed, F.try_to_timestamp(date, F.lit(DATE_PATTERN)))
    return parsed.cast("timestamp_ntz")


def safe_long(text: Column) -> Column:
    return text.try_cast("bigint")


def severity_score(level: Column) -> Column:
    name = F.upper(level)
    expr = F.lit(0)
    for score in sorted(set(SEVERITY_SCORES.values())):
        names = [k for k, v in SEVERITY_SCORES.items() if v == score]
        if score:
            expr = F.when(name.isin(names), F.lit(score)).otherwise(expr)
    return expr.cast("tinyint")


def is_error(score: Column) -> Column:
    return (score >= 2).cast("tinyint")


def is_warning(score: Column) -> Column:
    return (score == 1).cast("tinyint")


def is_fatal(score: Column) -> Column:
    return (score >= 3).cast("tinyint")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def burst_flag(count_short: Column, count_long: Column, long_minutes: int = 15) -> Column:
    return (count_short > count_long / F.lit(float(long_minutes)) * 2).cast("tinyint")


def as_features(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Null to 0, 32-bit floats."""
    return [F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).alias(c) for c in columns]


def feature_columns(columns: Iterable[str], extra: Iterable[str] = ()) -> list[str]:
    skip = {*NON_FEATURES, *extra}
    return [c for c in columns if c not in skip]


def safe_name(component: str) -> str:
    return "comp_" + str(component).replace(" ", "_").replace("-", "_").lower()


def safe_name_of(component: Column) -> Column:
    """The same name as a column, for any number of components."""
    return F.concat(F.lit("comp_"), F.lower(F.translate(component, " -", "__")))


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The trained columns in the trained order; a missing one is 0."""
    have = set(df.columns)
    return df.select(
        *keep, *[(F.coalesce(F.col(c), F.lit(0)) if c in have else F.lit(0)).cast("float").alias(c) for c in columns]
    )


def weak_label(severity: Column) -> Column:
    expr = None
    for name, value in WEAK_LABELS.items():
        expr = F.when(severity == name, value) if expr is None else expr.when(severity == name, value)
    return expr.cast("int")


def ladder(score: Column, scale: Sequence[tuple[float, str]], default: str = "LOW") -> Column:
    """Name of the highest bound the score reaches."""
    expr = None
    for bound, name in scale:
        hit = score >= F.lit(bound)
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr.otherwise(default)


def min_max_scale(df: DataFrame, score: str, out: str) -> DataFrame:
    """(s - min) / (max - min + 1e-9) with the bounds as scalar subqueries."""
    lo = df.agg(F.min(score)).scalar()
    hi = df.agg(F.max(score)).scalar()
    return df.withColumn(out, (F.col(score) - lo) / (hi - lo + F.lit(1e-9)))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def round_binary(x: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as Python's ``round`` does.

    Spark rounds the shortest decimal text of a double, which turns 0.39135
    (really 0.391349..) into 0.3914. A scaled value that lands on .5 is decided
    by the sign of the product's rounding error (Dekker's two-product).
    """
    x = x.cast("double")
    scale = float(10**digits)
    half = F.lit(134217729.0)  # 2^27 + 1 splits a double in two
    sh = 134217729.0 * scale - (134217729.0 * scale - scale)
    sl = scale - sh
    xh = half * x - (half * x - x)
    xl = x - xh
    p = x * F.lit(scale)
    err = ((xh * F.lit(sh) - p) + xh * F.lit(sl) + xl * F.lit(sh)) + xl * F.lit(sl)
    low = F.floor(p).cast("double")
    part = p - low
    up = (part > 0.5) | ((part == 0.5) & ((err > 0) | ((err == 0) & (low % 2 != 0))))
    return (low + F.when(up, 1.0).otherwise(0.0)) / F.lit(scale)


def fixed_text(x: Column, digits: int) -> Column:
    """``%.<digits>f`` of the exact binary value."""
    return F.format_string(f"%.{digits}f", round_binary(x, digits))


def percent_text(share: Column) -> Column:
    """``12.3%``."""
    return F.concat(fixed_text(share * 100, 1), F.lit("%"))


def incident_id(*parts: Column, prefix: str = "AN-", digits: int = 8) -> Column:
    """An id that stays the same when a task is retried.

    Eight digits are for display; keys that must be unique at scale take 32.
    """
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(text, 256), 1, digits)))


def export_row(df: DataFrame) -> DataFrame:
    """Event as shown outside: text timestamp, score to 4 places."""
    return df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "anomaly_score", round_binary(F.col("anomaly_score"), 4)
    )


def context_prefix(node: Column, score: Column, ts: Column, message: Column) -> Column:
    """A chat message led by the incident it is about."""
    lead = F.format_string(
        "[Contexto — nodo: %s, score: %s, timestamp: %s]\n\n",
        F.coalesce(node, F.lit("N/A")),
        fixed_text(F.coalesce(score.cast("double"), F.lit(0.0)), 3),
        F.coalesce(ts.cast("string"), F.lit("N/A")),
    )
    empty = node.isNull() & score.isNull() & ts.isNull()
    return F.when(empty, message).otherwise(F.concat(lead, message))


def type_label(flag: Column) -> Column:
    return F.when(flag, "🔴 Anomalía").otherwise("🟢 Normal")


# Display names of the severities.
SEVERITY_DISPLAY = {
    "LOW": "🟢 LOW",
    "MEDIUM": "🟡 MEDIUM",
    "HIGH": "🟠 HIGH",
    "CRITICAL": "🔴 CRITICAL",
}


def severity_display(severity: Column) -> Column:
    expr = None
    for name, shown in SEVERITY_DISPLAY.items():
        expr = F.when(severity == name, shown) if expr is None else expr.when(severity == name, shown)
    return expr


LOG_ENTRY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("node", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

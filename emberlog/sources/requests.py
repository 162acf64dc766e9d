"""Detection requests: JSON documents holding a list of log entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions import scalars as S

# Entry defaults.
ENTRY_DEFAULTS = {"level": "INFO", "component": "UNKNOWN", "content": "", "label": "-"}
DEFAULT_WINDOW_MINUTES = 5

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("logs", T.ArrayType(S.LOG_ENTRY)),
        T.StructField("window_minutes", T.IntegerType()),
    ]
)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST).json(path)


def explode_requests(requests: DataFrame) -> DataFrame:
    """One row per entry, defaults filled, severity, truth and the two flags added."""
    entry = requests.select(
        "request_id",
        F.coalesce("window_minutes", F.lit(DEFAULT_WINDOW_MINUTES)).alias("window_minutes"),
        F.posexplode("logs").alias("pos", "e"),
    )
    rows = entry.select(
        "request_id", "window_minutes", "pos", "e.timestamp", "e.node",
        *[F.coalesce(F.col(f"e.{c}"), F.lit(v)).alias(c) for c, v in ENTRY_DEFAULTS.items()],
    )
    return (
        rows.withColumn("severity_score", S.severity_score(F.col("level")))
        .withColumn("is_anomaly", S.label_flag(F.col("label")))
        .withColumn("error_flag", S.is_error(F.col("severity_score")))
        .withColumn("fatal_flag", S.is_fatal(F.col("severity_score")))
    )

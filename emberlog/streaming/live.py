"""The live monitor as streaming queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from emberlog.functions import scalars as S
from emberlog.operators.prefix import epoch_us
from emberlog.session import scratch_path

FEED_ROWS = 50

# The canned summaries shown in turn, in order.
CANNED_SUMMARIES = (
    (
        "Error de paridad TLB detectado en procesador. El sistema ejecutó corrección automática.",
        "HIGH",
        "Fallo intermitente en caché L1/L2 del procesador.",
        "Monitorear el nodo 24h; si persiste, programar reemplazo de CPU.",
    ),
    (
        "Fallo de comunicación en socket CioStream. El proceso ciod no pudo leer el prefijo de mensaje.",
        "CRITICAL",
        "Corrupción de memoria o fallo de red en la interconexión del supercomputador.",
        "Reiniciar el nodo afectado y revisar logs de red. Escalar a equipo de hardware.",
    ),
    (
        "Machine check NMI recibido. Posible error de hardware no recuperable.",
        "CRITICAL",
        "Error en DIMM de memoria o fallo en bus del sistema.",
        "Evacuar jobs del nodo inmediatamente. Ejecutar diagnóstico de hardware.",
    ),
    (
        "Error de sistema de archivos detectado en dispositivo sdb. Posible corrupción de disco.",
        "HIGH",
        "Error de E/S en disco o inconsistencia en journal ext3.",
        "Ejecutar fsck en modo mantenimiento. Revisar SMART del disco.",
    ),
)


def live_severity(is_anomaly: Column, score: Column) -> Column:
    return F.when(is_anomaly, S.ladder(score, S.STREAM_SCALE)).otherwise("LOW")


def score_events(stream: DataFrame) -> DataFrame:
    """Events with their live severity; works on batches and streams alike."""
    return stream.withColumn("severity", live_severity(F.col("is_anomaly"), F.col("anomaly_score")))


def counters(stream: DataFrame) -> DataFrame:
    """Events, anomalies and rate so far."""
    return stream.groupBy().agg(F.count("*").alias("n_events"), F.count_if("is_anomaly").alias("n_anomalies")).withColumn(
        "rate", F.col("n_anomalies") / F.greatest(F.col("n_events"), F.lit(1))
    )


def latest_anomaly(stream: DataFrame) -> DataFrame:
    """Counters with the newest anomaly by (time, id)."""
    row = F.when(F.col("is_anomaly"), F.struct("event_id", "timestamp", "node", "anomaly_score", "severity"))
    order = F.when(F.col("is_anomaly"), F.struct("timestamp", "event_id"))
    return stream.groupBy().agg(F.count_if("is_anomaly").alias("n_anomalies"), F.max_by(row, order).alias("a")).select(
        "n_anomalies", "a.*"
    )


def inject(stream: DataFrame, forced: DataFrame) -> DataFrame:
    """Hand-made events merged into the stream."""
    return stream.unionByName(forced)


def canned_summary_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(CANNED_SUMMARIES)]
    return spark.createDataFrame(
        rows, "slot int, resumen string, severidad string, causa_probable string, accion_recomendada string"
    )


def with_canned_summary(latest: DataFrame) -> DataFrame:
    """The summary whose turn it is: slot (n_anomalies - 1) mod 4."""
    slots = canned_summary_table(latest.sparkSession)
    turn = latest.withColumn("slot", F.pmod(F.col("n_anomalies") - 1, F.lit(len(CANNED_SUMMARIES))).cast("int"))
    return turn.join(slots, "slot")


def rolling_stream(
    stream: DataFrame, size: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes", ts: str = "timestamp"
) -> DataFrame:
    """Sliding-window features; rows later than the watermark are dropped.

    Two stateful steps: totals by window and node, which leave when the window
    closes, then their sums by window. A node is one row of the second step, so
    ``unique_nodes`` is exact, and a window holding many rows of few nodes keeps
    little state. A time without zone is taken and given back as it is written.
    """
    sev = F.col("severity_score")
    plain = isinstance(stream.schema[ts].dataType, TimestampNTZType)
    timed = stream.withColumn(ts, F.timestamp_micros(epoch_us(F.col(ts))))  # event time must carry a zone
    by_node = (
        timed.withWatermark(ts, late)
        .groupBy(F.window(ts, size, slide).alias("span"), "node")
        .agg(F.count("*").alias("n"), F.sum(S.is_error(sev)).alias("errors"), F.sum(S.is_warning(sev)).alias("warnings"),
             F.sum(S.is_fatal(sev)).alias("fatals"), F.sum(sev).alias("severity"), F.count(sev).alias("scored"))
    )
    by_window = by_node.groupBy("span").agg(
        F.sum("n").alias("total_count"), F.sum("errors").alias("error_count"), F.sum("warnings").alias("warning_count"),
        F.sum("fatals").alias("fatal_count"), F.try_divide(F.sum("severity"), F.sum("scored")).alias("avg_severity"), F.count("node").alias("unique_nodes"))

    def written(at):
        us = F.unix_micros(at)
        return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=(us / 1_000_000).cast("decimal(18,6)")) if plain else at

    return by_window.select(
        written(F.col("span.start")).alias("window_start"), written(F.col("span.end")).alias("window_end"), "total_count",
        "error_count", "warning_count", "fatal_count", "avg_severity", "unique_nodes")


def run_available(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over all data there is and return its output table.

    Each micro-batch overwrites its own folder, so a repeated batch does not
    count twice. ``complete`` output is the last batch, ``append`` all of them.
    """
    spark = stream.sparkSession
    root = scratch_path(spark, f"stream-{name}")
    last = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")
        last.append(batch_id)

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    if not last:
        return spark.createDataFrame([], stream.schema)
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(f"{root}/out/batch={max(last)}")
    return spark.read.schema(stream.schema).option("basePath", f"{root}/out").parquet(f"{root}/out").select(*stream.columns)


def run_feed(
    stream: DataFrame, rows: int = FEED_ROWS, ts: str = "timestamp", row_id: str = "event_id", root: str | None = None
) -> DataFrame:
    """The newest ``rows`` events, newest first.

    A micro-batch contributes at most ``rows`` rows (a heap per task), merged
    with the feed the batch before it left in ``root``. A repeated batch, also
    after a restart on the same ``root``, writes the same feed.
    """
    spark = stream.sparkSession
    root = root or scratch_path(spark, "stream-feed")
    newest_first = [F.col(ts).desc(), F.col(row_id).desc()]
    done = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        feed = batch.orderBy(*newest_first).limit(rows)
        if batch_id > 0:
            before = spark.read.schema(batch.schema).parquet(f"{root}/feed/{batch_id - 1}")
            feed = feed.unionByName(before).orderBy(*newest_first).limit(rows)
        feed.write.mode("overwrite").parquet(f"{root}/feed/{batch_id}")
        done.append(batch_id)

    query = (
        stream.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).foreachBatch(merge).start()
    )
    query.awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{root}/feed/{max(done)}").orderBy(*newest_first)

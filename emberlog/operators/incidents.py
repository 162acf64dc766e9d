"""Incidents: context around a detection, answers, labels, history, tickets."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions import filters
from emberlog.functions import scalars as S
from emberlog.functions.responses import ANSWER_FIELDS, NO_CLIENT, parse_answers, render_prompt
from emberlog.operators.aggregates import top_nodes, value_counts
from emberlog.operators.prefix import MINUTE_US, epoch_us, floor_div, needs_fine_cells, range_totals, running_totals
from emberlog.operators.ranking import latest, percent_rank_average, top_k, top_k_per_group

SAMPLE_MESSAGES = 5
TOP_COMPONENTS = 5


def _minutes_touched(lo: Column, hi: Column) -> Column:
    return F.explode(F.sequence(floor_div(lo, MINUTE_US), floor_div(hi, MINUTE_US)))


MEASURES = ("total_events", "error_count", "warning_count", "fatal_count", "sev")


def _totals_near(spans: DataFrame, rows: DataFrame, fine: bool) -> DataFrame:
    """Totals of each span and its five most frequent components, as one text.

    Both come from totals per (span, component), asked only for components
    present in a minute the span touches.
    """
    minute = floor_div(F.col("us"), MINUTE_US)
    # a row without component still counts in the totals
    rows = rows.select("us", F.coalesce("component", F.lit("")).alias("component"), F.col("severity_score").alias("sev"))
    present = rows.select("component", minute.alias("_m")).distinct()
    asked = spans.withColumn("_m", _minutes_touched(F.col("lo"), F.col("hi"))).join(present, "_m")
    asked = asked.select("component", "span_id", "lo", "hi").distinct()
    sev = F.col("sev")
    counted = rows.select(
        "component", "us", F.lit(1).alias("total_events"), S.is_error(sev).alias("error_count"),
        S.is_warning(sev).alias("warning_count"), S.is_fatal(sev).alias("fatal_count"), sev.cast("long").alias("sev"),
    )
    found = range_totals(counted, asked, MEASURES, ["component"], fine).where(F.col("total_events") > 0)
    w = W.partitionBy("span_id").orderBy(F.col("component") == "", F.col("total_events").desc(), "component")
    shown = (F.col("_rn") <= TOP_COMPONENTS) & (F.col("component") != "")
    best = F.array_sort(F.collect_list(F.when(shown, F.struct("_rn", "component"))))
    return (
        found.withColumn("_rn", F.row_number().over(w))
        .groupBy("span_id")
        .agg(*[F.sum(m).alias(m) for m in MEASURES],
             F.array_join(F.transform(best, lambda x: x["component"]), ", ").alias("components"))
    )


def _first_messages(spans: DataFrame, rows: DataFrame, k: int, fine: bool) -> DataFrame:
    """The first k messages of each span by (time, id), as one text.

    At most k messages of an instant can matter, so the others are dropped
    before messages get positions; a span then asks for at most k positions.
    """
    kept = top_k_per_group(rows.where(F.col("content").isNotNull()).select("us", "event_id", "content"), ["us"], [F.col("event_id")], k)
    instants = kept.groupBy("us").agg(
        F.count("*").alias("m"), F.array_sort(F.collect_list(F.struct("event_id", "content"))).alias("list")
    )
    run = running_totals(instants.withColumn("ord", F.lit(0)), ["m"], fine=fine)
    placed = run.select((F.col("run_m") - F.col("m")).alias("_at"), F.posexplode("list").alias("_i", "e"))
    placed = placed.select((F.col("_at") + F.col("_i")).alias("pos"), F.col("e.content").alias("content"))
    ends = range_totals(instants.select("us", "m"), spans, ["m"], fine=fine).where(F.col("m") > 0)
    wanted = ends.select(
        "span_id",
        F.explode(F.sequence(F.col("m_before"), F.col("m_before") + F.least("m", F.lit(k)) - 1)).alias("pos"),
    )
    found = wanted.join(placed, "pos").groupBy("span_id")
    lines = F.array_sort(F.collect_list(F.struct("pos", "content")))
    return found.agg(
        F.array_join(F.transform(lines, lambda x: F.concat(F.lit("  - "), x["content"])), "\n").alias("sample_messages")
    )


def build_contexts(
    incidents: DataFrame, events: DataFrame, before_min: float = 5, after_min: float = 5, n_messages: int = SAMPLE_MESSAGES
) -> DataFrame:
    """One context row per incident over all nodes' events around its time.

    ``incidents``: anomaly_id, timestamp, node, anomaly_score. ``events`` need
    event_id, timestamp, severity_score, component, content. Totals come from
    running totals; incidents and events are never paired.
    """
    t = epoch_us(F.col("timestamp"))
    spans = incidents.select(
        F.col("anomaly_id").alias("span_id"),
        (t - int(before_min * MINUTE_US)).alias("lo"),
        (t + int(after_min * MINUTE_US)).alias("hi"),
    )
    rows = events.where(F.col("timestamp").isNotNull()).select(
        epoch_us(F.col("timestamp")).alias("us"), "event_id", "severity_score", "component", "content"
    )
    fine = needs_fine_cells(rows.select("us").unionByName(spans.select(F.col("lo").alias("us"))))
    totals = _totals_near(spans, rows, fine)
    n = F.col("total_events")
    empty = F.coalesce(n, F.lit(0)) == 0
    messages = _first_messages(spans, rows, n_messages, fine)
    about = totals.join(messages, "span_id", "left").withColumnRenamed("span_id", "anomaly_id")
    out = incidents.join(about, "anomaly_id", "left")
    return out.select(
        "anomaly_id", "node", 
        F.regexp_replace(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.0+$", "").alias("timestamp"),
        F.coalesce(n, F.lit(0)).alias("total_events"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
        F.when(empty, "0.0%").otherwise(S.percent_text(F.col("error_count") / n)).alias("error_rate"),
        F.coalesce("warning_count", F.lit(0)).alias("warning_count"),
        F.coalesce("fatal_count", F.lit(0)).alias("fatal_count"),
        F.coalesce("components", F.lit("")).alias("components"),
        F.when(empty, 0.0).otherwise(S.round_binary(F.col("sev") / n, 2)).alias("avg_severity"),
        F.coalesce("sample_messages", F.lit("")).alias("sample_messages"),
        "anomaly_score",
    )


Client = Callable[[str], str]


def summarize(contexts: DataFrame, client_factory: Callable[[], Client] | None = None) -> DataFrame:
    """Answer fields per incident. Without a client, or when a call fails, the fixed answer.

    The factory runs once per partition, so a connection is not shipped around.
    """
    fixed = [F.lit(NO_CLIENT[f]).alias(f) for f in ANSWER_FIELDS]
    if client_factory is None:
        return contexts.select("anomaly_id", *fixed, F.lit(0.0).alias("response_time_ms"))
    prompts = contexts.select("anomaly_id", render_prompt(F.col("anomaly_score")).alias("prompt"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            texts, times = [], []
            for prompt in pdf["prompt"]:
                start = time.monotonic()
                try:
                    texts.append(client(prompt))
                except Exception:  # noqa: BLE001 - any client error means the fixed answer
                    texts.append(None)
                times.append(round((time.monotonic() - start) * 1000, 1))
            yield pd.DataFrame({"anomaly_id": pdf["anomaly_id"], "response": texts, "response_time_ms": times})

    kind = contexts.schema["anomaly_id"].dataType.simpleString()
    answers = prompts.mapInPandas(ask, f"anomaly_id {kind}, response string, response_time_ms double")
    parsed = parse_answers(answers)
    failed = F.col("response").isNull()
    return parsed.select(
        "anomaly_id", *[F.when(failed, NO_CLIENT[f]).otherwise(F.col(f)).alias(f) for f in ANSWER_FIELDS], "response_time_ms"
    )


def weak_labels(
    predictions: DataFrame, events: DataFrame, client_factory: Callable[[], Client] | None = None, k: int = 300
) -> DataFrame:
    """Labels for training: answers on the top k detections, else the truth column."""
    if client_factory is None:
        flag = F.col("is_anomaly").cast("int")
        return predictions.select(
            "timestamp", "node", F.when(flag == 1, "CRITICAL").otherwise("LOW").alias("severidad"), flag.alias("llm_label")
        )
    best = top_k(predictions.where("is_predicted_anomaly"), k, "anomaly_score")
    best = best.withColumn("anomaly_id", F.col("event_id"))
    contexts = build_contexts(best.select("anomaly_id", "timestamp", "node", "anomaly_score"), events)
    answers = summarize(contexts.where(F.col("total_events") > 0), client_factory)
    out = best.select("anomaly_id", "timestamp", "node").join(answers, "anomaly_id")
    out = out.select("timestamp", "node", "severidad", S.weak_label(F.col("severidad")).alias("llm_label"))
    return filters.with_labels_only(out)


def history_labels(predictions: DataFrame) -> DataFrame:
    """Incident history with severities by score percentile among detections."""
    ranked = percent_rank_average(predictions.where("is_predicted_anomaly"), "anomaly_score")
    return ranked.select(
        S.incident_id(F.col("event_id")).alias("anomaly_id"), "timestamp", "node",
        S.ladder(F.col("pct"), S.PERCENTILE_SCALE).alias("severidad"), F.lit(1).alias("llm_label"),
    )


def _severity_counts(history: DataFrame) -> list[Column]:
    counts = [F.count("*").alias("total")]
    if "severidad" in history.columns:
        counts += [F.count_if(F.col("severidad") == s).alias(s.lower()) for s in ("CRITICAL", "HIGH", "MEDIUM")]
    return counts


def history_by_node(history: DataFrame) -> DataFrame:
    """The history of every node at once."""
    return history.groupBy("node").agg(*_severity_counts(history))


def node_history(history: DataFrame, pattern: str, days_back: int | None = None) -> DataFrame:
    """Incidents of the nodes matching a pattern, by severity.

    ``days_back`` filters only when given.
    """
    mine = history.where(filters.node_matches(F.col("node"), pattern))
    if days_back is not None:
        newest = history.agg(F.max("timestamp")).scalar()
        mine = mine.where(F.col("timestamp") >= newest - F.expr(f"interval {int(days_back)} days"))
    return mine.agg(*_severity_counts(history))


def severity_distribution(history: DataFrame) -> DataFrame:
    return value_counts(history, "severidad")


def tickets(incidents: DataFrame, summary: str = "resumen", created: Column | None = None) -> DataFrame:
    """One open ticket per incident; the first team takes HIGH and CRITICAL."""
    urgent = F.col("severidad").isin("HIGH", "CRITICAL")
    at = F.current_timestamp() if created is None else created
    return incidents.select(
        S.incident_id(F.col("anomaly_id"), F.lit("ticket"), prefix="INC").alias("ticket_id"),
        F.col("severidad").alias("severity"), "node", F.substring(summary, 1, 120).alias("summary"),
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm"), F.lit(" UTC")).alias("created"),
        F.lit("OPEN").alias("status"),
        F.when(urgent, "NOC-Team-1").otherwise("NOC-Team-2").alias("assignee"),
    )


__all__ = [
    "build_contexts", "history_by_node", "history_labels", "latest", "node_history", "severity_distribution", "summarize", "tickets",
    "top_nodes", "weak_labels",
]

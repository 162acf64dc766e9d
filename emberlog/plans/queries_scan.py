"""Queries: sources and sinks, scalar functions, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions import filters
from emberlog.functions import scalars as S
from emberlog.functions.responses import PROMPT, PROMPT_FIELDS, parse_answers, render_prompt
from emberlog.operators import drift
from emberlog.operators.aggregates import value_counts
from emberlog.operators.detector import AnomalyDetector
from emberlog.operators.features import add_component_flags, top_components
from emberlog.operators.incidents import build_contexts, tickets
from emberlog.operators.windows import add_rolling_features
from emberlog.plans.logview import read_table
from emberlog.plans.registry import log_table, query, ts_sql, ts_text
from emberlog.session import scratch_path
from emberlog.sources import requests, stream, tables, text
from emberlog.streaming import live

# ---------------------------------------------------------------- sources


def _render_lines(logs: DataFrame, date: str = "yyyy.MM.dd") -> DataFrame:
    ts = F.col("timestamp")
    return logs.select(
        "event_id",
        F.concat_ws(
            " ", "label", F.unix_seconds(ts.cast("timestamp")).cast("string"), F.date_format(ts, date), "node",
            F.date_format(ts, "yyyy-MM-dd-HH.mm.ss.SSSSSS"), "node", F.lit("RAS"), "component", "level",
            F.concat("content", F.lit("  id="), F.col("event_id").cast("string")),
        ).alias("value"),
    )


def _text_folder(spark: SparkSession, sf_dir: str) -> str:
    """The log view written as ten-field text, files in event order."""
    path = scratch_path(spark, "log-text")
    _render_lines(log_table(spark, sf_dir)).orderBy("event_id").select("value").write.text(path)
    return path


_LINE_SQL = f"""
SELECT label, CAST(epoch(date_trunc('second', timestamp)) AS BIGINT) AS timestamp_int,
       strftime(timestamp, '%Y.%m.%d') AS date, node, 'RAS' AS type, component, level,
       content || '  id=' || CAST(event_id AS VARCHAR) AS content, is_anomaly, {ts_sql()} AS ts
FROM logs"""


def _line_columns(df: DataFrame) -> DataFrame:
    return df.select("label", "timestamp_int", "date", "node", "type", "component", "level", "content", "is_anomaly",
                     ts_text().alias("ts"))


@query("s1_log_text_scan", _LINE_SQL)
def s1(spark, d):
    return _line_columns(text.load_logs(spark, _text_folder(spark, d)))


@query("s2_head_limited_scan", _LINE_SQL + " ORDER BY event_id LIMIT 2500")
def s2(spark, d):
    return _line_columns(text.load_logs(spark, _text_folder(spark, d), nrows=2500))


@query("s3_feature_table_roundtrip",
       f"SELECT event_id, node, is_anomaly, {ts_sql()} AS ts, CAST(severity_score AS FLOAT)::DOUBLE AS severity, "
       "CAST(anomaly_score AS FLOAT)::DOUBLE AS score FROM logs")
def s3(spark, d):
    path = scratch_path(spark, "features")
    base = log_table(spark, d)
    cols = base.select("event_id", "timestamp", "node", "is_anomaly", *S.as_features(base, ["severity_score", "anomaly_score"]))
    tables.save_table(cols, path, by_date="timestamp")
    back = tables.load_table(spark, path)
    return back.select("event_id", "node", "is_anomaly", ts_text().alias("ts"), F.col("severity_score").cast("double").alias("severity"),
                       F.col("anomaly_score").cast("double").alias("score"))


@query("s4_prediction_sink",
       f"SELECT {ts_sql()} AS ts, node, is_anomaly, round(anomaly_score, 6) AS anomaly_score, is_predicted_anomaly, severidad FROM logs")
def s4(spark, d):
    path = scratch_path(spark, "predictions")
    cols = ["timestamp", "node", "is_anomaly", "anomaly_score", "is_predicted_anomaly", "severidad"]
    tables.save_table(log_table(spark, d).select(*cols), path)
    back = tables.load_table(spark, path)
    return back.select(ts_text().alias("ts"), "node", "is_anomaly", F.round("anomaly_score", 6).alias("anomaly_score"),
                       "is_predicted_anomaly", "severidad")


@query("s5_schema_only_read",
       "SELECT * FROM (VALUES (0, 'event_id'), (1, 'ts'), (2, 'user_id'), (3, 'event_type'), (4, 'value'), (5, 'props')) t(pos, name) "
       "WHERE name NOT IN ('ts')", logs=False)
def s5(spark, d):
    names = tables.feature_schema(spark, f"{d}/events.parquet", skip=())
    rows = [(i, n) for i, n in enumerate(names) if n in tables.feature_schema(spark, f"{d}/events.parquet", skip=("ts",))]
    return spark.createDataFrame(rows, "pos int, name string")


@query("s6_request_rows", f"""
SELECT CAST(event_id // 50 AS VARCHAR) AS request_id, event_id, {ts_sql()} AS ts, node,
       CASE WHEN level = 'DEBUG' THEN 'INFO' ELSE level END AS level,
       CASE WHEN event_id % 7 = 0 THEN 'UNKNOWN' ELSE component END AS component,
       content || '#' || CAST(event_id AS VARCHAR) AS content, label,
       CASE WHEN level = 'DEBUG' THEN 0 ELSE severity_score END AS severity_score, is_anomaly,
       CAST(severity_score >= 2 AS INTEGER) AS error_flag, CAST(severity_score >= 3 AS INTEGER) AS fatal_flag,
       CASE WHEN (event_id // 50) % 2 = 0 THEN 5 ELSE 30 END AS window_minutes
FROM logs""")
def s6(spark, d):
    entry = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "node",
        F.when(F.col("level") != "DEBUG", F.col("level")).alias("level"),
        F.when(F.col("event_id") % 7 != 0, F.col("component")).alias("component"),
        F.concat("content", F.lit("#"), F.col("event_id").cast("string")).alias("content"),
        F.when(F.col("label") != "-", F.col("label")).alias("label"),
    )
    group = F.floor(F.col("event_id") / 50).cast("long")
    docs = log_table(spark, d).groupBy(group.alias("g")).agg(F.collect_list(entry).alias("logs")).select(
        F.to_json(F.struct(F.col("g").cast("string").alias("request_id"), "logs",
                           F.when(F.col("g") % 2 == 1, 30).alias("window_minutes"))).alias("value"))
    path = scratch_path(spark, "requests")
    docs.write.text(path)
    rows = requests.explode_requests(requests.read_requests(spark, path))
    return rows.select(
        "request_id", F.element_at(F.split("content", "#"), -1).cast("long").alias("event_id"), ts_text().alias("ts"), "node",
        "level", "component", "content", "label", F.col("severity_score").cast("long").alias("severity_score"), "is_anomaly",
        F.col("error_flag").cast("int").alias("error_flag"), F.col("fatal_flag").cast("int").alias("fatal_flag"), "window_minutes")


def embedding_columns(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """The embeddings as one double column per dimension."""
    base = read_table(spark, d, "embeddings")
    names = [f"e{i:02d}" for i in range(64)]
    return base.select(F.col("vec_id").alias("event_id"), "label",
                       *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


@query("s7_model_roundtrip", "SELECT vec_id AS event_id, TRUE AS same_score, TRUE AS same_flag FROM embeddings", logs=False)
def s7(spark, d):
    rows, names = embedding_columns(spark, d)
    model = AnomalyDetector("isolation_forest", contamination=0.05).fit(rows, names)
    path = scratch_path(spark, "model")
    model.save(path)
    again = AnomalyDetector.load(spark, path)
    both = again.predict(model.predict(rows).withColumnsRenamed({"anomaly_score": "s", "is_predicted_anomaly": "p"}))
    return both.select("event_id", (F.col("s") == F.col("anomaly_score")).alias("same_score"),
                       (F.col("p") == F.col("is_predicted_anomaly")).alias("same_flag"))


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events file as a stream, seen as the log table."""
    schema = read_table(spark, d, "events").schema
    raw = stream.event_stream(spark, f"{d}/events*.parquet", schema)
    return stream_log_view(raw)


def stream_log_view(raw: DataFrame) -> DataFrame:
    from emberlog.plans.logview import log_columns

    return raw.select(*log_columns()).withColumn("severity_score", S.severity_score(F.col("level")))


@query("s8_event_stream", f"SELECT event_id, {ts_sql()} AS ts, node, level, component, content, is_anomaly FROM logs")
def s8(spark, d):
    out = live.run_available(event_stream(spark, d), "append", "events")
    return out.select("event_id", ts_text().alias("ts"), "node", "level", "component", "content", "is_anomaly")


@query("s9_drift_history", """
SELECT 1 AS run, 0.0::DOUBLE AS drift_score, 0 AS n_features_drifted, 'none' AS features_drifted
UNION ALL SELECT 2, 0.5::DOUBLE, 1, 'anomaly_score'""")
def s9(spark, d):
    logs = log_table(spark, d).select("event_id", "anomaly_score", F.col("severity_score").cast("double").alias("severity_score"))
    path = scratch_path(spark, "drift-history")
    odd = F.col("event_id") % 2 == 1
    for run, shift in ((1, 0.0), (2, 0.5)):
        rows = logs.withColumn("anomaly_score", F.col("anomaly_score") + F.when(odd, shift).otherwise(0.0))
        report = drift.drift_report(drift.ks_per_feature(rows, ["anomaly_score", "severity_score"], odd))
        tables.append_drift_run(report, path, F.lit(run))
    return tables.load_table(spark, path).select(F.col("run_ts").alias("run"), "drift_score", "n_features_drifted", "features_drifted")


@query("s10_label_fallback", "SELECT event_id, CAST(is_anomaly AS INTEGER) AS llm_label, 'ground_truth' AS source FROM logs")
def s10(spark, d):
    labels, source = tables.labels_or_truth(spark, f"{d}/no_such_labels.parquet", log_table(spark, d))
    return labels.select("event_id", "llm_label", F.lit(source).alias("source"))


@query("s10_stored_labels", "SELECT event_id, CAST(severity_score >= 3 AS INTEGER) AS llm_label, 'llm' AS source FROM logs WHERE severity_score > 0")
def s10_stored(spark, d):
    """The branch with stored labels: those that a job before has written."""
    logs = log_table(spark, d)
    path = scratch_path(spark, "llm-labels")
    tables.save_table(logs.where("severity_score > 0").select("event_id", (F.col("severity_score") >= 3).cast("int").alias("llm_label")), path)
    labels, source = tables.labels_or_truth(spark, path, logs)
    return labels.select("event_id", "llm_label", F.lit(source).alias("source"))


# ---------------------------------------------------------------- scalar functions


@query("p1_label_flag", "SELECT event_id, label, is_anomaly FROM logs")
def p1(spark, d):
    return log_table(spark, d).select("event_id", "label", S.label_flag(F.col("label")).alias("is_anomaly"))


@query("p2_timestamp_parse", f"""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE {ts_sql()} END AS ts FROM logs""")
def p2(spark, d):
    raw = F.when(F.col("event_id") % 5 == 0, F.lit("not-a-time")).otherwise(F.date_format("timestamp", S.TIMESTAMP_PATTERN))
    return log_table(spark, d).select("event_id", ts_text(S.parse_timestamp(raw)).alias("ts"))


@query("p3_date_fallback", f"""
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL
  WHEN event_id % 5 = 0 THEN {ts_sql("date_trunc('day', timestamp)::TIMESTAMP")} ELSE {ts_sql()} END AS ts FROM logs""")
def p3(spark, d):
    e = F.col("event_id")
    raw = F.when(e % 5 == 0, F.lit("not-a-time")).otherwise(F.date_format("timestamp", S.TIMESTAMP_PATTERN))
    day = F.when(e % 10 == 0, F.lit("bad")).otherwise(F.date_format("timestamp", S.DATE_PATTERN))
    return log_table(spark, d).select("event_id", ts_text(S.parse_timestamp(raw, day)).alias("ts"))


@query("p4_safe_cast", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id * 10 END AS n FROM logs")
def p4(spark, d):
    raw = F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise((F.col("event_id") * 10).cast("string"))
    return log_table(spark, d).select("event_id", S.safe_long(raw).alias("n"))


@query("p5_category_codes", """
WITH c AS (SELECT component, dense_rank() OVER (ORDER BY component) - 1 AS code FROM (SELECT DISTINCT component FROM logs))
SELECT event_id, component, CAST(code AS BIGINT) AS code FROM logs JOIN c USING (component)""")
def p5(spark, d):
    from pyspark.ml.feature import StringIndexer

    logs = log_table(spark, d).select("event_id", "component")
    model = StringIndexer(inputCol="component", outputCol="code", stringOrderType="alphabetAsc", handleInvalid="keep").fit(logs)
    return model.transform(logs).select("event_id", "component", F.col("code").cast("long").alias("code"))


@query("p6_drop_columns", "SELECT event_id, node, level FROM logs")
def p6(spark, d):
    keep = {"event_id", "node", "level"}
    logs = log_table(spark, d)
    return logs.drop(*[c for c in logs.columns if c not in keep])


@query("p7_severity_score", "SELECT event_id, level, severity_score FROM logs")
def p7(spark, d):
    return log_table(spark, d).select("event_id", "level", S.severity_score(F.col("level")).cast("long").alias("severity_score"))


@query("p8_severity_flags", """SELECT event_id, CAST(severity_score >= 2 AS INTEGER) AS is_error,
CAST(severity_score = 1 AS INTEGER) AS is_warning, CAST(severity_score >= 3 AS INTEGER) AS is_fatal FROM logs""")
def p8(spark, d):
    sev = F.col("severity_score")
    return log_table(spark, d).select("event_id", S.is_error(sev).cast("int").alias("is_error"),
                                      S.is_warning(sev).cast("int").alias("is_warning"), S.is_fatal(sev).cast("int").alias("is_fatal"))


FRAME = "OVER (ORDER BY timestamp RANGE BETWEEN INTERVAL '{w} minutes' PRECEDING AND CURRENT ROW)"


@query("p9_guarded_ratios", f"""
SELECT event_id, round(sum(CAST(severity_score >= 2 AS INTEGER)) {FRAME.format(w=5)} / nullif(count(*) {FRAME.format(w=5)}, 0)::DOUBLE, 6) AS error_rate_5min,
       round(sum(CAST(severity_score >= 3 AS INTEGER)) {FRAME.format(w=5)} / nullif(count(*) {FRAME.format(w=5)}, 0)::DOUBLE, 6) AS fatal_rate_5min
FROM logs""")
def p9(spark, d):
    return add_rolling_features(log_table(spark, d)).select(
        "event_id", F.round("error_rate_5min", 6).alias("error_rate_5min"), F.round("fatal_rate_5min", 6).alias("fatal_rate_5min"))


@query("p10_burst_flag", f"""
SELECT event_id, CAST(count(*) {FRAME.format(w=1)} > count(*) {FRAME.format(w=15)} / 15.0 * 2 AS INTEGER) AS burst_flag FROM logs""")
def p10(spark, d):
    return add_rolling_features(log_table(spark, d)).select("event_id", F.col("burst_flag").cast("int").alias("burst_flag"))


@query("p11_null_fill", """SELECT event_id, CAST(CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE anomaly_score END AS FLOAT) AS DOUBLE) AS score FROM logs""")
def p11(spark, d):
    holes = log_table(spark, d).withColumn("score", F.when(F.col("event_id") % 4 != 0, F.col("anomaly_score")))
    return holes.select("event_id", *S.as_features(holes, ["score"])).withColumn("score", F.col("score").cast("double"))


@query("p12_feature_columns", "SELECT event_id, round(anomaly_score, 6) AS anomaly_score, is_predicted_anomaly, severidad FROM logs")
def p12(spark, d):
    logs = log_table(spark, d)
    return logs.select(*S.feature_columns(logs.columns)).withColumn("anomaly_score", F.round("anomaly_score", 6))


@query("p13_component_flags", """SELECT event_id, CAST(component = 'CLICK' AS INTEGER) AS comp_click,
CAST(component = 'ERROR' AS INTEGER) AS comp_error, CAST(component = 'PURCHASE' AS INTEGER) AS comp_purchase,
CAST(component = 'SIGNUP' AS INTEGER) AS comp_signup, CAST(component = 'VIEW' AS INTEGER) AS comp_view FROM logs""")
def p13(spark, d):
    logs = log_table(spark, d).select("event_id", "component")
    flagged = add_component_flags(logs, top_components(logs))
    return flagged.select("event_id", *[F.col(c).cast("int").alias(c) for c in sorted(flagged.columns) if c.startswith("comp_")])


@query("p14_safe_names", """SELECT DISTINCT component, 'comp_' || lower(replace(replace(component || ' unit-A', ' ', '_'), '-', '_')) AS name FROM logs""")
def p14(spark, d):
    names = log_table(spark, d).select("component").distinct()
    return names.select("component", S.safe_name_of(F.concat("component", F.lit(" unit-A"))).alias("name"))


@query("p15_schema_alignment", """SELECT event_id, 0.0::DOUBLE AS not_trained_here, CAST(CAST(anomaly_score AS FLOAT) AS DOUBLE) AS anomaly_score,
CAST(severity_score AS DOUBLE) AS severity_score FROM logs""")
def p15(spark, d):
    out = S.align(log_table(spark, d), ["not_trained_here", "anomaly_score", "severity_score"], ["event_id"])
    return out.select("event_id", *[F.col(c).cast("double").alias(c) for c in out.columns[1:]])


@query("p16_weak_label_encode", """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL WHEN severidad IN ('CRITICAL', 'HIGH') THEN 1 ELSE 0 END AS llm_label FROM logs""")
def p16(spark, d):
    sev = F.when(F.col("event_id") % 6 == 0, F.lit("UNKNOWN")).otherwise(F.col("severidad"))
    return log_table(spark, d).select("event_id", S.weak_label(sev).alias("llm_label"))


@query("p17_severity_scales", """
WITH r AS (SELECT event_id, anomaly_score s, severidad, (rank() OVER (ORDER BY anomaly_score) + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0) / count(*) OVER () AS pct FROM logs)
SELECT event_id, CASE WHEN s >= 0.85 THEN 'CRITICAL' WHEN s >= 0.70 THEN 'HIGH' WHEN s >= 0.55 THEN 'MEDIUM' ELSE 'LOW' END AS stream_scale,
  severidad AS alert_scale,
  CASE WHEN pct >= 0.95 THEN 'CRITICAL' WHEN pct >= 0.80 THEN 'HIGH' WHEN pct >= 0.50 THEN 'MEDIUM' ELSE 'LOW' END AS percentile_scale FROM r""")
def p17(spark, d):
    from emberlog.operators.ranking import percent_rank_average

    s = F.col("anomaly_score")
    return percent_rank_average(log_table(spark, d), "anomaly_score").select(
        "event_id", S.ladder(s, S.STREAM_SCALE).alias("stream_scale"), S.ladder(s, S.ALERT_SCALE).alias("alert_scale"),
        S.ladder(F.col("pct"), S.PERCENTILE_SCALE).alias("percentile_scale"))


@query("p18_min_max_scale", """SELECT event_id, round((s - min(s) OVER ()) / (max(s) OVER () - min(s) OVER () + 1e-9), 6) AS scaled
FROM (SELECT event_id, anomaly_score AS s FROM logs)""")
def p18(spark, d):
    logs = log_table(spark, d).select("event_id", "anomaly_score")
    return S.min_max_scale(logs, "anomaly_score", "scaled").select("event_id", F.round("scaled", 6).alias("scaled"))


@query("p19_hour_weekday", "SELECT event_id, CAST(hour(timestamp) AS INTEGER) AS hour, dayname(timestamp) AS weekday FROM logs")
def p19(spark, d):
    ts = F.col("timestamp")
    return log_table(spark, d).select("event_id", S.hour_of_day(ts).alias("hour"), S.weekday_name(ts).alias("weekday"))


CONTEXT_COLUMNS = ["anomaly_id", "node", "timestamp", "total_events", "error_count", "error_rate", "warning_count", "fatal_count",
                   "components", "avg_severity", "sample_messages", "anomaly_score"]
CONTEXT_OF = f"""WITH inc AS (SELECT event_id AS anomaly_id, timestamp AS t, node, anomaly_score FROM logs {{which}}),
pairs AS (SELECT i.anomaly_id, e.* FROM inc i JOIN logs e ON e.timestamp BETWEEN i.t - INTERVAL '5 minutes' AND i.t + INTERVAL '5 minutes'),
tot AS (SELECT anomaly_id, count(*) AS n, sum(CAST(severity_score >= 2 AS INTEGER)) AS e, sum(CAST(severity_score = 1 AS INTEGER)) AS w,
        sum(CAST(severity_score >= 3 AS INTEGER)) AS f, avg(severity_score) AS s FROM pairs GROUP BY 1),
comp AS (SELECT anomaly_id, string_agg(component, ', ' ORDER BY n DESC, component) AS components FROM (
         SELECT anomaly_id, component, count(*) AS n, row_number() OVER (PARTITION BY anomaly_id ORDER BY count(*) DESC, component) AS rn
         FROM pairs GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1),
msg AS (SELECT anomaly_id, string_agg('  - ' || content, chr(10) ORDER BY rn) AS messages FROM (
        SELECT anomaly_id, content, row_number() OVER (PARTITION BY anomaly_id ORDER BY timestamp, event_id) AS rn FROM pairs WHERE content IS NOT NULL)
        WHERE rn <= 5 GROUP BY 1),
ctx AS (SELECT i.anomaly_id, i.node, regexp_replace({ts_sql('i.t')}, '[.]0+$', '') AS timestamp, CAST(n AS BIGINT) AS total_events, CAST(e AS BIGINT) AS error_count,
        printf('%.1f%%', (e / n) * 100.0) AS error_rate, CAST(w AS BIGINT) AS warning_count, CAST(f AS BIGINT) AS fatal_count,
        components, CAST(printf('%.2f', s) AS DOUBLE) AS avg_severity, messages AS sample_messages, anomaly_score
        FROM inc i JOIN tot USING (anomaly_id) JOIN comp USING (anomaly_id) JOIN msg USING (anomaly_id))
"""
CONTEXT_SQL = CONTEXT_OF.format(which="WHERE is_anomaly")


def contexts(spark: SparkSession, d: str) -> DataFrame:
    """Context rows of all true anomalies, over the whole log."""
    logs = log_table(spark, d)
    inc = logs.where("is_anomaly").select(F.col("event_id").alias("anomaly_id"), "timestamp", "node", "anomaly_score")
    return build_contexts(inc, logs)


_PROMPT_SQL = "printf('" + PROMPT.replace("'", "''") + "', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in PROMPT_FIELDS) + ", printf('%.4f', anomaly_score))"


@query("p21_prompt", CONTEXT_SQL + f"SELECT anomaly_id, {_PROMPT_SQL} AS prompt FROM ctx")
def p21(spark, d):
    return contexts(spark, d).select("anomaly_id", render_prompt(F.col("anomaly_score")).alias("prompt"))


def answer_texts(logs: DataFrame) -> DataFrame:
    """Model answers of six shapes, rendered from the log."""
    e = F.col("event_id")
    body = F.concat(F.lit('{"resumen": "nodo '), F.col("node"), F.lit(' \\"x\\"", "severidad": "'), F.col("severidad"),
                    F.lit('", "causa_probable": "'), F.col("component"), F.lit('", "accion_recomendada": "revisar"}'))
    cut = F.concat(F.lit('{"resumen": "nodo '), F.col("node"), F.lit('", "severidad": "'), F.col("severidad"), F.lit('", "causa_probable": "no cerra'))
    shaped = (
        F.when(e % 6 == 0, body)
        .when(e % 6 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(e % 6 == 2, F.concat(F.lit("Claro:\n"), body, F.lit("\nSaludos")))
        .when(e % 6 == 3, cut)
        .when(e % 6 == 4, F.concat(F.lit("  sin formato "), F.col("node"), F.lit("  ")))
        .otherwise(F.lit('{"severidad": "LOW"}'))
    )
    return logs.select("event_id", shaped.alias("response"))


@query("p22_answer_parse", """
SELECT event_id,
 CASE event_id % 6 WHEN 3 THEN 'nodo ' || node WHEN 4 THEN 'sin formato ' || node WHEN 5 THEN '' ELSE 'nodo ' || node || ' "x"' END AS resumen,
 CASE event_id % 6 WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'LOW' ELSE severidad END AS severidad,
 CASE event_id % 6 WHEN 3 THEN 'N/A' WHEN 4 THEN 'Could not parse LLM response' WHEN 5 THEN '' ELSE component END AS causa_probable,
 CASE event_id % 6 WHEN 3 THEN 'N/A' WHEN 4 THEN 'Review logs manually' WHEN 5 THEN '' ELSE 'revisar' END AS accion_recomendada
FROM logs""")
def p22(spark, d):
    return parse_answers(answer_texts(log_table(spark, d))).drop("response")


@query("p23_formats", """SELECT event_id, printf('%.1f%%', 100.0 * (severity_score / 8)) AS share, CAST(printf('%.4f', anomaly_score) AS DOUBLE) AS score4,
CAST(printf('%.2f', anomaly_score) AS DOUBLE) AS score2 FROM logs""")
def p23(spark, d):
    return log_table(spark, d).select("event_id", S.percent_text(F.col("severity_score") / 8).alias("share"),
                                      S.round_binary(F.col("anomaly_score"), 4).alias("score4"), S.round_binary(F.col("anomaly_score"), 2).alias("score2"))


@query("p24_incident_id", "SELECT event_id, 'AN-' || upper(substr(sha256(CAST(event_id AS VARCHAR) || '|' || node), 1, 8)) AS anomaly_id FROM logs")
def p24(spark, d):
    return log_table(spark, d).select("event_id", S.incident_id(F.col("event_id"), F.col("node")).alias("anomaly_id"))


@query("p25_export_row", """SELECT event_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, node, level, component, content, is_anomaly,
CAST(printf('%.4f', anomaly_score) AS DOUBLE) AS anomaly_score FROM logs""")
def p25(spark, d):
    return S.export_row(log_table(spark, d)).select("event_id", "timestamp", "node", "level", "component", "content", "is_anomaly", "anomaly_score")


@query("p26_tickets", """SELECT 'INC' || upper(substr(sha256(CAST(event_id AS VARCHAR) || '|ticket'), 1, 8)) AS ticket_id, severidad AS severity, node,
substr(repeat(content || ' ', 20), 1, 120) AS summary, strftime(timestamp, '%Y-%m-%d %H:%M') || ' UTC' AS created, 'OPEN' AS status,
CASE WHEN severidad IN ('HIGH', 'CRITICAL') THEN 'NOC-Team-1' ELSE 'NOC-Team-2' END AS assignee FROM logs WHERE is_predicted_anomaly""")
def p26(spark, d):
    inc = log_table(spark, d).where("is_predicted_anomaly").withColumn("anomaly_id", F.col("event_id"))
    inc = inc.withColumn("resumen", F.repeat(F.concat("content", F.lit(" ")), 20))
    return tickets(inc, created=F.col("timestamp"))


@query("p27_context_prefix", f"""SELECT event_id, '[Contexto — nodo: ' || CASE WHEN event_id % 3 = 0 THEN 'N/A' ELSE node END || ', score: ' || printf('%.3f', anomaly_score)
 || ', timestamp: ' || {ts_sql()} || ']' || chr(10) || chr(10) || content AS message FROM logs""")
def p27(spark, d):
    node = F.when(F.col("event_id") % 3 != 0, F.col("node"))
    return log_table(spark, d).select(
        "event_id", S.context_prefix(node, F.col("anomaly_score"), ts_text(), F.col("content")).alias("message"))


@query("p28_display_labels", """SELECT event_id, CASE WHEN is_anomaly THEN '🔴 Anomalía' ELSE '🟢 Normal' END AS tipo,
CASE severidad WHEN 'LOW' THEN '🟢 LOW' WHEN 'MEDIUM' THEN '🟡 MEDIUM' WHEN 'HIGH' THEN '🟠 HIGH' ELSE '🔴 CRITICAL' END AS severidad FROM logs""")
def p28(spark, d):
    return log_table(spark, d).select("event_id", S.type_label(F.col("is_anomaly")).alias("tipo"),
                                      S.severity_display(F.col("severidad")).alias("severidad"))


# ---------------------------------------------------------------- filters


@query("f1_time_range", "SELECT event_id FROM logs WHERE timestamp >= TIMESTAMP '2024-01-05 06:00:00' AND timestamp <= TIMESTAMP '2024-01-20 18:30:00'")
def f1(spark, d):
    return filters.in_time_range(log_table(spark, d), "2024-01-05 06:00:00", "2024-01-20 18:30:00").select("event_id")


@query("f2_line_validity", "SELECT event_id FROM logs WHERE event_id % 4 IN (0, 3)")
def f2(spark, d):
    e = F.col("event_id")
    lines = _render_lines(log_table(spark, d)).withColumn(
        "value",
        F.when(e % 4 == 1, F.lit("   ")).when(e % 4 == 2, F.array_join(F.slice(F.split("value", " "), 1, 8), " "))
        .when(e % 4 == 3, F.concat(F.lit("  "), F.array_join(F.slice(F.split("value", " "), 1, 9), " "))).otherwise(F.col("value")))
    return lines.where(text.valid_line(F.col("value"))).select("event_id")


@query("f3_alert_filter", "SELECT event_id, severidad FROM logs WHERE is_predicted_anomaly AND anomaly_score >= 0.3 AND severidad IN ('MEDIUM', 'CRITICAL')")
def f3(spark, d):
    return filters.alerts(log_table(spark, d), 0.3, ["MEDIUM", "CRITICAL"]).select("event_id", "severidad")


@query("f4_node_contains", "SELECT event_id, node FROM logs WHERE regexp_matches(node, 'r1[0-3]-m', 'i')")
def f4(spark, d):
    return log_table(spark, d).where(filters.node_matches(F.col("node"), "r1[0-3]-m")).select("event_id", "node")


@query("f5_lookup_by_id", f"SELECT event_id, 'AN-' || event_id AS anomaly_id, {ts_sql()} AS ts, node FROM logs WHERE event_id = 777")
def f5(spark, d):
    hist = log_table(spark, d).withColumn("anomaly_id", F.concat(F.lit("AN-"), F.col("event_id").cast("string")))
    return filters.by_id(hist, "AN-777").select("event_id", "anomaly_id", ts_text().alias("ts"), "node")


@query("f6_drop_null_labels", "SELECT event_id, CASE WHEN severidad IN ('CRITICAL', 'HIGH') THEN 1 ELSE 0 END AS llm_label FROM logs WHERE event_id % 6 <> 0")
def f6(spark, d):
    sev = F.when(F.col("event_id") % 6 == 0, F.lit("UNKNOWN")).otherwise(F.col("severidad"))
    return filters.with_labels_only(log_table(spark, d).select("event_id", S.weak_label(sev).alias("llm_label")))


@query("f7_error_slices", """SELECT event_id, CASE WHEN is_anomaly AND is_predicted_anomaly THEN 'TP' WHEN is_predicted_anomaly THEN 'FP' ELSE 'FN' END AS cell
FROM logs WHERE is_anomaly OR is_predicted_anomaly""")
def f7(spark, d):
    logs = log_table(spark, d)
    parts = [filters.error_slice(logs, k).select("event_id", F.lit(k).alias("cell")) for k in ("TP", "FP", "FN")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f8_drop_null_text", "SELECT node, CAST(count(*) AS BIGINT) AS n FROM logs WHERE event_id % 5 <> 0 GROUP BY node")
def f8(spark, d):
    return log_table(spark, d).groupBy("node").agg(F.count(F.when(F.col("event_id") % 5 != 0, F.col("content"))).alias("n"))


@query("f9_minimum_samples", "SELECT CAST(count(*) AS BIGINT) AS n FROM logs WHERE is_anomaly")
def f9(spark, d):
    n = filters.require_rows(log_table(spark, d).where("is_anomaly"), 10)
    return spark.createDataFrame([(n,)], "n long")

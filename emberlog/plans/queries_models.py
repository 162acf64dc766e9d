"""Queries: detectors, classifier, labels, jobs, streams, answers."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.functions.responses import NO_CLIENT, parse_answers
from emberlog.operators import incidents as I
from emberlog.operators import ranking as R
from emberlog.operators.classifier import WeakLabelClassifier
from emberlog.operators.detector import MODEL_TYPES, AnomalyDetector, contamination_threshold
from emberlog.operators.evaluation import compare_models, evaluate
from emberlog.operators.features import fit_features
from emberlog.operators.split import temporal_split
from emberlog.plans import jobs
from emberlog.plans.queries_scan import CONTEXT_COLUMNS, CONTEXT_OF, answer_texts, embedding_columns, event_stream
from emberlog.plans.queries_tables import KS_SQL, REPORT_SQL, TRAIN_SQL, ks_rows, whole_report
from emberlog.plans.registry import log_table, query, ts_sql, ts_text
from emberlog.session import materialize
from emberlog.streaming import live

# ---------------------------------------------------------------- detectors


def _scored(detector, rows, names):
    out = detector.fit(rows, names).predict(rows)
    return out.select("event_id", "anomaly_score", "is_predicted_anomaly")


@query("m3_isolation_forest")
def m3(spark, d):
    rows, names = embedding_columns(spark, d)
    return _scored(AnomalyDetector("isolation_forest", contamination=0.05), rows, names)


@query("m3_forest_summary", """SELECT count(*) AS n_rows, count(*) - 1 - CAST(floor((count(*) - 1) * 0.95) AS BIGINT) AS n_flagged, TRUE AS in_range,
TRUE AS flags_are_the_highest FROM embeddings""", logs=False)
def m3_summary(spark, d):
    """The quantile rule over all rows: how many are flagged, and that they score highest."""
    rows, names = embedding_columns(spark, d)
    scored = _scored(AnomalyDetector("isolation_forest", contamination=0.05), rows, names)
    score, flag = F.col("anomaly_score"), F.col("is_predicted_anomaly")
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_if(flag).alias("n_flagged"), F.min((score > 0) & (score <= 1)).alias("in_range"),
        (F.min(F.when(flag, score)) > F.max(F.when(~flag, score))).alias("flags_are_the_highest"))


LOF_SQL = """WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
tr AS (SELECT * FROM e {train}),
dt AS (SELECT a.id, b.id AS nb, list_distance(a.v, b.v) AS dist FROM tr a JOIN tr b ON a.id <> b.id),
nt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nb) AS rk FROM dt) WHERE rk <= 20),
kd AS (SELECT id, max(dist) AS kdist FROM nt GROUP BY id),
lr AS (SELECT nt.id, 1.0 / (avg(greatest(nt.dist, kd.kdist)) + 1e-10) AS lrd FROM nt JOIN kd ON kd.id = nt.nb GROUP BY nt.id),
sc AS (SELECT nt.id, avg(n.lrd) / any_value(m.lrd) AS lof FROM nt JOIN lr n ON n.id = nt.nb JOIN lr m ON m.id = nt.id GROUP BY nt.id),
th AS (SELECT quantile_cont(lof, 0.95) AS t FROM sc),
dq AS (SELECT a.id, b.id AS nb, list_distance(a.v, b.v) AS dist FROM e a JOIN tr b ON true {asked}),
nq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nb) AS rk FROM dq) WHERE rk <= 20),
lq AS (SELECT nq.id, 1.0 / (avg(greatest(nq.dist, kd.kdist)) + 1e-10) AS lrd FROM nq JOIN kd ON kd.id = nq.nb GROUP BY nq.id),
fq AS (SELECT nq.id, avg(lr.lrd) / any_value(lq.lrd) AS lof FROM nq JOIN lr ON lr.id = nq.nb JOIN lq ON lq.id = nq.id GROUP BY nq.id)
SELECT id AS event_id, round(lof, 5) AS anomaly_score, lof > t AS is_predicted_anomaly FROM fq, th"""


@query("m4_local_outlier_factor", LOF_SQL.format(train="WHERE label < 8", asked="WHERE a.label >= 8"), logs=False)
def m4(spark, d):
    rows, names = embedding_columns(spark, d)
    model = AnomalyDetector("lof", contamination=0.05, n_neighbors=20).fit(rows.where("label < 8"), names)
    out = model.predict(rows.where("label >= 8"))
    return out.select("event_id", F.round("anomaly_score", 5).alias("anomaly_score"), "is_predicted_anomaly")


@query("p20_orientation", f"SELECT event_id, CAST(is_predicted_anomaly AS INTEGER) AS pred, anomaly_score AS score FROM ({LOF_SQL.format(train='', asked='')})", logs=False)
def p20(spark, d):
    """The unified scale, through the detector: a higher score is worse, 1 is an anomaly. Rows are scored by the model of all rows."""
    rows, names = embedding_columns(spark, d)
    out = AnomalyDetector("lof", contamination=0.05, n_neighbors=20).fit(rows, names).predict(rows)
    return out.select("event_id", F.col("is_predicted_anomaly").cast("int").alias("pred"), F.round("anomaly_score", 5).alias("score"))


@query("m5_one_class_svm")
def m5(spark, d):
    rows, names = embedding_columns(spark, d)
    return _scored(AnomalyDetector("ocsvm", contamination=0.05), rows, names)


@query("m5_boundary_summary", """SELECT count(*) AS n_rows, CAST(ceil(count(*) * 0.05) AS BIGINT) AS rank_of_boundary, TRUE AS few_outside, TRUE AS enough_on_or_outside
FROM embeddings""", logs=False)
def m5_summary(spark, d):
    """The share law of the dual: at most nu of all rows lie outside the boundary, at least nu outside or on it."""
    rows, names = embedding_columns(spark, d)
    score = F.col("anomaly_score")
    scored = _scored(AnomalyDetector("ocsvm", contamination=0.05), rows, names)
    n = F.count("*")
    return scored.agg(
        n.alias("n_rows"), F.ceil(n * F.lit(0.05)).alias("rank_of_boundary"),
        (F.count_if(score > 1e-12) <= n * 0.05).alias("few_outside"), (F.count_if(score >= -1e-12) >= n * 0.05).alias("enough_on_or_outside"))


@query("m6_contamination_threshold", """WITH t AS (SELECT quantile_cont(anomaly_score, 0.98) AS t FROM logs)
SELECT event_id, round(t, 6) AS threshold, anomaly_score > t AS is_predicted_anomaly FROM logs, t""")
def m6(spark, d):
    logs = log_table(spark, d).select("event_id", "anomaly_score")
    t = contamination_threshold(logs, 0.02)
    return logs.select("event_id", F.round(F.lit(t), 6).alias("threshold"), (F.col("anomaly_score") > t).alias("is_predicted_anomaly"))


@query("m7_unified_detectors")
def m7(spark, d):
    rows, names = embedding_columns(spark, d)
    parts = [_scored(AnomalyDetector(m, contamination=0.05), rows, names).withColumn("model", F.lit(m)) for m in MODEL_TYPES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def plain_features(spark, d):
    """Numeric columns of the log itself, for the model jobs."""
    logs = log_table(spark, d)
    return logs.select(
        "timestamp", "node", "is_anomaly", "event_id", F.col("severity_score").cast("float").alias("severity"),
        F.col("anomaly_score").cast("float").alias("load"), F.hour("timestamp").cast("float").alias("hour"),
        F.length("content").cast("float").alias("text_length"),
    )


@query("m8_boosted_classifier", "SELECT event_id, is_anomaly AS is_predicted_anomaly, is_anomaly AS score_over_half FROM logs")
def m8(spark, d):
    rows = materialize(plain_features(spark, d).withColumn("llm_label", F.col("is_anomaly").cast("int")), "classifier-rows")
    learner = WeakLabelClassifier().fit(rows, ["severity", "load", "hour", "text_length"])
    return learner.predict(rows).select("event_id", "is_predicted_anomaly", (F.col("anomaly_score") > 0.5).alias("score_over_half"))


@query("m9_feature_importance", """SELECT feature, feature = 'severity' AS is_largest, (SELECT count(*) FROM logs) AS n_rows
FROM (VALUES ('severity'), ('load'), ('hour'), ('text_length')) AS f(feature)""", logs=True)
def m9(spark, d):
    rows = materialize(plain_features(spark, d).withColumn("llm_label", F.col("is_anomaly").cast("int")), "classifier-rows")
    learner = WeakLabelClassifier().fit(rows, ["severity", "load", "hour", "text_length"])
    ranked = learner.feature_importance(spark)
    largest = ranked.agg(F.max("importance")).scalar()
    return ranked.select("feature", (F.col("importance") == largest).alias("is_largest"), rows.agg(F.count("*")).scalar().alias("n_rows"))


def rule_client():
    """A stand-in for a model: severity read off the prompt's own counts."""

    def answer(prompt: str) -> str:
        lines = dict(line[2:].split(": ", 1) for line in prompt.splitlines() if line.startswith("- ") and ": " in line)
        fatal, errors = int(lines["Fatales"]), int(lines["Errores"].split(" ")[0])
        if fatal == 0 and errors == 0:
            raise RuntimeError("nothing to say")
        severity = "CRITICAL" if fatal else "MEDIUM"
        body = json.dumps({"resumen": f"{errors} errores", "severidad": severity, "causa_probable": "c", "accion_recomendada": "a"})
        return f"```json\n{body}\n```" if fatal else f"Respuesta: {body}"

    return answer


TOP300 = CONTEXT_OF.format(which="WHERE is_predicted_anomaly ORDER BY logs.anomaly_score DESC, event_id LIMIT 300")


@query("m10_weak_labels", TOP300 + f""", lab AS (SELECT anomaly_id, node, timestamp, CASE WHEN fatal_count > 0 THEN 'CRITICAL' WHEN error_count > 0 THEN 'MEDIUM' ELSE 'UNKNOWN' END AS severidad FROM ctx)
SELECT timestamp AS ts, node, severidad, CASE WHEN severidad = 'CRITICAL' THEN 1 ELSE 0 END AS llm_label FROM lab WHERE severidad <> 'UNKNOWN'""")
def m10(spark, d):
    logs = log_table(spark, d)
    return I.weak_labels(logs.drop("severidad"), logs, lambda: rule_client()).select(ts_text().alias("ts"), "node", "severidad", "llm_label")


@query("m10_truth_labels", f"SELECT {ts_sql()} AS ts, node, CASE WHEN is_anomaly THEN 'CRITICAL' ELSE 'LOW' END AS severidad, CAST(is_anomaly AS INTEGER) AS llm_label FROM logs")
def m10_truth(spark, d):
    logs = log_table(spark, d)
    return I.weak_labels(logs, logs).select(ts_text().alias("ts"), "node", "severidad", "llm_label")


@query("m11_history_labels", f"""WITH r AS (SELECT *, (rank() OVER (ORDER BY anomaly_score) + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0) / count(*) OVER () AS pct
 FROM logs WHERE is_predicted_anomaly)
SELECT 'AN-' || upper(substr(sha256(CAST(event_id AS VARCHAR)), 1, 8)) AS anomaly_id, {ts_sql()} AS ts, node,
 CASE WHEN pct >= 0.95 THEN 'CRITICAL' WHEN pct >= 0.80 THEN 'HIGH' WHEN pct >= 0.50 THEN 'MEDIUM' ELSE 'LOW' END AS severidad, 1 AS llm_label FROM r""")
def m11(spark, d):
    return I.history_labels(log_table(spark, d).drop("severidad")).select("anomaly_id", ts_text().alias("ts"), "node", "severidad", "llm_label")


# ---------------------------------------------------------------- jobs


@query("m12_retrain_job", f"""WITH {TRAIN_SQL} SELECT 'active_learner_v1' AS model_version, 0.0::DOUBLE AS f1_before, 1.0::DOUBLE AS f1_after, count(*) AS n_samples_used,
 'ground_truth (' || count(*) || ' samples)' AS labels_source FROM pos WHERE rn <= floor(total * 0.8)""")
def m12(spark, d):
    features = materialize(plain_features(spark, d), "plain-features")
    return jobs.retrain_job(features, None, None, WeakLabelClassifier()).drop("retrain_time_ms")


@query("m12_retrain_weak_labels", f"""WITH {TRAIN_SQL}, logs_train AS (SELECT l.* FROM logs l JOIN (SELECT event_id, rn, total FROM pos) p USING (event_id) WHERE rn <= floor(total * 0.8)),
""" + TOP300.removeprefix("WITH ").replace("FROM logs WHERE is_predicted_anomaly", "FROM logs_train AS logs WHERE is_predicted_anomaly").replace("JOIN logs e ON", "JOIN logs_train e ON") + """,
lab AS (SELECT i.t, c.node FROM ctx c JOIN inc i USING (anomaly_id) WHERE error_count > 0),
s AS (SELECT count(*) AS n FROM logs_train f JOIN lab ON f.timestamp = lab.t AND f.node = lab.node)
SELECT 'active_learner_v1' AS model_version, n AS n_samples_used, 'llm (' || n || ' samples)' AS labels_source, TRUE AS scores_in_range FROM s""")
def m12_weak(spark, d):
    """Retraining on the labels that a client's answers give; without 100 of them the job refuses, so the bound is lowered here."""
    features = materialize(plain_features(spark, d), "plain-features")
    train, _ = temporal_split(features)
    logs, _ = temporal_split(log_table(spark, d).drop("severidad"))
    detector = AnomalyDetector("isolation_forest", contamination=0.05).fit(train, jobs.feature_names(features))
    labels = I.weak_labels(logs, logs, lambda: rule_client())
    out = jobs.retrain_job(features, labels, detector, WeakLabelClassifier(), min_samples=1)
    in_range = F.col("f1_before").between(0, 1) & F.col("f1_after").between(0, 1)
    return out.select("model_version", "n_samples_used", "labels_source", in_range.alias("scores_in_range"))


def _learned(spark, d):
    """Feature model learned on the first 80 % of the log, and its training rows."""
    logs = log_table(spark, d).drop("severity_score", "severidad", "anomaly_score", "is_predicted_anomaly")
    train, test = temporal_split(logs)
    features = fit_features(train)
    return features, materialize(features.transform(train, ["event_id"]), "train-features"), train, test


def _fitted(spark, d):
    """Feature model and detector learned on the first 80 % of the log."""
    features, rows, train, test = _learned(spark, d)
    detector = AnomalyDetector("isolation_forest", contamination=0.05).fit(rows, features.columns)
    return features, detector, train, test


@query("m13_detection_job")
def m13(spark, d):
    features, detector, _, test = _fitted(spark, d)
    hits, context = jobs.detect_job(test, features, detector)
    sizes = context.groupBy("anomaly_id").agg(F.sum(F.size("entries")).alias("context_rows"))
    rate = jobs.detect_response(hits, test)
    return hits.join(sizes, "anomaly_id", "left").select(
        "anomaly_id", "event_id", "node", "anomaly_score", "context_rows", rate.select("anomaly_rate").scalar().alias("anomaly_rate"))


@query("m14_holdout_predictions")
def m14(spark, d):
    features, detector, train, test = _fitted(spark, d)
    whole = materialize(features.transform(train.unionByName(test), ["event_id"]), "all-features")
    return jobs.holdout_predictions(whole, detector).select("event_id", "node", "is_anomaly", "anomaly_score", "is_predicted_anomaly")


@query("m14_holdout_summary", f"""WITH {TRAIN_SQL} SELECT count(*) AS n_rows, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies,
0.0::DOUBLE AS lowest, 1.0::DOUBLE AS highest FROM pos WHERE rn > floor(total * 0.8)""")
def m14_summary(spark, d):
    """The stored holdout: its rows, its true anomalies, and the scale of its scores."""
    return m14(spark, d).agg(
        F.count("*").alias("n_rows"), F.count_if("is_anomaly").alias("n_anomalies"), F.round(F.min("anomaly_score"), 6).alias("lowest"),
        F.round(F.max("anomaly_score"), 6).alias("highest"))


@query("m14_detector_comparison", f"""WITH {TRAIN_SQL}, te AS (SELECT * FROM pos WHERE rn > floor(total * 0.8))
SELECT model, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_true, TRUE AS consistent FROM te, (VALUES ('isolation_forest'), ('lof'), ('ocsvm')) m(model) GROUP BY model""")
def m14_compare(spark, d):
    """All three detectors on the holdout, evaluated and ranked by F1."""
    features, rows, _, test = _learned(spark, d)
    held = materialize(features.transform(test, ["event_id"]), "test-features")
    rate = rows.agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    parts = []
    for kind in MODEL_TYPES:
        model = AnomalyDetector(kind, contamination=rate).fit(rows, features.columns)
        parts.append(model.predict(held).select("is_anomaly", "anomaly_score", "is_predicted_anomaly", F.lit(kind).alias("model")))
    ranked = compare_models(evaluate(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    p, r = F.col("precision"), F.col("recall")
    harmonic = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    consistent = (F.abs(F.col("f1") - harmonic) < 0.001) & F.col("aupr").between(0, 1)
    return ranked.select("model", "n_true", consistent.alias("consistent"))


@query("d5_drift_health", KS_SQL.format(shift="0") + REPORT_SQL)
def d5(spark, d):
    return whole_report(jobs.drift_health(ks_rows(spark, d)))


# ---------------------------------------------------------------- streams


_LIVE = "CASE WHEN NOT is_anomaly THEN 'LOW' WHEN anomaly_score >= 0.85 THEN 'CRITICAL' WHEN anomaly_score >= 0.70 THEN 'HIGH' WHEN anomaly_score >= 0.55 THEN 'MEDIUM' ELSE 'LOW' END"


@query("x1_live_scoring", f"SELECT event_id, {_LIVE} AS severity FROM logs")
def x1(spark, d):
    return live.run_available(live.score_events(event_stream(spark, d)).select("event_id", "severity"), "append", "scores")


@query("x2_running_counters", """SELECT count(*) AS n_events, count(*) FILTER (is_anomaly) AS n_anomalies, round(count(*) FILTER (is_anomaly) / greatest(count(*), 1), 6) AS rate FROM logs""")
def x2(spark, d):
    return live.run_available(live.counters(event_stream(spark, d)), "complete", "counters").withColumn("rate", F.round("rate", 6))


@query("x3_live_feed", f"SELECT event_id, {ts_sql()} AS ts, node, level, component FROM logs ORDER BY timestamp DESC, event_id DESC LIMIT 50")
def x3(spark, d):
    return live.run_feed(event_stream(spark, d)).select("event_id", ts_text().alias("ts"), "node", "level", "component")


_LATEST = f"""SELECT event_id, {ts_sql()} AS ts, node, round(anomaly_score, 6) AS anomaly_score, {_LIVE} AS severity,
(SELECT count(*) FROM logs WHERE is_anomaly) AS n_anomalies FROM logs WHERE is_anomaly ORDER BY timestamp DESC, event_id DESC LIMIT 1"""


def _latest(spark, d):
    return live.run_available(live.latest_anomaly(live.score_events(event_stream(spark, d))), "complete", "latest")


@query("x4_latest_anomaly", _LATEST)
def x4(spark, d):
    return _latest(spark, d).select("event_id", ts_text().alias("ts"), "node", F.round("anomaly_score", 6).alias("anomaly_score"), "severity", "n_anomalies")


@query("x5_injected_events", f"""SELECT event_id, {_LIVE} AS severity, FALSE AS forced FROM logs
UNION ALL SELECT -event_id - 1, 'CRITICAL', TRUE FROM logs WHERE level = 'FATAL'""")
def x5(spark, d):
    base = event_stream(spark, d).withColumn("forced", F.lit(False))
    forced = event_stream(spark, d).where("level = 'FATAL'").withColumn("event_id", -F.col("event_id") - 1)
    forced = forced.withColumn("is_anomaly", F.lit(True)).withColumn("anomaly_score", F.lit(0.92)).withColumn("forced", F.lit(True))
    merged = live.score_events(live.inject(base, forced))
    return live.run_available(merged.select("event_id", "severity", "forced"), "append", "injected")


@query("x6_canned_summary", "WITH l AS (" + _LATEST + "), s AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{s[0]}', '{s[1]}')" for i, s in enumerate(live.CANNED_SUMMARIES)) + """) v(slot, resumen, severidad))
SELECT event_id, slot, resumen, severidad FROM l JOIN s ON slot = (n_anomalies - 1) % 4""")
def x6(spark, d):
    return live.with_canned_summary(_latest(spark, d)).select("event_id", "slot", "resumen", "severidad")


@query("x7_sliding_windows", f"""WITH w AS (SELECT unnest(generate_series(0, 4)) AS k),
a AS (SELECT date_trunc('minute', timestamp)::TIMESTAMP - to_minutes(CAST(k AS INTEGER)) AS s, * FROM logs, w),
m AS (SELECT max(timestamp) AS top FROM logs)
SELECT {ts_sql('s')} AS window_start, count(*) AS total_count, CAST(sum(CAST(severity_score >= 2 AS INTEGER)) AS BIGINT) AS error_count,
 CAST(sum(CAST(severity_score = 1 AS INTEGER)) AS BIGINT) AS warning_count, CAST(sum(CAST(severity_score >= 3 AS INTEGER)) AS BIGINT) AS fatal_count,
 round(avg(severity_score), 6) AS avg_severity, count(DISTINCT node) AS unique_nodes
FROM a, m WHERE s + INTERVAL 5 MINUTE <= top - INTERVAL 10 MINUTE GROUP BY s""")
def x7(spark, d):
    out = live.run_available(live.rolling_stream(event_stream(spark, d)), "append", "rolling")
    return out.select(ts_text("window_start").alias("window_start"), "total_count", "error_count", "warning_count", "fatal_count",
                      F.round("avg_severity", 6).alias("avg_severity"), "unique_nodes")


# ---------------------------------------------------------------- answers


@query("l1_context_of_top_alerts", CONTEXT_OF.format(which="WHERE is_predicted_anomaly ORDER BY logs.anomaly_score DESC, event_id LIMIT 20") + "SELECT * FROM ctx")
def l1(spark, d):
    logs = log_table(spark, d)
    top = R.top_k(logs.where("is_predicted_anomaly"), 20, "anomaly_score")
    inc = top.select(F.col("event_id").alias("anomaly_id"), "timestamp", "node", "anomaly_score")
    return I.build_contexts(inc, logs).select(*CONTEXT_COLUMNS)


@query("l2_summaries", CONTEXT_OF.format(which="WHERE is_predicted_anomaly") + f"""SELECT anomaly_id,
 CASE WHEN error_count > 0 THEN error_count || ' errores' ELSE '{NO_CLIENT["resumen"]}' END AS resumen,
 CASE WHEN fatal_count > 0 THEN 'CRITICAL' WHEN error_count > 0 THEN 'MEDIUM' ELSE 'UNKNOWN' END AS severidad,
 CASE WHEN error_count > 0 THEN 'c' ELSE '{NO_CLIENT["causa_probable"]}' END AS causa_probable,
 CASE WHEN error_count > 0 THEN 'a' ELSE '{NO_CLIENT["accion_recomendada"]}' END AS accion_recomendada FROM ctx""")
def l2(spark, d):
    logs = log_table(spark, d)
    inc = logs.where("is_predicted_anomaly").select(F.col("event_id").alias("anomaly_id"), "timestamp", "node", "anomaly_score")
    out = I.summarize(I.build_contexts(inc, logs), lambda: rule_client())
    return out.select("anomaly_id", "resumen", "severidad", "causa_probable", "accion_recomendada")


@query("l2_without_client", f"""SELECT event_id AS anomaly_id, '{NO_CLIENT["resumen"]}' AS resumen, 'UNKNOWN' AS severidad, '{NO_CLIENT["causa_probable"]}' AS causa_probable,
 '{NO_CLIENT["accion_recomendada"]}' AS accion_recomendada, 0.0::DOUBLE AS response_time_ms FROM logs WHERE is_predicted_anomaly""")
def l2_none(spark, d):
    return I.summarize(log_table(spark, d).where("is_predicted_anomaly").withColumn("anomaly_id", F.col("event_id")))


@query("l3_answer_severities", """SELECT CASE event_id % 6 WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'LOW' ELSE severidad END AS severidad,
 CASE event_id % 6 WHEN 4 THEN NULL WHEN 5 THEN 0 ELSE CASE WHEN severidad IN ('CRITICAL', 'HIGH') THEN 1 ELSE 0 END END AS llm_label, count(*) AS n FROM logs GROUP BY 1, 2""")
def l3(spark, d):
    parsed = parse_answers(answer_texts(log_table(spark, d)))
    return parsed.groupBy("severidad", S.weak_label(F.col("severidad")).alias("llm_label")).agg(F.count("*").alias("n"))


@query("l4_history_report", """WITH h AS (SELECT * FROM logs WHERE is_predicted_anomaly)
SELECT node, count(*) AS total, count(*) FILTER (severidad = 'CRITICAL') AS critical, count(*) FILTER (severidad = 'HIGH') AS high, count(*) FILTER (severidad = 'MEDIUM') AS medium
FROM h GROUP BY node""")
def l4(spark, d):
    """The per-node history of every node at once."""
    return I.history_by_node(log_table(spark, d).where("is_predicted_anomaly"))

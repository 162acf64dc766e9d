"""Queries: windows, joins, aggregates, ranking, evaluation, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.functions import filters
from emberlog.functions import scalars as S
from emberlog.functions.scalars import fixed_text
from emberlog.operators import aggregates as A
from emberlog.operators import drift as D
from emberlog.operators import evaluation as EV
from emberlog.operators import incidents as I
from emberlog.operators import joins as J
from emberlog.operators import ranking as R
from emberlog.operators.features import fit_features, robust_bounds, robust_scale
from emberlog.operators.prefix import MINUTE_US
from emberlog.operators.split import temporal_slices, temporal_split
from emberlog.operators.windows import add_rolling_features
from emberlog.plans.logview import read_table
from emberlog.plans.queries_scan import CONTEXT_COLUMNS, CONTEXT_SQL, FRAME, contexts
from emberlog.plans.registry import log_table, query, ts_sql, ts_text
from emberlog.session import scratch_path
from emberlog.sources import tables

# ---------------------------------------------------------------- windows


def _frames(measure: str, name: str) -> str:
    return ", ".join(f"{measure} {FRAME.format(w=w)} AS {name}_{w}min" for w in (1, 5, 15))


def _rolled(spark, d, *names):
    cols = [f"{n}_{w}min" for n in names for w in (1, 5, 15)]
    return add_rolling_features(log_table(spark, d)).select("event_id", *cols)


@query("w1_rolling_counts", f"SELECT event_id, {_frames('count(*)', 'total_count')} FROM logs")
def w1(spark, d):
    return _rolled(spark, d, "total_count")


_SUMS = {"error_count": "severity_score >= 2", "warning_count": "severity_score = 1", "fatal_count": "severity_score >= 3"}


@query("w2_rolling_sums", "SELECT event_id, " + ", ".join(
    f"CAST(sum(CAST({cond} AS INTEGER)) {FRAME.format(w=w)} AS BIGINT) AS {name}_{w}min" for name, cond in _SUMS.items() for w in (1, 5, 15)
) + " FROM logs")
def w2(spark, d):
    return _rolled(spark, d, "error_count", "warning_count", "fatal_count")


@query("w3_rolling_averages", "SELECT event_id, " + ", ".join(
    f"round(avg(severity_score) {FRAME.format(w=w)}, 6) AS avg_severity_{w}min" for w in (1, 5, 15)) + " FROM logs")
def w3(spark, d):
    out = _rolled(spark, d, "avg_severity")
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("w4_rolling_distinct_nodes", f"SELECT event_id, {_frames('count(DISTINCT node)', 'unique_nodes')} FROM logs")
def w4(spark, d):
    return _rolled(spark, d, "unique_nodes")


@query("w4_rolling_by_levels", f"SELECT event_id, {_frames('count(*)', 'total_count')}, {_frames('count(DISTINCT node)', 'unique_nodes')} FROM logs")
def w4_levels(spark, d):
    """The plan for bursts, forced: no group larger than a second or an hour."""
    rolled = add_rolling_features(log_table(spark, d), block_rows=0)
    return rolled.select("event_id", *[f"{n}_{w}min" for n in ("total_count", "unique_nodes") for w in (1, 5, 15)])


@query("w5_percent_rank_average", """SELECT event_id, round((rank() OVER (ORDER BY anomaly_score) + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0)
/ count(*) OVER (), 6) AS pct FROM logs""")
def w5(spark, d):
    return R.percent_rank_average(log_table(spark, d), "anomaly_score").select("event_id", F.round("pct", 6).alias("pct"))


@query("w6_row_numbers", "SELECT event_id, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS row_pos FROM logs")
def w6(spark, d):
    return R.with_row_position(log_table(spark, d).select("event_id", "timestamp")).select("event_id", "row_pos")


@query("w7_cumulative_hits", """SELECT threshold, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, CAST(sum(n - pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp
FROM (SELECT anomaly_score AS threshold, sum(CAST(is_anomaly AS INTEGER)) AS pos, count(*) AS n FROM logs GROUP BY 1)""")
def w7(spark, d):
    t = EV._score_totals(log_table(spark, d), "is_anomaly", "anomaly_score", [])
    return t.select("threshold", "tp", (F.col("flagged") - F.col("tp")).alias("fp"))


KS_SQL = """WITH long AS (
  SELECT event_id, 'anomaly_score' AS feature, anomaly_score AS value FROM logs
  UNION ALL SELECT event_id, 'severity_score', CAST(severity_score AS DOUBLE) FROM logs
  UNION ALL SELECT event_id, 'hour', CAST(hour(timestamp) AS DOUBLE) FROM logs
  UNION ALL SELECT event_id, 'minute', CAST(minute(timestamp) AS DOUBLE) FROM logs
  UNION ALL SELECT event_id, 'text_length', CAST(coalesce(length(content), 0) AS DOUBLE) FROM logs),
pos AS (SELECT event_id, row_number() OVER (ORDER BY timestamp, event_id) AS rn, count(*) OVER () AS n FROM logs),
sides AS (SELECT feature, value + {shift} AS value, p.rn > floor(p.n * 0.8) AS cur FROM long JOIN pos p USING (event_id)),
c AS (SELECT feature, value, sum(CASE WHEN cur THEN 0 ELSE 1 END) AS r, sum(CASE WHEN cur THEN 1 ELSE 0 END) AS k FROM sides GROUP BY 1, 2),
e AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr, sum(k) OVER w / sum(k) OVER (PARTITION BY feature) AS fc,
      sum(r) OVER (PARTITION BY feature) AS n_ref, sum(k) OVER (PARTITION BY feature) AS n_cur FROM c WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, max(abs(fr - fc)) AS ks, max(n_ref)::DOUBLE AS n_ref, max(n_cur)::DOUBLE AS n_cur FROM e GROUP BY 1),
lam AS (SELECT *, ks * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam FROM ks),
pv AS (SELECT feature, ks, n_ref, n_cur, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (
   SELECT sum((CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)))) END AS p_value FROM lam)
"""
SHIFT = "CASE WHEN p.rn > floor(p.n * 0.8) AND feature = 'anomaly_score' THEN 0.2 ELSE 0 END"


KS_COLUMNS = ("anomaly_score", "severity_score", "hour", "minute", "text_length")


def ks_rows(spark, d):
    """The log's numeric columns, for the drift queries."""
    logs = log_table(spark, d).withColumns({"hour": F.hour("timestamp"), "minute": F.minute("timestamp"), "text_length": F.length("content")})
    return logs.select("event_id", "timestamp", "node", "is_anomaly", *[F.col(c).cast("double").alias(c) for c in KS_COLUMNS])


def _ks(spark, d, shift: float = 0.0):
    logs = ks_rows(spark, d)
    first = temporal_slices(logs, (0.8,))[0]
    moved = logs.withColumn("anomaly_score", F.col("anomaly_score") + F.when(~first, shift).otherwise(0.0)) if shift else logs
    return D.ks_per_feature(moved, KS_COLUMNS, ~first)


@query("w8_ecdf_gap", KS_SQL.format(shift="0") + "SELECT feature, round(ks, 6) AS ks FROM ks")
def w8(spark, d):
    return _ks(spark, d).select("feature", F.round("ks", 6).alias("ks"))


# ---------------------------------------------------------------- joins


@query("j1_node_baseline_join", """WITH s AS (SELECT node, sum(CAST(is_anomaly AS INTEGER)) / count(*) AS node_error_ratio, avg(severity_score) AS node_avg_severity FROM logs GROUP BY node)
SELECT event_id, round(node_error_ratio, 6) AS node_error_ratio, round(node_avg_severity, 6) AS node_avg_severity FROM logs LEFT JOIN s USING (node)""")
def j1(spark, d):
    logs = log_table(spark, d)
    out = J.join_node_stats(logs, A.node_baseline(logs))
    return out.select("event_id", F.round("node_error_ratio", 6).alias("node_error_ratio"), F.round("node_avg_severity", 6).alias("node_avg_severity"))


@query("j2_label_join", """WITH lab AS (SELECT timestamp, node, CASE WHEN severidad IN ('CRITICAL', 'HIGH') THEN 1 ELSE 0 END AS llm_label FROM logs WHERE is_predicted_anomaly
 UNION ALL SELECT timestamp, node, 0 FROM logs WHERE is_anomaly)
SELECT event_id, llm_label FROM logs JOIN lab USING (timestamp, node)""")
def j2(spark, d):
    logs = log_table(spark, d)
    lab = logs.where("is_predicted_anomaly").select("timestamp", "node", S.weak_label(F.col("severidad")).alias("llm_label"))
    twice = logs.where("is_anomaly").select("timestamp", "node", F.lit(0).alias("llm_label"))
    return J.join_labels(logs.select("event_id", "timestamp", "node"), lab.unionByName(twice)).select("event_id", "llm_label")


@query("j3_band_join", """SELECT a.event_id AS a_event_id, e.event_id, e.node, e.severity_score FROM logs a JOIN logs e
ON e.timestamp BETWEEN a.timestamp - INTERVAL '150 seconds' AND a.timestamp + INTERVAL '150 seconds' WHERE a.is_anomaly""")
def j3(spark, d):
    logs = log_table(spark, d)
    half = int(2.5 * MINUTE_US)
    pairs = J.band_join(logs.where("is_anomaly").select("event_id", "timestamp"), logs, half, half)
    return pairs.select("a_event_id", "event_id", "node", F.col("severity_score").cast("long").alias("severity_score"))


@query("j4_range_semi_join", f"""WITH top AS (SELECT timestamp AS t FROM logs WHERE is_predicted_anomaly ORDER BY anomaly_score DESC, event_id LIMIT 60)
SELECT DISTINCT {ts_sql()} AS ts, node, level, component, content, severity_score, is_anomaly FROM logs WHERE EXISTS (
 SELECT 1 FROM top WHERE timestamp BETWEEN t - INTERVAL '6 minutes' AND t + INTERVAL '6 minutes')""")
def j4(spark, d):
    logs = log_table(spark, d)
    top = R.top_k(logs.where("is_predicted_anomaly"), 60, "anomaly_score")
    near = J.near_any(logs, top, 6 * MINUTE_US)
    return near.select(ts_text().alias("ts"), "node", "level", "component", "content",
                       F.col("severity_score").cast("long").alias("severity_score"), "is_anomaly").dropDuplicates()


@query("j5_incident_pairs", """WITH inc AS (SELECT event_id, node, severidad FROM logs WHERE is_predicted_anomaly),
pairs AS (SELECT event_id AS a, event_id + 5 AS b FROM inc)
SELECT p.a AS id_1, p.b AS id_2, CASE WHEN y.event_id IS NULL THEN p.b END AS missing_id,
 CASE WHEN y.event_id IS NULL THEN NULL WHEN x.node = y.node THEN 'IGUAL' ELSE 'DIFERENTE' END AS node_match,
 CASE WHEN y.event_id IS NULL THEN NULL WHEN x.severidad = y.severidad THEN 'IGUAL' ELSE 'DIFERENTE' END AS severidad_match,
 x.node AS node_1, y.node AS node_2, x.severidad AS severidad_1, y.severidad AS severidad_2
FROM pairs p JOIN inc x ON x.event_id = p.a LEFT JOIN inc y ON y.event_id = p.b""")
def j5(spark, d):
    inc = log_table(spark, d).where("is_predicted_anomaly").select(F.col("event_id").alias("anomaly_id"), "timestamp", "node", "severidad")
    pairs = inc.select(F.col("anomaly_id").alias("id_1"), (F.col("anomaly_id") + 5).alias("id_2"))
    return J.compare_pairs(pairs, inc)


@query("j6_window_reattach", f"SELECT event_id, node, component, count(*) {FRAME.format(w=5)} AS total_count_5min FROM logs")
def j6(spark, d):
    return add_rolling_features(log_table(spark, d), (5,)).select("event_id", "node", "component", "total_count_5min")


@query("j7_positional_alignment", "SELECT event_id, level, component, is_predicted_anomaly, round(anomaly_score, 6) AS anomaly_score FROM logs")
def j7(spark, d):
    logs = log_table(spark, d)
    raw = logs.select("event_id", "timestamp", "level", "component")
    preds = logs.select("event_id", "timestamp", "is_predicted_anomaly", F.round("anomaly_score", 6).alias("anomaly_score"))
    return J.align_by_position(raw, preds).select("event_id", "level", "component", "is_predicted_anomaly", "anomaly_score")


SCALE_SQL = """WITH q AS (SELECT median(anomaly_score) AS m, quantile_cont(anomaly_score, 0.75) - quantile_cont(anomaly_score, 0.25) AS iqr,
 median(severity_score) AS sm, quantile_cont(severity_score, 0.75) - quantile_cont(severity_score, 0.25) AS siqr FROM logs)
"""


@query("j8_column_concat", SCALE_SQL + f"""SELECT event_id, {ts_sql()} AS ts, node, is_anomaly, round(CAST(CAST((anomaly_score - m) / (CASE WHEN iqr = 0 THEN 1 ELSE iqr END) AS FLOAT) AS DOUBLE), 4) AS anomaly_score
FROM logs, q""")
def j8(spark, d):
    logs = log_table(spark, d)
    ids = ["event_id", "timestamp", "node", "is_anomaly"]
    scaled = robust_scale(logs, robust_bounds(logs, ["anomaly_score"]), ids)
    return scaled.select("event_id", ts_text().alias("ts"), "node", "is_anomaly", F.round(F.col("anomaly_score").cast("double"), 4).alias("anomaly_score"))


# ---------------------------------------------------------------- aggregates


@query("a1_node_baseline", """SELECT node, count(*) AS node_total, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS node_error_count,
round(avg(severity_score), 6) AS node_avg_severity, round(sum(CAST(is_anomaly AS INTEGER)) / nullif(count(*), 0)::DOUBLE, 6) AS node_error_ratio FROM logs GROUP BY node""")
def a1(spark, d):
    b = A.node_baseline(log_table(spark, d))
    return b.select("node", "node_total", "node_error_count", F.round("node_avg_severity", 6).alias("node_avg_severity"),
                    F.round("node_error_ratio", 6).alias("node_error_ratio"))


@query("a2_relative_frequency", "SELECT component, count(*) AS n, round(count(*) / (SELECT count(*) FROM logs), 6) AS share FROM logs GROUP BY component")
def a2(spark, d):
    return A.relative_frequency(log_table(spark, d), "component").withColumn("share", F.round("share", 6))


@query("a3_value_counts", """SELECT 'level' AS what, level AS value, count(*) AS n FROM logs GROUP BY level
UNION ALL SELECT * FROM (SELECT 'fp_component', component, count(*) FROM logs WHERE is_predicted_anomaly AND NOT is_anomaly GROUP BY component ORDER BY 3 DESC, 2 LIMIT 10)""")
def a3(spark, d):
    logs = log_table(spark, d)
    levels = A.value_counts(logs, "level").select(F.lit("level").alias("what"), F.col("level").alias("value"), "n")
    fp = A.value_counts(filters.error_slice(logs, "FP"), "component", 10)
    return levels.unionByName(fp.select(F.lit("fp_component").alias("what"), F.col("component").alias("value"), "n"))


@query("a4_anomaly_types", "SELECT label, count(*) AS n FROM logs WHERE is_anomaly GROUP BY label ORDER BY n DESC, label LIMIT 15")
def a4(spark, d):
    return A.anomaly_types(log_table(spark, d))


@query("a5_class_balance", """SELECT count(*) FILTER (NOT is_anomaly) AS n_normal, count(*) FILTER (is_anomaly) AS n_anomaly, round(avg(CAST(is_anomaly AS INTEGER)), 6) AS ratio,
CAST(floor(count(*) FILTER (NOT is_anomaly) / nullif(count(*) FILTER (is_anomaly), 0)) AS BIGINT) AS one_to FROM logs""")
def a5(spark, d):
    return A.class_balance(log_table(spark, d)).withColumn("ratio", F.round("ratio", 6))


@query("a6_hourly_series", f"""WITH h AS (SELECT date_trunc('hour', timestamp)::TIMESTAMP AS hour, count(*) FILTER (is_anomaly) AS a, count(*) AS t FROM logs GROUP BY 1),
sp AS (SELECT unnest(generate_series((SELECT min(hour) FROM h), (SELECT max(hour) FROM h), INTERVAL 1 HOUR)) AS hour)
SELECT {ts_sql('sp.hour')} AS hour, coalesce(a, 0) AS anomalias, coalesce(t, 0) AS total, coalesce(t, 0) - coalesce(a, 0) AS normales FROM sp LEFT JOIN h USING (hour)""")
def a6(spark, d):
    return A.hourly_series(log_table(spark, d), "is_anomaly").withColumn("hour", ts_text("hour"))


_HOUR_COUNTS = ", ".join(f"count(*) FILTER (hour(timestamp) = {h}) AS h{h:02d}" for h in range(24))


@query("a7_weekday_heatmap", f"SELECT dayname(timestamp) AS weekday, CAST(isodow(timestamp) AS INTEGER) AS day_no, {_HOUR_COUNTS} FROM logs WHERE is_anomaly GROUP BY 1, 2")
def a7(spark, d):
    return A.weekday_heatmap(log_table(spark, d)).withColumn("day_no", F.col("day_no").cast("int"))


ALERTS = "is_predicted_anomaly AND anomaly_score >= 0.3 AND severidad IN ('MEDIUM', 'HIGH', 'CRITICAL')"


def _alerts(spark, d):
    return filters.alerts(log_table(spark, d), 0.3, ["MEDIUM", "HIGH", "CRITICAL"])


@query("a8_node_heatmap", f"""WITH top AS (SELECT node FROM logs WHERE {ALERTS} GROUP BY node ORDER BY count(*) DESC, node LIMIT 15)
SELECT node, {_HOUR_COUNTS} FROM logs WHERE {ALERTS} AND node IN (SELECT node FROM top) GROUP BY node""")
def a8(spark, d):
    return A.node_heatmap(_alerts(spark, d))


@query("a9_incident_context", CONTEXT_SQL + "SELECT * FROM ctx")
def a9(spark, d):
    return contexts(spark, d).select(*CONTEXT_COLUMNS)


@query("a10_node_leaderboard", """SELECT node, count(anomaly_score) AS n_anomalies, round(avg(anomaly_score), 6) AS avg_score FROM logs WHERE is_predicted_anomaly
GROUP BY node ORDER BY n_anomalies DESC, node LIMIT 15""")
def a10(spark, d):
    return A.node_leaderboard(log_table(spark, d)).withColumn("avg_score", F.round("avg_score", 6))


def history(spark, d):
    """Predicted anomalies as an incident history."""
    return log_table(spark, d).where("is_predicted_anomaly").select(
        F.concat(F.lit("AN-"), F.col("event_id").cast("string")).alias("anomaly_id"), "timestamp", "node", "severidad")


_COUNTS = "count(*) AS total, count(*) FILTER (severidad = 'CRITICAL') AS critical, count(*) FILTER (severidad = 'HIGH') AS high, count(*) FILTER (severidad = 'MEDIUM') AS medium"


@query("a11_node_history", f"SELECT {_COUNTS} FROM logs WHERE is_predicted_anomaly AND regexp_matches(node, 'r2', 'i')")
def a11(spark, d):
    return I.node_history(history(spark, d), "r2")


@query("a11_node_history_days", f"""SELECT {_COUNTS} FROM logs WHERE is_predicted_anomaly AND regexp_matches(node, 'r2', 'i')
AND timestamp >= (SELECT max(timestamp) FROM logs WHERE is_predicted_anomaly) - INTERVAL 7 DAY""")
def a11_days(spark, d):
    return I.node_history(history(spark, d), "r2", days_back=7)


@query("a12_top_nodes", "SELECT node, count(*) AS n FROM logs WHERE is_predicted_anomaly GROUP BY node ORDER BY n DESC, node LIMIT 5")
def a12(spark, d):
    return A.top_nodes(history(spark, d))


@query("a13_kpi_block", f"""SELECT count(*) AS total, count(*) FILTER (is_predicted_anomaly) AS n_predicted, round(avg(CAST(is_predicted_anomaly AS INTEGER)), 6) AS rate,
count(*) FILTER ({ALERTS} AND severidad = 'CRITICAL') AS n_critical FROM logs""")
def a13(spark, d):
    return A.kpi_block(log_table(spark, d), 0.3, ["MEDIUM", "HIGH", "CRITICAL"]).withColumn("rate", F.round("rate", 6))


_CELLS = "sum(CAST(t AND p AS INTEGER)) AS tp, sum(CAST(NOT t AND p AS INTEGER)) AS fp, sum(CAST(t AND NOT p AS INTEGER)) AS fn, sum(CAST(NOT t AND NOT p AS INTEGER)) AS tn"
_CONFUSION = """SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c"""


@query("a14_confusion", f"WITH c AS (SELECT {_CELLS} FROM (SELECT is_anomaly AS t, is_predicted_anomaly AS p FROM logs)) {_CONFUSION}")
def a14(spark, d):
    c = EV.confusion(log_table(spark, d))
    return c.select("tp", "fp", "fn", "tn", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")])


@query("a14_confusion_labels", f"WITH c AS (SELECT {_CELLS} FROM (SELECT toxic = 1 AS t, quality = 0 AS p FROM labels)) {_CONFUSION}", logs=False)
def a14_labels(spark, d):
    rows = read_table(spark, d, "labels").select((F.col("toxic") == 1).alias("t"), (F.col("quality") == 0).alias("p"))
    c = EV.confusion(rows, "t", "p")
    return c.select("tp", "fp", "fn", "tn", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")])


AP_SQL = """WITH s AS (SELECT anomaly_score AS thr, sum(CAST(is_anomaly AS INTEGER)) AS pos, count(*) AS n FROM logs GROUP BY 1),
c AS (SELECT thr, pos, sum(pos) OVER (ORDER BY thr DESC) AS tp, sum(n) OVER (ORDER BY thr DESC) AS flagged, sum(pos) OVER () AS all_pos FROM s)
"""


@query("a15_average_precision", AP_SQL + "SELECT round(sum(pos / all_pos * tp / flagged), 6) AS aupr FROM c")
def a15(spark, d):
    return EV.average_precision(log_table(spark, d)).select(F.round("aupr", 6).alias("aupr"))


@query("a16_pr_curve", AP_SQL + """SELECT thr AS threshold, round(tp / flagged, 6) AS precision, round(tp / all_pos, 6) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def a16(spark, d):
    return EV.pr_curve(log_table(spark, d)).select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def _three_models(spark, d):
    """The same truth under three cut-offs of the score."""
    logs = log_table(spark, d).select("is_anomaly", "anomaly_score")
    cuts = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("cut")) for m, c in (("LOF", 0.25), ("IF", 0.4), ("OCSVM", 0.8))])
    rows = logs.withColumn("m", F.explode(cuts))
    return rows.select(F.col("m.model").alias("model"), "is_anomaly", "anomaly_score", (F.col("anomaly_score") >= F.col("m.cut")).alias("is_predicted_anomaly"))


@query("a17_model_comparison", AP_SQL + """, m AS (SELECT * FROM (VALUES ('LOF', 0.25), ('IF', 0.4), ('OCSVM', 0.8)) v(model, cut)),
x AS (SELECT model, sum(CAST(is_anomaly AND anomaly_score >= cut AS INTEGER)) AS tp, sum(CAST(NOT is_anomaly AND anomaly_score >= cut AS INTEGER)) AS fp,
 sum(CAST(is_anomaly AND anomaly_score < cut AS INTEGER)) AS fn FROM logs, m GROUP BY model)
SELECT model, CAST(printf('%.4f', tp / (tp + fp)) AS DOUBLE) AS precision, CAST(printf('%.4f', tp / (tp + fn)) AS DOUBLE) AS recall,
 CAST(printf('%.4f', 2 * tp / (2 * tp + fp + fn)) AS DOUBLE) AS f1, CAST(printf('%.4f', (SELECT sum(pos / all_pos * tp / flagged) FROM c)) AS DOUBLE) AS aupr,
 CAST(tp + fn AS BIGINT) AS n_true, CAST(tp + fp AS BIGINT) AS n_pred FROM x""")
def a17(spark, d):
    return EV.compare_models(EV.evaluate(_three_models(spark, d)))


def _summary_sql(feature: str) -> str:
    return (f"SELECT '{feature}' AS feature, count({feature}) AS n, round(avg({feature}), 6) AS mean, round(stddev_samp({feature}), 6) AS std, "
            f"min({feature})::DOUBLE AS min, round(quantile_cont({feature}, 0.25), 6)::DOUBLE AS q25, round(quantile_cont({feature}, 0.5), 6)::DOUBLE AS q50, "
            f"round(quantile_cont({feature}, 0.75), 6)::DOUBLE AS q75, max({feature})::DOUBLE AS max FROM logs")


@query("a18_column_summary", " UNION ALL ".join(_summary_sql(f) for f in ("anomaly_score", "severity_score")))
def a18(spark, d):
    s = A.column_summary(log_table(spark, d), ["anomaly_score", "severity_score"])
    return s.select("feature", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


_CORR = {"anomaly_score": "anomaly_score", "severity_score": "CAST(severity_score AS DOUBLE)", "event_id": "CAST(event_id AS DOUBLE)"}


@query("a19_correlation", " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({x}, {y}), 6) AS corr FROM logs"
                                             for a, x in _CORR.items() for b, y in _CORR.items()))
def a19(spark, d):
    return A.correlation_matrix(log_table(spark, d), list(_CORR)).withColumn("corr", F.round("corr", 6))


@query("a20_histogram", """WITH b AS (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi, (max(anomaly_score) - min(anomaly_score)) / 50.0 AS w FROM logs),
c AS (SELECT severidad, CAST(least(floor((anomaly_score - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n FROM logs, b GROUP BY 1, 2),
z AS (SELECT severidad, count(*) AS size FROM logs GROUP BY 1)
SELECT severidad, bin, n, round(lo + bin * w, 6) AS bin_from, round(n / (size * w), 6) AS density FROM c JOIN z USING (severidad), b""")
def a20(spark, d):
    h = A.histogram(log_table(spark, d), "anomaly_score", "severidad", 50)
    return h.withColumn("bin_from", F.round("bin_from", 6)).withColumn("density", F.round("density", 6))


@query("a20_histogram_per_class", """WITH b AS (SELECT is_anomaly, min(anomaly_score) AS lo, (max(anomaly_score) - min(anomaly_score)) / 40.0 AS w, count(*) AS size FROM logs GROUP BY 1),
c AS (SELECT is_anomaly, CAST(least(floor((anomaly_score - lo) / w), 39) AS INTEGER) AS bin, count(*) AS n FROM logs JOIN b USING (is_anomaly) GROUP BY 1, 2)
SELECT is_anomaly, bin, n, round(lo + bin * w, 6) AS bin_from, round(n / (size * w), 6) AS density FROM c JOIN b USING (is_anomaly)""")
def a20_own(spark, d):
    h = A.histogram_per_class(log_table(spark, d), "anomaly_score", "is_anomaly", 40)
    return h.withColumn("bin_from", F.round("bin_from", 6)).withColumn("density", F.round("density", 6))


@query("a21_latency", "SELECT round(avg(value), 4) AS mean_ms, round(median(value), 4) AS median_ms, round(quantile_cont(value, 0.95), 4) AS p95_ms FROM events", logs=False)
def a21(spark, d):
    out = A.latency_summary(read_table(spark, d, "events"), "value")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


@query("a22_severity_distribution", "SELECT severidad, count(*) AS n FROM logs WHERE is_predicted_anomaly GROUP BY 1")
def a22(spark, d):
    return I.severity_distribution(history(spark, d))


TRAIN_SQL = "pos AS (SELECT *, row_number() OVER (ORDER BY timestamp, event_id) AS rn, count(*) OVER () AS total FROM logs)"


@query("a23_contamination", f"WITH {TRAIN_SQL} SELECT round(avg(CAST(is_anomaly AS INTEGER)), 6) AS contamination FROM pos WHERE rn <= floor(total * 0.8)")
def a23(spark, d):
    train, _ = temporal_split(log_table(spark, d), 0.2)
    return A.contamination(train).select(F.round("contamination", 6).alias("contamination"))


@query("a24_score_moments", """SELECT round(avg(anomaly_score) FILTER (NOT is_anomaly), 6) AS normal_mean, round(stddev_samp(anomaly_score) FILTER (NOT is_anomaly), 6) AS normal_std,
round(avg(anomaly_score) FILTER (is_anomaly), 6) AS anomaly_mean, round(stddev_samp(anomaly_score) FILTER (is_anomaly), 6) AS anomaly_std FROM logs""")
def a24(spark, d):
    m = A.score_moments(log_table(spark, d))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("a25_time_extent", f"""WITH {TRAIN_SQL} SELECT CASE WHEN rn <= floor(total * 0.8) THEN 'train' ELSE 'test' END AS part, {ts_sql('min(timestamp)')} AS first_ts,
{ts_sql('max(timestamp)')} AS last_ts, count(*) AS n FROM pos GROUP BY 1""")
def a25(spark, d):
    out = [A.time_extent(part).select(F.lit(name).alias("part"), ts_text("first_ts").alias("first_ts"), ts_text("last_ts").alias("last_ts"), "n")
           for name, part in zip(("train", "test"), temporal_split(log_table(spark, d), 0.2))]
    return out[0].unionByName(out[1])


@query("a26_detection_rollup", """SELECT node, count(*) AS total_logs, count(*) FILTER (is_predicted_anomaly) AS total_anomalies,
round(count(*) FILTER (is_predicted_anomaly) / count(*), 6) AS anomaly_rate FROM logs GROUP BY node
UNION ALL SELECT 'ALL', count(*), count(*) FILTER (is_predicted_anomaly), round(count(*) FILTER (is_predicted_anomaly) / count(*), 6) FROM logs""")
def a26(spark, d):
    logs = log_table(spark, d)
    whole = A.detection_rollup(logs).withColumn("node", F.lit("ALL"))
    return A.detection_rollup(logs, ["node"]).unionByName(whole).withColumn("anomaly_rate", F.round("anomaly_rate", 6))


@query("a27_context_lists", """WITH pos AS (SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS rp FROM logs)
SELECT a.event_id AS anomaly_id, CAST(floor(e.rp / 1000) AS BIGINT) AS chunk, count(*) AS n, string_agg(e.event_id || ':' || e.node || ':' || e.level, ',' ORDER BY e.rp) AS entries
FROM logs a JOIN pos e ON e.timestamp BETWEEN a.timestamp - INTERVAL '150 seconds' AND a.timestamp + INTERVAL '150 seconds' WHERE a.is_anomaly GROUP BY 1, 2""")
def a27(spark, d):
    logs = log_table(spark, d)
    hits = logs.where("is_anomaly").withColumn("anomaly_id", F.col("event_id"))
    chunks = J.context_chunks(hits, logs, 5, ["event_id", "timestamp", "node", "level", "component", "content"])
    entry = F.transform("entries", lambda x: F.concat_ws(":", x["event_id"].cast("string"), x["node"], x["level"]))
    return chunks.select("anomaly_id", "chunk", F.size("entries").cast("long").alias("n"), F.array_join(entry, ",").alias("entries"))


# ---------------------------------------------------------------- sort, limit, top-k


@query("t1_chronological_sort", f"SELECT event_id, {ts_sql()} AS ts FROM logs ORDER BY timestamp, event_id")
def t1(spark, d):
    from emberlog.sources.text import chronological

    return chronological(log_table(spark, d).select("event_id", "timestamp"), "event_id").select("event_id", ts_text().alias("ts"))


@query("t2_temporal_split", f"""WITH {TRAIN_SQL} SELECT event_id, CASE WHEN rn <= floor(total * (1 - 0.2)) THEN 'train' ELSE 'test' END AS part FROM pos""")
def t2(spark, d):
    train, test = temporal_split(log_table(spark, d), 0.2)
    return train.select("event_id", F.lit("train").alias("part")).unionByName(test.select("event_id", F.lit("test").alias("part")))


@query("t2_sixty_eighty_split", f"""WITH {TRAIN_SQL} SELECT event_id, CASE WHEN rn <= floor(total * 0.6) THEN 'reference' WHEN rn <= floor(total * 0.8) THEN 'gap' ELSE 'production' END AS part FROM pos""")
def t2_slices(spark, d):
    logs = log_table(spark, d)
    sixty, eighty = temporal_slices(logs, (0.6, 0.8))
    return logs.select("event_id", F.when(sixty, "reference").when(eighty, "gap").otherwise("production").alias("part"))


@query("t3_top_scores", "SELECT event_id, round(anomaly_score, 6) AS anomaly_score FROM logs WHERE is_predicted_anomaly ORDER BY anomaly_score DESC, event_id LIMIT 300")
def t3(spark, d):
    return R.top_k(log_table(spark, d).where("is_predicted_anomaly"), 300, "anomaly_score").select("event_id", F.round("anomaly_score", 6).alias("anomaly_score"))


@query("t4_alert_table", f"""SELECT {ts_sql()} AS ts, node, round(anomaly_score, 6) AS anomaly_score, severidad, is_anomaly FROM logs WHERE {ALERTS}
ORDER BY logs.anomaly_score DESC, event_id LIMIT 200""")
def t4(spark, d):
    return R.top_k(_alerts(spark, d), 200, "anomaly_score").select(ts_text().alias("ts"), "node", F.round("anomaly_score", 6).alias("anomaly_score"), "severidad", "is_anomaly")


@query("t5_recent_incidents", f"SELECT 'AN-' || event_id AS anomaly_id, node, severidad, {ts_sql()} AS ts FROM logs WHERE is_predicted_anomaly ORDER BY timestamp DESC, anomaly_id LIMIT 5")
def t5(spark, d):
    return R.latest(history(spark, d)).select("anomaly_id", "node", "severidad", ts_text().alias("ts"))


@query("t6_ranked_models", """WITH m AS (SELECT * FROM (VALUES ('LOF', 0.25), ('IF', 0.4), ('OCSVM', 0.8)) v(model, cut)),
x AS (SELECT model, sum(CAST(is_anomaly AND anomaly_score >= cut AS INTEGER)) AS tp, sum(CAST(is_anomaly <> (anomaly_score >= cut) AS INTEGER)) AS wrong FROM logs, m GROUP BY model)
SELECT model, CAST(row_number() OVER (ORDER BY 2 * tp / (2 * tp + wrong) DESC, model) AS INTEGER) AS place FROM x""")
def t6(spark, d):
    from pyspark.sql import Window as W

    # three rows, one per model
    best = EV.confusion(_three_models(spark, d), by=["model"])
    return best.select("model", F.row_number().over(W.orderBy(F.col("f1").desc(), "model")).alias("place"))


@query("t7_uniform_sample", "SELECT event_id FROM logs ORDER BY md5('42|' || event_id), event_id LIMIT 500")
def t7(spark, d):
    return R.uniform_sample(log_table(spark, d), 500).select("event_id")


@query("t8_smallest_p_values", KS_SQL.format(shift=SHIFT) + "SELECT feature, round(p_value, 6) AS p_value FROM pv ORDER BY pv.p_value, feature LIMIT 4")
def t8(spark, d):
    return R.head(_ks(spark, d, 0.2), 4, "p_value", "feature").select("feature", F.round("p_value", 6).alias("p_value"))


@query("t9_top_per_group", """SELECT node, component, n FROM (SELECT node, component, count(*) AS n, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, component) AS rn
FROM logs GROUP BY 1, 2) WHERE rn <= 3""")
def t9(spark, d):
    counts = log_table(spark, d).groupBy("node", "component").agg(F.count("*").alias("n"))
    return R.top_k_per_group(counts, ["node"], [F.col("n").desc(), F.col("component")], 3)


@query("t10_head", f"SELECT event_id, {ts_sql()} AS ts, node FROM logs ORDER BY timestamp, event_id LIMIT 15")
def t10(spark, d):
    return R.head(log_table(spark, d), 15, "timestamp", "event_id").select("event_id", ts_text().alias("ts"), "node")


@query("u1_distinct_rows", "SELECT DISTINCT node, level, component, content FROM logs")
def u1(spark, d):
    return log_table(spark, d).select("node", "level", "component", "content").dropDuplicates()


@query("u2_shared_columns", "SELECT count(*) AS n, 'event_id,value' AS shared FROM events", logs=False)
def u2(spark, d):
    events = read_table(spark, d, "events")
    names = D.shared_columns(events.select("event_id", "user_id", "value"), events.select("value", "event_id", "ts"))
    return events.agg(F.count("*").alias("n")).withColumn("shared", F.lit(",".join(names)))


@query("u3_union_of_ranges", """WITH top AS (SELECT timestamp AS t FROM logs WHERE is_anomaly)
SELECT event_id FROM logs WHERE EXISTS (SELECT 1 FROM top WHERE timestamp BETWEEN t - INTERVAL '6 minutes' AND t + INTERVAL '6 minutes')""")
def u3(spark, d):
    logs = log_table(spark, d)
    return J.near_any(logs.select("event_id", "timestamp"), logs.where("is_anomaly"), 6 * MINUTE_US).select("event_id")


# ---------------------------------------------------------------- scaling and drift


@query("m1_robust_scaling", SCALE_SQL + """SELECT event_id, round(CAST(CAST((anomaly_score - m) / (CASE WHEN iqr = 0 THEN 1 ELSE iqr END) AS FLOAT) AS DOUBLE), 4) AS anomaly_score,
round((severity_score - sm) / (CASE WHEN siqr = 0 THEN 1 ELSE siqr END), 4) AS severity_score FROM logs, q""")
def m1(spark, d):
    logs = log_table(spark, d)
    out = robust_scale(logs, robust_bounds(logs, ["anomaly_score", "severity_score"]), ["event_id"])
    return out.select("event_id", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("anomaly_score", "severity_score")])


def _frame_sql(src: str) -> str:
    return f"""SELECT event_id, node, is_anomaly, component, CAST(count(*) {FRAME.format(w=5)} AS FLOAT) AS total_count_5min,
 CAST(sum(CAST(severity_score >= 2 AS INTEGER)) {FRAME.format(w=5)} / (count(*) {FRAME.format(w=5)})::DOUBLE AS FLOAT) AS error_rate_5min,
 CAST(avg(severity_score) {FRAME.format(w=15)} AS FLOAT) AS avg_severity_15min, CAST(count(DISTINCT node) {FRAME.format(w=15)} AS FLOAT) AS unique_nodes_15min FROM {src}"""


_PIPE = ("total_count_5min", "error_rate_5min", "avg_severity_15min", "unique_nodes_15min", "node_error_ratio", "comp_error")
PIPELINE_SQL = f"""WITH {TRAIN_SQL}, tr AS (SELECT * FROM pos WHERE rn <= floor(total * 0.8)), te AS (SELECT * FROM pos WHERE rn > floor(total * 0.8)),
st AS (SELECT node, sum(CAST(is_anomaly AS INTEGER)) / count(*) AS node_error_ratio FROM tr GROUP BY node),
ftr AS (SELECT f.*, CAST(coalesce(st.node_error_ratio, 0) AS FLOAT) AS node_error_ratio, CAST(component = 'ERROR' AS INTEGER) AS comp_error FROM ({_frame_sql('tr')}) f LEFT JOIN st USING (node)),
fte AS (SELECT f.*, CAST(coalesce(st.node_error_ratio, 0) AS FLOAT) AS node_error_ratio, CAST(component = 'ERROR' AS INTEGER) AS comp_error FROM ({_frame_sql('te')}) f LEFT JOIN st USING (node)),
b AS (SELECT {", ".join(f"median({c}::DOUBLE) AS m_{c}, quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25) AS i_{c}" for c in _PIPE)} FROM ftr)
SELECT event_id, {", ".join(f"round(({c}::DOUBLE - m_{c}) / (CASE WHEN i_{c} = 0 THEN 1 ELSE i_{c} END), 3) AS {c}" for c in _PIPE)} FROM fte, b"""


@query("m2_feature_pipeline", PIPELINE_SQL)
def m2(spark, d):
    from emberlog.operators.features import FeatureModel

    train, test = temporal_split(log_table(spark, d), 0.2)
    model = fit_features(train)
    path = scratch_path(spark, "feature-model")
    model.save(path)
    out = FeatureModel.load(spark, path).transform(test, ["event_id"])
    return out.select("event_id", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in _PIPE])


@query("d1_ks_per_feature", KS_SQL.format(shift=SHIFT) + "SELECT feature, round(ks, 6) AS ks, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, round(p_value, 6) AS p_value FROM pv")
def d1(spark, d):
    return _ks(spark, d, 0.2).select("feature", F.round("ks", 6).alias("ks"), "n_ref", "n_cur", F.round("p_value", 6).alias("p_value"))


REPORT_SQL = f"""SELECT CAST(printf('%.4f', share) AS DOUBLE) AS drift_score, share > 0 AS drift_detected, features_drifted, feature_scores, n_features_total,
 CASE WHEN share = 0 THEN '{D.NO_DRIFT}' WHEN share < 0.3 THEN '{D.LEVELS[0][1]}' WHEN share < 0.7 THEN '{D.LEVELS[1][1]}' ELSE '{D.SEVERE}' END AS recommendation
FROM (SELECT avg(CAST(p_value < 0.05 AS INTEGER)) AS share, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (p_value < 0.05), '') AS features_drifted,
 string_agg(feature || '=' || printf('%.6f', p_value), ',' ORDER BY feature) AS feature_scores, count(*) AS n_features_total FROM pv)"""


def whole_report(report):
    """A drift report with its lists and its map as text."""
    scores = F.array_sort(F.map_entries("feature_scores"))
    said = F.transform(scores, lambda e: F.concat(e["key"], F.lit("="), fixed_text(e["value"], 6)))
    return report.select(
        "drift_score", "drift_detected", F.array_join("features_drifted", ",").alias("features_drifted"),
        F.array_join(said, ",").alias("feature_scores"), "n_features_total", "recommendation")


@query("d2_drift_report", KS_SQL.format(shift=SHIFT) + REPORT_SQL)
def d2(spark, d):
    return whole_report(D.drift_report(_ks(spark, d, 0.2)))


@query("d3_recommendations", f"""SELECT event_id, CASE WHEN NOT is_predicted_anomaly THEN '{D.NO_DRIFT}' WHEN anomaly_score < 0.3 THEN '{D.LEVELS[0][1]}'
WHEN anomaly_score < 0.7 THEN '{D.LEVELS[1][1]}' ELSE '{D.SEVERE}' END AS advice FROM logs""")
def d3(spark, d):
    return log_table(spark, d).select("event_id", D.recommendation(F.col("anomaly_score"), F.col("is_predicted_anomaly")).alias("advice"))


@query("d3b_last_drift_score", "SELECT 0.0::DOUBLE AS before_any, (SELECT round(value, 6) FROM events ORDER BY ts DESC LIMIT 1) AS after_runs", logs=False)
def d3b(spark, d):
    runs = read_table(spark, d, "events").select(F.col("ts").alias("run_ts"), F.round("value", 6).alias("drift_score"))
    path = scratch_path(spark, "drift-scores")
    tables.save_table(runs, path)
    none = tables.last_drift_score(tables.load_optional(spark, path + "-absent"), spark)
    some = tables.last_drift_score(tables.load_optional(spark, path), spark)
    return some.select(none.scalar().alias("before_any"), F.col("drift_score").alias("after_runs"))


@query("d4_traffic_light", """SELECT event_id, CASE WHEN anomaly_score < 0.15 THEN '🟢' WHEN anomaly_score < 0.50 THEN '🟡' ELSE '🔴' END AS light,
CASE WHEN anomaly_score < 0.3 THEN '🟢' WHEN anomaly_score < 0.7 THEN '🟡' ELSE '🔴' END AS light_wide FROM logs""")
def d4(spark, d):
    s = F.col("anomaly_score")
    return log_table(spark, d).select("event_id", D.traffic_light(s).alias("light"), D.traffic_light(s, 0.3, 0.7).alias("light_wide"))


@query("d6_artificial_shift", "SELECT event_id, round(anomaly_score + 2.0, 6) AS anomaly_score, CAST(severity_score AS DOUBLE) + 2.0 AS severity_score FROM logs")
def d6(spark, d):
    rows = log_table(spark, d).select("event_id", "anomaly_score", F.col("severity_score").cast("double").alias("severity_score"))
    return D.shift_features(rows, ["anomaly_score", "severity_score"], 2.0, 0.0).withColumn("anomaly_score", F.round("anomaly_score", 6))

"""Queries: leaf-wise boosting on rolling features, whose target the columns do not define."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from emberlog.operators.boosting import DEPTH, LEAST_CURVATURE, LEAST_ROWS, LEAVES, NOISE
from emberlog.operators.classifier import WeakLabelClassifier
from emberlog.operators.evaluation import average_precision
from emberlog.operators.split import temporal_split
from emberlog.operators.windows import add_rolling_features
from emberlog.plans.queries_scan import FRAME
from emberlog.plans.queries_tables import TRAIN_SQL
from emberlog.plans.registry import log_table, query
from emberlog.session import materialize

#: The columns, and a count's bins: one for each value, the last for all from 254 on.
COLUMNS = ("total_count_5min", "error_count_1min", "error_count_15min", "hour")
EDGES = [np.arange(255.0)] * len(COLUMNS)


def rolling_rows(spark, d):
    rolled = add_rolling_features(log_table(spark, d))
    counts = [F.col(c).cast("double").alias(c) for c in COLUMNS[:3]]
    return materialize(rolled.select(
        "event_id", "timestamp", "node", "is_anomaly", *counts, F.hour("timestamp").cast("double").alias("hour"),
        F.col("is_anomaly").cast("int").alias("llm_label")), "rolling-rows")


_ERRORS = "CAST(sum(CAST(severity_score >= 2 AS INTEGER)) {frame} AS BIGINT)"
_SCALE = "pow(2, least(30, 52 - ceil(log2(greatest(count(*), 2)))))"


def first_tree_sql() -> str:
    """The first tree level by level: histograms, gains, the best split of every node; then the best-first order by pairs."""
    xs = [f"least(count(*) {FRAME.format(w=5)}, 254)", f"least({_ERRORS.format(frame=FRAME.format(w=1))}, 254)",
          f"least({_ERRORS.format(frame=FRAME.format(w=15))}, 254)", "hour(timestamp)"]
    parts = [f"WITH r AS (SELECT event_id AS id, CAST(is_anomaly AS INTEGER) AS y, {', '.join(f'{x} AS x{i}' for i, x in enumerate(xs))} FROM logs)",
             f"k AS (SELECT avg(y) AS p, {_SCALE} AS scale FROM r)",
             "gh AS (SELECT id, CAST(round((p - y) * scale) AS HUGEINT) AS g, CAST(round(p * (1 - p) * scale) AS HUGEINT) AS h, scale FROM r, k)",
             "l AS (" + " UNION ALL ".join(f"SELECT id, {i} AS f, x{i} AS v FROM r" for i in range(len(COLUMNS))) + ")",
             "n0 AS (SELECT id, CAST(1 AS BIGINT) AS node FROM r)"]
    for k in range(DEPTH):
        parts += [
            f"s{k} AS (SELECT node, f, v, sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h, count(*) AS n, any_value(scale) AS scale FROM n{k} JOIN l USING (id) JOIN gh USING (id) GROUP BY node, f, v)",
            f"c{k} AS (SELECT node, f, v, scale, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER p AS ga, sum(h) OVER p AS ha, sum(n) OVER p AS na FROM s{k}"
            " WINDOW w AS (PARTITION BY node, f ORDER BY v), p AS (PARTITION BY node, f))",
            f"q{k} AS (SELECT *, ga * ga / ha / scale AS own, (gl * gl / hl + CASE WHEN ha > hl THEN (ga - gl) * (ga - gl) / (ha - hl) ELSE 0 END - ga * ga / ha) / scale AS gain FROM c{k}"
            f" WHERE nl >= {LEAST_ROWS} AND na - nl >= {LEAST_ROWS} AND hl >= {LEAST_CURVATURE} * scale AND ha - hl >= {LEAST_CURVATURE} * scale)",
            f"b{k} AS (SELECT node, f, v, gain, na, nl FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, v) AS rk FROM q{k} WHERE gain > {NOISE} * (own + 1)) WHERE rk = 1)",
            f"n{k + 1} AS (SELECT id, node * 2 + CAST(l.v > b{k}.v AS INTEGER) AS node FROM n{k} JOIN b{k} USING (node) JOIN l USING (id, f))",
        ]
    parts += [
        "t AS (" + " UNION ALL ".join(f"SELECT *, {k} AS depth FROM b{k}" for k in range(DEPTH)) + ")",
        "a AS (SELECT t.node, o.node AS up, o.gain FROM t JOIN t o ON o.node = t.node >> (t.depth - o.depth) AND o.depth <= t.depth)",
        # what the queue still has to pass on the way to v once both v's and u's common way is split
        "w AS (SELECT u.node AS u, av.node AS v, min(av.gain) FILTER (au.up IS NULL) AS left_over FROM t u JOIN a av ON true LEFT JOIN a au ON au.node = u.node AND au.up = av.up GROUP BY 1, 2)",
        "o AS (SELECT x.u AS node, count(*) FILTER (x.u <> x.v AND (x.left_over IS NULL OR (z.left_over IS NOT NULL AND x.left_over > z.left_over))) + 1 AS split"
        " FROM w x JOIN w z ON z.u = x.v AND z.v = x.u GROUP BY 1)",
    ]
    return ",\n".join(parts)


_NAMES = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(COLUMNS)) + " END"
FIRST_TREE_SQL = first_tree_sql()


def _first_tree(spark, d):
    return WeakLabelClassifier(n_estimators=1).fit(rolling_rows(spark, d), COLUMNS, edges=EDGES)


@query("m8_first_tree", FIRST_TREE_SQL + f"""
SELECT CAST(split AS INTEGER) AS split, {_NAMES} AS feature, v::DOUBLE AS threshold, round(gain, 6) AS gain, CAST(na AS BIGINT) AS n_rows, CAST(nl AS BIGINT) AS n_left, depth
FROM t JOIN o USING (node) WHERE split < {LEAVES}""")
def m8_first_tree(spark, d):
    """Every split of the first tree, in the order in which the queue takes them."""
    return _first_tree(spark, d).tree_table(spark).drop("tree").withColumn("gain", F.round("gain", 6))


@query("m9_first_tree_importance", FIRST_TREE_SQL + f""", names AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(COLUMNS))}) n(f, feature))
SELECT feature, CAST(count(gain) AS DOUBLE) AS importance, round(coalesce(sum(gain), 0), 6) AS gain
FROM names LEFT JOIN (SELECT f, gain FROM t JOIN o USING (node) WHERE split < {LEAVES}) USING (f) GROUP BY feature""")
def m9_first_tree(spark, d):
    """Splits and gain by column, columns without a split included."""
    return _first_tree(spark, d).feature_importance(spark).withColumn("gain", F.round("gain", 6))


@query("m8_holdout", f"""WITH {TRAIN_SQL} SELECT count(*) AS n_rows, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies, TRUE AS within_leaves, TRUE AS better_than_chance
FROM pos WHERE rn > floor(total * 0.8)""")
def m8_holdout(spark, d):
    """The operator's 300 trees on the first part by time, scored on the last: leaf limit and average precision against the share of anomalies."""
    train, test = temporal_split(rolling_rows(spark, d))
    learner = WeakLabelClassifier().fit(train, COLUMNS)
    scored = materialize(learner.predict(test).select("is_anomaly", "anomaly_score"), "holdout-scores")
    most = max((t.leaves for t in learner.model.trees), default=1)
    totals = scored.agg(F.count("*").alias("n_rows"), F.count_if("is_anomaly").alias("n_anomalies"))
    return totals.select("n_rows", "n_anomalies", F.lit(most <= LEAVES).alias("within_leaves"),
                         (average_precision(scored).scalar() > F.col("n_anomalies") / F.col("n_rows")).alias("better_than_chance"))

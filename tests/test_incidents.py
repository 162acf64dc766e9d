from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.functions.filters import by_id, node_matches, require_rows
from emberlog.functions.responses import NO_CLIENT, parse_answers, render_prompt
from emberlog.operators import incidents as I
from emberlog.sources import requests

BASE = datetime(2005, 6, 3, 15)
EVENT = "event_id long, timestamp timestamp_ntz, node string, component string, content string, severity_score byte"
INCIDENT = "anomaly_id string, timestamp timestamp_ntz, node string, anomaly_score double"


def context(spark, events, at=BASE, **kw):
    ev = spark.createDataFrame(events, EVENT)
    inc = spark.createDataFrame([("A", at, "n1", 0.91234)], INCIDENT)
    return I.build_contexts(inc, ev, **kw).first()


def test_two_row_window(spark):
    c = context(spark, [(1, BASE, "n1", "KERNEL", "first", 2), (2, BASE + timedelta(seconds=1), "n2", "APP", None, 4)])
    assert (c["total_events"], c["error_count"], c["warning_count"], c["fatal_count"]) == (2, 2, 0, 1)
    assert c["error_rate"] == "100.0%" and c["avg_severity"] == 3.0
    assert c["components"] == "APP, KERNEL" and c["sample_messages"] == "  - first"


def test_empty_window(spark):
    c = context(spark, [(1, BASE + timedelta(minutes=6), "n1", "KERNEL", "late", 2), (2, None, "n1", "KERNEL", "never", 2)])
    assert (c["total_events"], c["error_rate"], c["avg_severity"], c["components"], c["sample_messages"]) == (0, "0.0%", 0.0, "", "")


def test_ties_top_five_and_window_ends(spark):
    events = [(i, BASE, "n1", f"C{i % 7}", f"m{i}", 1) for i in range(40)]
    events += [(100, BASE - timedelta(minutes=5), "n1", None, "edge", 0), (101, BASE + timedelta(minutes=5), "n1", "C6", "end", 0)]
    events += [(102, BASE - timedelta(minutes=5, microseconds=1), "n1", "C6", "out", 0)]
    c = context(spark, events)
    assert c["total_events"] == 42 and c["warning_count"] == 40
    assert c["components"] == "C0, C1, C2, C3, C4"
    assert c["sample_messages"].split("\n") == ["  - edge", "  - m0", "  - m1", "  - m2", "  - m3"]


GOOD = {"resumen": "r", "severidad": "HIGH", "causa_probable": "c", "accion_recomendada": "a"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (json.dumps(GOOD), GOOD),
        ("```json\n" + json.dumps(GOOD) + "\n```", GOOD),
        ("```\n" + json.dumps(GOOD), GOOD),
        ("Aquí:\n" + json.dumps(GOOD) + "\nfin", GOOD),
        ("not json", {"resumen": "not json", "severidad": "UNKNOWN", "causa_probable": "Could not parse LLM response",
                      "accion_recomendada": "Review logs manually"}),
        ('{"resumen": "corte \\"x\\" y", "severidad": "LOW", "causa_probable": "sin fin', {
            "resumen": 'corte \\"x\\" y', "severidad": "LOW", "causa_probable": "N/A", "accion_recomendada": "N/A"}),
        ('{"severidad": "LOW"}', {"resumen": "", "severidad": "LOW", "causa_probable": "", "accion_recomendada": ""}),
        ("x" * 400, {"resumen": "x" * 300, "severidad": "UNKNOWN", "causa_probable": "Could not parse LLM response",
                     "accion_recomendada": "Review logs manually"}),
        ("", {"resumen": "", "severidad": "UNKNOWN", "causa_probable": "Could not parse LLM response",
              "accion_recomendada": "Review logs manually"}),
    ],
)
def test_answers(spark, text, want):
    row = parse_answers(spark.createDataFrame([(text,)], "response string")).first().asDict()
    row.pop("response")
    assert row == want


def test_summaries_through_a_client(spark):
    ev = spark.createDataFrame([(1, BASE, "n1", "K", "boom", 4), (2, BASE + timedelta(hours=1), "n2", "K", "fine", 0)], EVENT)
    inc = spark.createDataFrame([("A", BASE, "n1", 0.9), ("B", BASE + timedelta(hours=1), "n2", 0.4)], INCIDENT)
    contexts = I.build_contexts(inc, ev)

    def factory():
        def client(prompt):
            if "nodo n2" in prompt:
                raise TimeoutError
            return json.dumps({**GOOD, "resumen": "score " + prompt.split("Anomaly score: ")[1].split("\n")[0]})

        return client

    rows = {r["anomaly_id"]: r for r in I.summarize(contexts, factory).collect()}
    assert rows["A"]["resumen"] == "score 0.9000" and rows["A"]["severidad"] == "HIGH"
    assert rows["B"]["resumen"] == NO_CLIENT["resumen"] and rows["B"]["severidad"] == "UNKNOWN"
    plain = I.summarize(contexts).first()
    assert plain["causa_probable"] == NO_CLIENT["causa_probable"] and plain["response_time_ms"] == 0.0


def test_prompt_has_every_field(spark):
    ev = spark.createDataFrame([(1, BASE, "n1", "K", "boom", 4)], EVENT)
    inc = spark.createDataFrame([("A", BASE, "n1", 0.12345)], INCIDENT)
    text = I.build_contexts(inc, ev).select(render_prompt(F.col("anomaly_score"))).first()[0]
    assert "nodo n1 a las 2005-06-03 15:00:00" in text and "- Errores: 1 (100.0% del total)" in text
    assert "  - boom" in text and f"Anomaly score: {0.12345:.4f}" in text


@pytest.fixture(scope="module")
def history(spark):
    rows = [("R02-M1-N0", "CRITICAL", 1, datetime(2005, 6, 3)), ("R02-M1-N0", "HIGH", 1, datetime(2005, 6, 4)),
            ("R23-M1-N8", "MEDIUM", 0, datetime(2005, 6, 5)), (None, "LOW", 0, datetime(2005, 6, 6))]
    return spark.createDataFrame(rows, "node string, severidad string, llm_label int, timestamp timestamp_ntz")


def test_node_history(history):
    r = I.node_history(history, "r02").first()
    assert (r["total"], r["critical"], r["high"], r["medium"]) == (2, 1, 1, 0)
    assert I.node_history(history, "R99").first()["total"] == 0
    assert I.node_history(history.drop("severidad"), "R02").columns == ["total"]
    assert I.node_history(history, "R02", days_back=2).first()["total"] == 1
    assert history.where(node_matches(F.col("node"), "r0[0-9]-m")).count() == 2


def test_top_latest_and_lookup(history):
    assert [(r["node"], r["n"]) for r in I.top_nodes(history).collect()] == [("R02-M1-N0", 2), ("R23-M1-N8", 1)]
    named = history.withColumn("anomaly_id", F.concat(F.lit("AN-"), F.dayofmonth("timestamp").cast("string")))
    assert [r["anomaly_id"] for r in I.latest(named, 2).collect()] == ["AN-6", "AN-5"]
    assert by_id(named, "AN-4").first()["severidad"] == "HIGH"
    assert by_id(named, "AN-9").count() == 0


def test_tickets(spark):
    inc = spark.createDataFrame([("A", "HIGH", "n1", "s" * 200), ("B", "LOW", "n2", "t")],
                                "anomaly_id string, severidad string, node string, resumen string")
    rows = {r["node"]: r for r in I.tickets(inc).collect()}
    assert rows["n1"]["assignee"] == "NOC-Team-1" and rows["n2"]["assignee"] == "NOC-Team-2"
    assert len(rows["n1"]["summary"]) == 120 and rows["n1"]["status"] == "OPEN"
    assert rows["n1"]["ticket_id"].startswith("INC") and len(rows["n1"]["ticket_id"]) == 11
    assert rows["n1"]["created"].endswith(" UTC")
    again = {r["node"]: r["ticket_id"] for r in I.tickets(inc.repartition(3)).collect()}
    assert again == {n: r["ticket_id"] for n, r in rows.items()}


def test_weak_label_encode(spark):
    df = spark.createDataFrame([(s,) for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW", "UNKNOWN")], "s string")
    assert [r[0] for r in df.select(S.weak_label(F.col("s"))).collect()] == [1, 1, 0, 0, None]


def test_message_prefix(spark):
    df = spark.createDataFrame([("n1", 0.98765, "t", "hola"), (None, None, None, "solo"), (None, 0.5, None, "x")],
                               "node string, score double, ts string, m string")
    got = [r[0] for r in df.select(S.context_prefix(F.col("node"), F.col("score"), F.col("ts"), F.col("m"))).collect()]
    assert got == ["[Contexto — nodo: n1, score: 0.988, timestamp: t]\n\nhola", "solo",
                   "[Contexto — nodo: N/A, score: 0.500, timestamp: N/A]\n\nx"]


@pytest.mark.parametrize(("x", "digits"), [(0.39135, 4), (2.675, 2), (0.125, 2), (0.375, 2), (-0.125, 2), (1e-9, 4), (0.05045, 4), (12.25, 1)])
def test_rounding_is_binary(spark, x, digits):
    got = spark.range(1).select(S.round_binary(F.lit(x), digits)).first()[0]
    assert got == round(x, digits)


def test_ladders(spark):
    scores = [0.9, 0.72, 0.6, 0.3, 0.29]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = df.select(S.ladder(F.col("s"), S.STREAM_SCALE), S.ladder(F.col("s"), S.ALERT_SCALE)).collect()
    assert [r[0] for r in got] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "LOW"]
    assert [r[1] for r in got] == ["CRITICAL", "CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_requests_defaults(spark, tmp_path):
    doc = {"request_id": "q", "logs": [{"timestamp": "2005-06-03T15:00:00", "node": "n1"},
                                       {"timestamp": "2005-06-03T15:00:01", "node": "n2", "level": "FATAL", "label": "X"}]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    rows = requests.explode_requests(requests.read_requests(spark, str(tmp_path))).orderBy("pos").collect()
    a, b = rows
    assert (a["level"], a["component"], a["content"], a["label"], a["window_minutes"]) == ("INFO", "UNKNOWN", "", "-", 5)
    assert (a["is_anomaly"], b["is_anomaly"], b["error_flag"], b["fatal_flag"], b["severity_score"]) == (False, True, 1, 1, 4)


def test_too_few_samples(spark):
    with pytest.raises(ValueError, match="need at least 100"):
        require_rows(spark.range(5), 100)

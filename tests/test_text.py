from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberlog.functions import scalars as S
from emberlog.functions.filters import in_time_range
from emberlog.operators.split import temporal_split
from emberlog.sources import text

LINES = [
    "- 1117838570 2005.06.03 R02-M1-N0 2005-06-03-15.42.50.363779 R02-M1-N0 RAS KERNEL INFO instruction cache parity error corrected",
    "- 1117838571 2005.06.03 R02-M1-N0 2005-06-03-15.42.51.000000 R02-M1-N0 RAS KERNEL WARNING memory corrected",
    "APPREAD 1117869872 2005.06.04 R23-M1-N8 2005-06-04-00.24.32.398284 R23-M1-N8 RAS APP FATAL ciod: failed to read",
]


@pytest.fixture()
def log_file(tmp_path):
    def write(lines, name="a.log", raw=None):
        folder = tmp_path / "logs"
        folder.mkdir(exist_ok=True)
        (folder / name).write_bytes(raw if raw is not None else ("\n".join(lines) + "\n").encode())
        return str(folder)

    return write


def test_three_lines(spark, log_file):
    df = text.load_logs(spark, log_file(LINES)).withColumn("severity_score", S.severity_score(F.col("level")))
    rows = text.chronological(df).collect()
    assert len(rows) == 3
    assert [r["is_anomaly"] for r in rows] == [False, False, True]
    assert rows[0]["timestamp"] == datetime(2005, 6, 3, 15, 42, 50, 363779)
    assert rows[2]["severity_score"] == 4 and rows[0]["severity_score"] == 0
    assert rows[2]["content"] == "ciod: failed to read"
    assert "datetime_str" not in df.columns and "node_repeat" not in df.columns


def test_edge_lines(spark, log_file):
    nine = " ".join(LINES[0].split(" ")[:9])
    lines = [
        "", "   ", " ".join(LINES[0].split(" ")[:8]) + "  ", nine, nine + "   ",
        "  " + LINES[1],
        LINES[2].replace("2005-06-04-00.24.32.398284", "garbled"),
        LINES[2].replace("2005-06-04-00.24.32.398284", "garbled").replace("2005.06.04", "x").replace("1117869872", "n/a"),
        LINES[0].replace("cache parity", "cache   parity") + "  ",
        " " + LINES[1].replace(" KERNEL", " \tKERNEL"),
    ]
    rows = text.load_logs(spark, log_file(lines)).collect()
    assert len(rows) == 7
    assert [r["content"] for r in rows[:2]] == ["", ""]
    assert rows[2]["label"] == "-"
    assert rows[3]["timestamp"] == datetime(2005, 6, 4)
    assert rows[4]["timestamp"] is None and rows[4]["timestamp_int"] is None
    assert rows[5]["content"] == "instruction cache   parity error corrected  "
    assert rows[6]["component"] == "KERNEL"


def test_bad_bytes_are_replaced(spark, log_file):
    raw = LINES[0].encode() + b" \xff\xfe end\n"
    row = text.load_logs(spark, log_file([], raw=raw)).first()
    assert row["content"].endswith("�� end")


def test_head_counts_physical_lines_across_files(spark, log_file):
    log_file(["", LINES[0], LINES[1]], "a.log")
    path = log_file([LINES[2], "short", LINES[0]], "b.log")
    assert text.load_logs(spark, path, nrows=2).count() == 1
    rows = text.load_logs(spark, path, nrows=5).collect()
    assert sorted(r["label"] for r in rows) == ["-", "-", "APPREAD"]
    assert text.load_sample(spark, path).count() == 4


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        text.load_logs(spark, str(tmp_path / "none")).count()


def test_split_order_and_range(spark, log_file):
    df = text.load_logs(spark, log_file(LINES)).withColumn("event_id", F.monotonically_increasing_id())
    train, test = temporal_split(df, 0.34)
    assert train.agg(F.max("timestamp")).first()[0] <= test.agg(F.min("timestamp")).first()[0]
    assert train.count() + test.count() == 3
    assert in_time_range(df, "2005-06-03 15:42:51", "2005-06-03 15:42:51").count() == 1
    assert in_time_range(df, None, None).count() == 3

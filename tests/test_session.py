"""The scratch folder, with and without a setting for it."""

from __future__ import annotations

import pytest

from emberlog import session


class Session:
    def __init__(self, master, setting=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)})()


def test_the_setting_decides():
    assert session.checkpoint_root(Session("spark://host:7077", "hdfs:///scratch")) == "hdfs:///scratch"
    assert session.scratch_path(Session("local[2]", "file:///scratch/"), "x").startswith("file:///scratch/x-")


def test_a_local_application_keeps_one_folder_and_a_cluster_needs_the_setting():
    local = Session("local[2]")
    assert session.checkpoint_root(local) == session.checkpoint_root(local)
    with pytest.raises(ValueError):
        session.checkpoint_root(Session("spark://host:7077"))


def test_a_session_without_the_setting_writes(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert session.checkpoint_root(spark) and spark.conf.get("spark.checkpoint.dir", None) == before
    assert session.materialize(spark.range(3), "three").count() == 3

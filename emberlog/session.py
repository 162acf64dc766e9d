"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(cores: str = "*", partitions: int = 8, app: str = "emberlog") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("EMBERLOG_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the tasks of a cluster that doesn't have it installed; once per application."""
    context = spark.sparkContext
    if getattr(context, "_emberlog_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="emberlog-ship-"), "emberlog.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("emberlog", os.path.relpath(path, home)))
    context.addPyFile(archive)
    context._emberlog_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) is a fresh local
    folder created, and remembered with the application: the setting itself
    can't be changed while it runs.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_emberlog_scratch", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = context._emberlog_scratch = tempfile.mkdtemp(prefix="emberlog-")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused between calls."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, *keys, most: int | None = None):
    """Hash rows by key over all shuffle partitions.

    For Python work that is heavy per byte: the runtime would otherwise merge
    small partitions into a few tasks and leave cores idle. ``most`` is a known
    number of keys.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(n, most or n)), *keys)


def materialize(df, name: str):
    """Cut a long lineage by writing to the shared folder and reading back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

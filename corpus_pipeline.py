"""A corpus from raw documents: toxicity, near copies, benchmark passages, source mix, shards.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberlog.llm import decontaminate, mixing, nearcopies, sharding
from emberlog.llm import toxicity as tox
from emberlog.llm.tables import table
from emberlog.session import materialize, ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model learns from the labels' training folds."""
    ship_package(spark)
    return tox.clean(docs, tox.fit(docs, tox.training_labels(table(spark, sf_dir, "labels"))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity 0.8) stays."""
    ship_package(spark)
    return nearcopies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage (similarity 0.8) go."""
    ship_package(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the target weights of their source ask for."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near-equal bytes."""
    ship_package(spark)
    return sharding.assign_shards(docs)


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("decontamination", decontamination), ("mix", mix), ("shards", shards)]
# No SQL: a trained model decides the first stage; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

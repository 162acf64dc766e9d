"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join; the
edges never meet in one task. Steps are cut by tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.session import materialize


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v, component`` (the smallest vertex reachable) for every vertex that has an edge ``a, b`` to another one."""
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = materialize(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    stars = now.select(F.col("a").alias("v"), F.col("b").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("v"), "component")).distinct()

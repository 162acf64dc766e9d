"""Exact ranks in groups of any size, without one task per group.

Rows get a hash; a group of n rows is cut by leading hash bits into about
sqrt(n) cells of about sqrt(n) rows. Totals of the cells before a row's cell and
a window inside the cell give the rank, so no window grows faster than sqrt(n),
whatever the skew. Rows of equal hash (rows equal in all that was hashed) are
interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cell_of(hash_: Column, group_rows: Column) -> Column:
    """Cell number from the leading bits of a hash, about sqrt(rows) cells a group."""
    bits = F.least(F.lit(24), F.ceil(F.log2(F.greatest(group_rows, F.lit(1)).cast("double")) / 2)).cast("int")
    return F.when(bits < 1, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", hash_, F.lit(64) - bits))


def ranked(rows: DataFrame, group: Sequence[str], cell: str, order: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Add ``position`` (from 0) in the group and, for each of ``sums``, ``<c>_before``: its total over the rows before.

    ``cell`` comes from ``cell_of``; ``order`` starts with the hash, so cells follow each other in hash order.
    """
    group = list(group)
    totals = rows.groupBy(*group, cell).agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_{c}") for c in sums])
    before = W.partitionBy(*group).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    names = ["_n", *[f"_{c}" for c in sums]]
    offsets = totals.select(*group, cell, *[F.coalesce(F.sum(n).over(before), zero).alias(f"{n}_off") for n in names])
    inside = W.partitionBy(*group, cell).orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = rows.select("*", F.row_number().over(inside).alias("_rn"), *[F.sum(c).over(upto).alias(f"{c}_upto") for c in sums])
    return inner.join(offsets, [*group, cell]).select(
        *rows.columns, (F.col("_n_off") + F.col("_rn") - 1).alias("position"),
        *[(F.col(f"_{c}_off") + F.col(f"{c}_upto") - F.col(c)).alias(f"{c}_before") for c in sums],
    )

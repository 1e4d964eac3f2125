"""Positions in an order of any length, without sending a whole group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mergelens.session import cut_lineage


def numbered(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` with the 0-based position of each row inside its group.

    Rows are dealt by ranges of (groups, order), numbered in their range, and moved by the counts
    of the ranges before. The ranges are written once, since a second sampling could cut elsewhere.
    Rows equal in groups and order get different positions in any order. An empty table stays empty.
    """
    keys = [F.col(g).asc_nulls_first() for g in groups]
    ranged = cut_lineage(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range", *groups)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    inside = Window.partitionBy("_range", *groups).orderBy(*order)
    rows = ranged.withColumn("_row", F.row_number().over(inside)).alias("r")
    same = F.col("r._range") == F.col("s._range")
    for group in groups:
        same = same & F.col(f"r.{group}").eqNullSafe(F.col(f"s.{group}"))
    kept = [F.col(f"r.{c}") for c in df.columns]
    position = (F.col("r._row") - 1 + F.col("s._shift")).cast("long").alias(name)
    return rows.join(shifts.alias("s"), same).select(*kept, position)

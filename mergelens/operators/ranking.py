"""Positions and first-N within groups that stay balanced when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergelens.session import cut_lineage

# Spark prunes each map task to the first n rows of a group for limits up to this setting.
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _allow_group_limit(spark: SparkSession, n: int) -> None:
    if int(spark.conf.get(_GROUP_LIMIT, "1000")) < n:
        spark.conf.set(_GROUP_LIMIT, str(n))


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows per group, numbered from 1 in ``rank`` (a bigint).

    For any ``n`` map tasks send no more than n rows of a group; pass narrow rows and join the
    wide ones to the result.
    """
    _allow_group_limit(df.sparkSession, n)
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return kept.withColumn(rank, F.col(rank).cast("bigint"))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_n(df, keys, order, 1, "_rank").drop("_rank")


def row_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Number the rows of each group from 1; ``order`` must be total within a group.

    Rows are split by range of (group, order), each range is numbered on its own, and the counts
    of earlier ranges of the group are added, so a group of any size is spread over tasks. The
    split is checkpointed, so that counts and rows see the same ranges; pass narrow rows.
    """
    keys = list(keys)
    ranged = cut_lineage(
        df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_range").alias("_r"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    numbered = ranged.withColumn("_within", F.row_number().over(within))
    same = F.col("_range") == F.col("_r")
    for i, key in enumerate(keys):
        same &= F.col(key).eqNullSafe(F.col(f"_k{i}"))
    return numbered.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_within")).cast("bigint").alias(rank)
    )

"""Group limits and positions, with a group that holds most rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mergelens.operators.ranking import first_n, first_row, row_positions
from tests.conftest import plan_text, rows


@pytest.fixture(scope="module")
def skewed(spark):
    return (
        spark.range(30_000)
        .select(
            F.when(F.col("id") % 3 != 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
            .alias("g"),
            F.xxhash64("id").alias("o"),
            "id",
        )
        .repartition(8)
    )


def test_positions_equal_a_window(skewed):
    order = [F.col("o").desc(), F.col("id").asc()]
    window = Window.partitionBy("g").orderBy(*order)
    plain = skewed.withColumn("rank", F.row_number().over(window).cast("bigint"))
    split = row_positions(skewed, ["g"], order)
    assert split.schema == plain.schema or split.dtypes == plain.dtypes
    assert rows(plain) == rows(split)


def test_positions_spread_the_hot_group(spark, skewed):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        split = row_positions(skewed, ["g"], [F.col("o").asc()])
        sizes = split.filter("g = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(coalesce, "true")
    assert len(sizes) > 2


def test_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "g string, o int")
    assert rows(row_positions(df, ["g"], [F.col("o").asc()])) == [("a", 1, 1), (None, 1, 1), (None, 2, 2)]


def test_rank_has_one_type(skewed):
    order = [F.col("o").asc()]
    for ranked in (first_n(skewed, ["g"], order, 3), first_n(skewed, ["g"], order, 100_000), row_positions(skewed, ["g"], order)):
        assert dict(ranked.dtypes)["rank"] == "bigint"


def test_first_n_prunes_before_the_shuffle(skewed):
    limited = first_n(skewed, ["g"], [F.col("o").asc()], 3)
    assert "WindowGroupLimit" in plan_text(limited)
    assert limited.groupBy("g").count().agg(F.max("count")).first()[0] == 3


def test_large_n_prunes_too(skewed):
    few = first_n(skewed, ["g"], [F.col("o").asc()], 1500)
    assert "WindowGroupLimit" in plan_text(few)
    exact = skewed.groupBy("g").count().select(F.least("count", F.lit(1500)).alias("n"))
    assert few.count() == exact.agg(F.sum("n")).first()[0]


def test_first_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "g string, o int, v string")
    assert rows(first_row(df, ["g"], [F.col("o").asc()])) == [("a", 1, "y"), ("b", 5, "z")]

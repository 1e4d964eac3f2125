"""Sketches against exact counts, with few and many values, even and skewed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mergelens.operators import sketches as K
from mergelens.operators import stats
from tests.conftest import plan_text, rows


def test_distinct_counts_over_saves_are_near_the_exact_ones(spark):
    ids = spark.range(60_000).select(
        (F.col("id") % 6).alias("file"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 20)).alias("repository_name"),
        F.when(F.col("id") % 50 != 0, (F.col("id") % 25_000).cast("string")).alias("id"),
    )
    held = K.distinct_sketches(ids, ["file", "repository_name"])
    exact = {r.repository_name: (r.rows, r.n) for r in ids.groupBy("repository_name").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("n")).collect()}
    got = {r.repository_name: (r.rows, r.distinct) for r in K.distinct_counts(held, ["repository_name"]).collect()}
    assert got.keys() == exact.keys()
    for name, (count, distinct) in exact.items():
        assert got[name][0] == count
        assert abs(got[name][1] - distinct) <= 0.025 * distinct
    total = K.distinct_counts(held).first()
    assert (total.rows, abs(total.distinct - ids.agg(F.count_distinct("id")).first()[0]) <= 0.025 * 25_000) == (60_000, True)


def test_no_rows_have_no_distinct_values(spark):
    none = spark.createDataFrame([], "file string, id string")
    held = K.distinct_sketches(none, ["file"])
    assert rows(K.distinct_counts(held)) == [(0, 0)]
    nulls = K.distinct_sketches(spark.createDataFrame([("a", None)], "file string, id string"), ["file"])
    assert rows(K.distinct_counts(nulls)) == [(1, 0)]


AUTHORS = {
    # Few values, ties at the end, nulls.
    "few": lambda i: F.when(i % 7 == 0, None).otherwise(F.concat(F.lit("a"), i % 40)),
    # A heavy head before far more values than the sketch tracks.
    "skewed": lambda i: F.when(i % 3 == 0, F.concat(F.lit("h"), i % 33)).otherwise(F.concat(F.lit("v"), i)),
    # More values than the sketch tracks, all about as frequent: the plain count decides.
    "flat": lambda i: F.concat(F.lit("v"), i % 40_000),
}


@pytest.mark.parametrize("kind", sorted(AUTHORS))
def test_top_of_sketches_is_exact(spark, kind):
    records = spark.range(200_000).select(
        (F.col("id") % 5).alias("file"), AUTHORS[kind](F.col("id")).cast("string").alias("author")
    )
    held = K.frequent_sketches(records, ["file"])
    assert held.agg(F.sum("rows")).first()[0] == 200_000
    got = K.top_of_sketches(held, records, 10)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in stats.top_authors(records).collect()]
    # The plan of the plain count is left only where the sketch cannot decide.
    assert ("Aggregate" in plan_text(got)) == (kind == "flat")


def test_top_of_no_rows(spark):
    none = spark.createDataFrame([], "file string, author string")
    assert K.top_of_sketches(K.frequent_sketches(none, ["file"]), none, 10).collect() == []

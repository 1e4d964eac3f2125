from __future__ import annotations

from pyspark.sql import functions as F

from mergelens.llm.samples import hash_share


def test_few_rows_are_all_kept_and_many_are_bounded(spark):
    few, many = spark.range(50), spark.range(40_000)
    assert hash_share(few, F.xxhash64("id"), 50, 100).count() == 50
    kept = hash_share(many, F.xxhash64("id"), 40_000, 500)
    assert 1700 < kept.count() < 2300
    again = hash_share(many.repartition(7), F.xxhash64("id"), 40_000, 500)
    assert kept.exceptAll(again).isEmpty()
    assert hash_share(many.limit(0), F.xxhash64("id"), 0, 500).count() == 0

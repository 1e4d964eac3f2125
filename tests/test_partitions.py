"""Results do not depend on the number of partitions."""

from __future__ import annotations

import pytest

from mergelens.plans.queries import QUERIES
from tests.conftest import SF_SMALL, rows

SETTING = "spark.sql.shuffle.partitions"


@pytest.mark.parametrize(
    "name", ["change_type", "commit_map", "snapshot_history", "batch_assign", "similarity", "totals"]
)
def test_partition_count(spark, name):
    before = spark.conf.get(SETTING)
    results = []
    try:
        for count in ("1", "13"):
            spark.conf.set(SETTING, count)
            results.append(rows(QUERIES[name](spark, SF_SMALL)))
    finally:
        spark.conf.set(SETTING, before)
    assert results[0] == results[1]

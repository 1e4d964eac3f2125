"""The bucketed merge state: equal to the merge of all, one exchange, replays, versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mergelens.operators.merge_state import fold_merge, merge_pair, merged_records
from mergelens.sources.bucketed_state import BucketedState
from mergelens.sources.state_table import VersionConflict
from tests.conftest import plan_text, rows
from tests.test_state_table import COLUMNS, MERGE, full, history, state_of


def current(held, version=None):
    return rows(merged_records(held.read(version), COLUMNS, MERGE))


@pytest.mark.parametrize("seed", range(2))
def test_merges_in_any_order_equal_the_merge_of_all(spark, tmp_path, seed):
    some = history(seed)
    shuffled = random.Random(seed).sample(some, len(some))
    held = BucketedState(spark, str(tmp_path / "s"), MERGE, buckets=5)
    for batch, start in enumerate(range(0, 300, 100)):
        assert held.merge(state_of(spark, shuffled[start : start + 100]), "s", batch) == batch + 1
    assert held.merge(state_of(spark, shuffled[200:]), "s", 2) == 3
    assert current(held) == full(spark, some)
    assert current(held, 1) == full(spark, shuffled[:100])
    # A new reader knows the table from its manifest alone.
    assert current(BucketedState(spark, str(tmp_path / "s"), MERGE)) == full(spark, some)


def test_merge_moves_the_new_rows_only(spark, tmp_path):
    held = BucketedState(spark, str(tmp_path / "s"), MERGE, buckets=5)
    held.merge(state_of(spark, history(1)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = held.merged(state_of(spark, history(2)))
        assert plan_text(merged).count("Exchange") == 1
        merged.collect()
        plan = plan_text(merged)
        final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
        assert final.count("Exchange") == 1
        assert final.index("Exchange") > final.index("SortMergeJoin")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pair_equals_fold(spark):
    one, two = history(3), history(4)
    old, new = (fold_merge(state_of(spark, part), MERGE) for part in (one, two))
    pair = merged_records(merge_pair(old, new, MERGE), COLUMNS, MERGE)
    both = merged_records(fold_merge(old.unionByName(new), MERGE), COLUMNS, MERGE)
    keyed = lambda df: rows(df.select("repository_name", "id", "mtime", "commits", "pr_comments", "files"))
    assert keyed(pair.drop("snap")) == keyed(both.drop("snap"))


def test_killed_and_competing_merges(spark, tmp_path, monkeypatch):
    held = BucketedState(spark, str(tmp_path / "s"), MERGE, buckets=3)
    with pytest.raises(ValueError, match="no version"):
        held.read()
    held.merge(state_of(spark, history(5)[:150]))
    before = current(held)
    monkeypatch.setattr(held.folder, "create", lambda name, text: False)
    with pytest.raises(VersionConflict):
        held.merge(state_of(spark, history(5)[150:]))
    monkeypatch.undo()
    assert held.version() == 1 and current(held) == before
    assert held.merge(state_of(spark, history(5)[150:])) == 2
    assert current(held) == full(spark, history(5))


def test_empty_batches(spark, tmp_path):
    held = BucketedState(spark, str(tmp_path / "s"), MERGE, buckets=3)
    assert held.merge(state_of(spark, [])) == 1
    assert current(held) == []
    assert held.merge(state_of(spark, history(1))) == 2
    assert held.merge(state_of(spark, [])) == 3
    assert current(held) == full(spark, history(1))
    assert held.read().agg(F.count("*")).first()[0] == len(full(spark, history(1)))


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("mergelens.sources.bucketed_state.BUCKET_ROWS", 20)
    held, some = BucketedState(spark, str(tmp_path / "s"), MERGE, buckets=2), history(6)
    sizes = []
    for start in range(0, 300, 100):
        held.merge(state_of(spark, some[start : start + 100]))
        sizes.append(held._manifest(held.version())["buckets"])
        counts = held.read().groupBy(F.input_file_name().alias("file")).count().collect()
        assert max(r["count"] for r in counts) <= 40
    assert sizes[0] >= 4 and sizes == sorted(sizes) and sizes[-1] > sizes[0]
    assert current(held) == full(spark, some)
    assert current(held, 1) == full(spark, some[:100])

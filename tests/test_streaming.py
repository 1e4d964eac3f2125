"""Streams: replay, late files, state, equality with batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from mergelens.operators import snapshots as S
from mergelens.streaming import ingest
from tests.conftest import rows

SCHEMA = (
    "repository_name string, id string, mtime int, file string, pos int, has_commits boolean, "
    "has_comments boolean, has_files boolean, timestamp string"
)
FILES = [
    [("r", "1", 20, "b", 0, True, False, False, "t2"),
     ("r", "2", 20, "b", 1, True, True, False, "t2")],
    # Arrives later, but is older.
    [("r", "1", 10, "a", 0, False, True, False, "t1"),
     ("r", "3", 10, "a", 1, False, False, True, "t1")],
    [("r", "1", 30, "c", 0, False, False, True, "t3"),
     ("r", "1", 30, "c", 1, True, True, True, "t3")],
]


@pytest.fixture
def landing(spark, tmp_path):
    def land(number):
        frame = spark.createDataFrame(FILES[number], SCHEMA).coalesce(1)
        frame.write.parquet(str(tmp_path / "landing" / f"f{number}"))

    def stream():
        return ingest.read_result_stream(
            spark, str(tmp_path / "landing"), SCHEMA, files_per_trigger=1)

    return land, stream, str(tmp_path / "target"), str(tmp_path / "checkpoint")


def _all(spark):
    return spark.createDataFrame([r for file in FILES for r in file], SCHEMA)


def test_ingest_resumes_and_equals_batch(spark, landing):
    land, stream, target, checkpoint = landing
    for number in range(3):
        land(number)
        ingest.run_to_end(ingest.start_ingest(stream(), target, checkpoint))
        # A second run finds nothing new.
        ingest.run_to_end(ingest.start_ingest(stream(), target, checkpoint))
    current = ingest.current_records(spark, target)
    assert rows(current) == rows(S.latest_records(_all(spark)))
    assert {r.id: r.mtime for r in current.collect()} == {"1": 30, "2": 20, "3": 10}


def test_replayed_batch_changes_nothing(spark, landing, tmp_path):
    land, stream, target, checkpoint = landing
    for number in range(3):
        land(number)
    ingest.run_to_end(ingest.start_ingest(stream(), target, checkpoint))
    before = rows(ingest.current_records(spark, target))
    # A fresh checkpoint delivers every file again to the same target.
    ingest.run_to_end(ingest.start_ingest(stream(), target, str(tmp_path / "again")))
    assert rows(ingest.current_records(spark, target)) == before


def test_state_equals_batch_fold(spark, landing):
    land, stream, target, checkpoint = landing
    for number in range(3):
        land(number)
        ingest.run_to_end(ingest.start_state(stream(), target, checkpoint))
    assert rows(ingest.current_state(spark, target)) == rows(S.fold_state(_all(spark)))


def test_compaction_keeps_the_view(spark, landing, tmp_path):
    land, stream, target, checkpoint = landing
    for number in range(3):
        land(number)
    ingest.run_to_end(ingest.start_append(stream(), target, checkpoint))
    compacted = str(tmp_path / "compacted")

    def view(df):
        return S.latest_records(df)

    ingest.compact_batches(spark, target, compacted, view)
    assert rows(ingest.current_records(spark, compacted)) == rows(
        ingest.current_records(spark, target))


def test_memory_of_repeats_stays_flat(spark, tmp_path):
    """Every record comes again a step later; ids are forgotten once the span has passed."""
    start = datetime(2024, 1, 1)
    for step in range(20):
        made = [(f"{s}-{i}", start + timedelta(hours=s)) for s in (step, step - 1) if s >= 0 for i in range(50)]
        spark.createDataFrame(made, "id string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"{step:02d}"))
    stream = ingest.read_result_stream(spark, str(tmp_path / "in"), "id string, ts timestamp", files_per_trigger=1)
    once = ingest.without_repeats(stream, ["id"], "ts", "3 hours")
    query = ingest.start_append(once, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    ingest.run_to_end(query)
    got = ingest.read_batches(spark, str(tmp_path / "out"))
    assert (got.count(), got.select("id").distinct().count()) == (1_000, 1_000)
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(held) >= 20
    # The span before and after the watermark, and the steps it is behind.
    assert max(held) <= 8 * 50

"""Versions, killed changes, replays, conflicts, expiry and the ledger of files."""

from __future__ import annotations

import os
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from mergelens.operators import snapshots as S
from mergelens.operators.merge_state import Merge, fold_merge, merge_state, merged_records
from mergelens.sources import state_table
from mergelens.sources.state_table import StateTable, VersionConflict
from mergelens.streaming import ingest
from tests.conftest import rows

SCHEMA = (
    "repository_name string, id string, mtime int, snap int, commits array<int>, "
    "pr_comments array<int>, files array<int>, change_type string, confidence double"
)
MERGE = Merge(kept={"change_type": ("confidence",)})
COLUMNS = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def history(seed, count=300, keys=40):
    draw = random.Random(seed)
    items = lambda: draw.choice([None, [], [], [draw.randrange(9)], [1, 2, 3]])
    return [
        (
            draw.choice(["r", "r", "r", "s", None]), draw.choice([str(draw.randrange(keys)), None]) if i % 50 == 0 else str(draw.randrange(keys)),
            draw.randrange(50), i, items(), items(), items(), draw.choice([None, "", "fix", "doc"]), draw.choice([None, 0.5, 0.9]),
        )
        for i in range(count)
    ]


def table(spark, root, buckets=8):
    return StateTable(spark, str(root), S.KEY, partial(fold_merge, merge=MERGE), buckets)


def state_of(spark, some):
    return merge_state(spark.createDataFrame(some, SCHEMA), F.struct("mtime", "snap"), MERGE)


def full(spark, some):
    return rows(S.merge_history(spark.createDataFrame(some, SCHEMA), F.struct("mtime", "snap"), kept={"change_type": ("confidence",)}))


def current(held, version=None):
    return rows(merged_records(held.read(version), COLUMNS, MERGE))


@pytest.mark.parametrize("seed", range(3))
def test_folding_in_any_groups_equals_the_merge_of_all(spark, tmp_path, seed):
    """Batches come in any order, so late ones hold older content."""
    some = history(seed)
    held = table(spark, tmp_path / "t")
    draw = random.Random(seed)
    shuffled = draw.sample(some, len(some))
    for start in range(0, len(some), 60):
        held.upsert(state_of(spark, shuffled[start : start + 60]))
    assert current(held) == full(spark, some)
    held.upsert(state_of(spark, shuffled[:70]))
    assert current(held) == full(spark, some)
    assert held.versions() == list(range(1, 7))
    assert current(held, 2) == full(spark, shuffled[:120])


def test_killed_change_leaves_the_version_before(spark, tmp_path, monkeypatch):
    some = history(5)
    held = table(spark, tmp_path / "t")
    held.upsert(state_of(spark, some[:100]), "s", 0)
    before = current(held)

    def killed(self, name, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(state_table.Folder, "create", killed)
        held.upsert(state_of(spark, some[100:]), "s", 1)
    assert held.versions() == [1]
    assert current(table(spark, tmp_path / "t")) == before
    # The batch comes again, twice; the second time it is left out.
    assert held.upsert(state_of(spark, some[100:]), "s", 1) == 2
    assert held.upsert(state_of(spark, some[:5]), "s", 1) == 2
    assert current(held) == full(spark, some)
    held.expire(1)
    assert held.versions() == [2]
    assert len(held.folder.names("data")) == len({p.split("/")[1] for p in held.manifest().buckets.values()})
    assert current(held) == full(spark, some)


def test_reader_stays_on_its_version_and_only_touched_buckets_are_written(spark, tmp_path):
    some = [r for r in history(6) if r[0] and r[1]]
    held = table(spark, tmp_path / "t", buckets=16)
    held.upsert(state_of(spark, some))
    reader = held.read()
    before = rows(reader)
    held.upsert(state_of(spark, [some[0][:2] + (99, 999, [7], None, None, "late", 1.0)]))
    assert rows(reader) == before
    one, two = held.manifest(1).buckets, held.manifest(2).buckets
    assert sum(one[b] != two[b] for b in one) == 1


def test_second_writer_of_a_version_gives_up(spark, tmp_path, monkeypatch):
    held, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    held.upsert(state_of(spark, history(1)[:50]))
    seen = other.manifest()
    held.upsert(state_of(spark, history(1)[50:100]))
    monkeypatch.setattr(other, "manifest", lambda version=None: seen)
    with pytest.raises(VersionConflict):
        other.upsert(state_of(spark, history(1)[100:]))
    assert held.versions() == [1, 2]
    assert current(held) == full(spark, history(1)[:100])


def test_stream_folds_each_batch_once(spark, tmp_path):
    some = history(8)
    landing = tmp_path / "landing"
    for start in range(0, 300, 100):
        spark.createDataFrame(some[start : start + 100], SCHEMA).coalesce(1).write.parquet(str(landing / str(start)))
    held = table(spark, tmp_path / "t")
    for _ in range(2):
        stream = ingest.read_result_stream(spark, str(landing), SCHEMA, files_per_trigger=1)
        ingest.run_to_end(
            held.upsert_stream(stream, str(tmp_path / "checkpoint"), lambda df: merge_state(df, F.struct("mtime", "snap"), MERGE))
        )
        assert held.versions() == [1, 2, 3]
    assert current(held) == full(spark, some)


def test_ledger_reads_new_and_replaced_files_only(spark, tmp_path):
    some = history(9)
    folder = tmp_path / "files"
    folder.mkdir()
    held = table(spark, tmp_path / "t")
    opened = []

    def read(paths):
        opened.extend(paths)
        return merge_state(spark.read.schema(SCHEMA).json(paths), F.struct("mtime", "snap"), MERGE)

    def land(name, part):
        frame = spark.createDataFrame(part, SCHEMA).toJSON().collect()
        (folder / name).write_text("\n".join(frame))

    def run(group=2):
        opened.clear()
        return held.ingest_files(f"file:{folder}", read, "*.json", group), len(opened)

    for i in range(5):
        land(f"a{i} [x].json", some[40 * i : 40 * i + 40])
    assert run() == (5, 5)
    assert held.versions() == [1, 2, 3]
    assert run() == (0, 0)
    assert held.versions() == [1, 2, 3]
    land("a1 [x].json", some[40:80] + some[200:210])
    land("b.json", some[210:300])
    os.utime(folder / "b.json", (1, 1))
    assert run() == (2, 2)
    assert current(held) == full(spark, some)
    assert run() == (0, 0)
    # The same bytes at another time are another file.
    os.utime(folder / "b.json", (2, 2))
    assert run() == (1, 1)
    assert current(held) == full(spark, some)


def test_failed_group_is_read_by_the_next_run(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    some = history(2)
    for i in range(4):
        part = spark.createDataFrame(some[i * 50 : i * 50 + 50], SCHEMA).toJSON().collect()
        (folder / f"{i}.json").write_text("\n".join(part))
    held = table(spark, tmp_path / "t")
    opened = []

    def read(paths):
        opened.append(len(paths))
        if len(opened) == 2:
            raise OSError("lost")
        return merge_state(spark.read.schema(SCHEMA).json(paths), F.struct("mtime", "snap"), MERGE)

    with pytest.raises(OSError, match="lost"):
        held.ingest_files(str(folder), read, group=1)
    assert held.versions() == [1]
    assert held.ingest_files(str(folder), read, group=1) == 3
    assert current(held) == full(spark, some[:200])


def test_empty_table_and_batches(spark, tmp_path):
    held = table(spark, tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        held.read()
    with pytest.raises(ValueError, match="no version 3"):
        held.manifest(3)
    assert held.ledger().count() == 0
    assert held.upsert(state_of(spark, []), "s", 0) == 1
    assert current(held) == []
    assert held.upsert(state_of(spark, history(1)), "s", 1) == 2
    assert held.upsert(state_of(spark, []), "s", 2) == 3
    assert current(held) == full(spark, history(1))

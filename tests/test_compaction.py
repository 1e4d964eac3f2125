"""Planned compaction: what it rewrites, what it leaves, equal rows, versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mergelens.sources.compaction import FileSet
from mergelens.sources.state_table import VersionConflict
from tests.conftest import rows

SCHEMA = "id string, repository_name string, body string"


def save(spark, seed, names=("r", "s/t [x]", "ü %2F", None), count=40):
    draw = random.Random(seed)
    return spark.createDataFrame([(f"{seed}-{i}", draw.choice(names), "x" * draw.randrange(50)) for i in range(count)], SCHEMA)


def test_small_files_of_a_repository_are_packed_and_others_stay(spark, tmp_path):
    held = FileSet(spark, str(tmp_path / "set"))
    for seed in range(6):
        held.add(save(spark, seed))
    large = "".join(random.Random(0).choice("abcdefghijklmnop") for _ in range(60_000))
    held.add(spark.createDataFrame([("big", "r", large)], SCHEMA))
    before, files = rows(held.read()), {r.path: (r.owner, r.bytes) for r in held.files().collect()}
    planned = {r.path: (r.owner, r.bin) for r in held.plan(20_000).collect()}
    assert held.version() == 7 and len(planned) > 10
    assert all(files[p][1] * 2 < 20_000 for p in planned)
    sizes = {}
    for path, key in planned.items():
        sizes.setdefault(key, []).append(files[path][1])
    assert all(len(s) > 1 and sum(s) <= 30_000 for s in sizes.values())
    assert held.compact(20_000) == 8
    after = {r.path: (r.owner, r.bytes) for r in held.files().collect()}
    assert rows(held.read()) == before
    assert set(files) - set(planned) == set(files) & set(after)
    assert len(after) < len(files)
    assert sorted(o for o, _ in after.values() if o is not None) == sorted(o for o, _ in after.values() if o)
    assert rows(held.read(7)) == before
    # There is nothing left to pack.
    assert held.compact(20_000) == 8
    held.add(save(spark, 9))
    assert rows(held.read()) == sorted(before + rows(save(spark, 9)), key=repr)


def test_each_file_has_one_repository(spark, tmp_path):
    held = FileSet(spark, str(tmp_path / "set"))
    for seed in range(4):
        held.add(save(spark, seed))
    held.compact()
    owners = held.read().groupBy(F.col("_metadata.file_path")).agg(F.count_distinct(F.coalesce("repository_name", F.lit("-"))).alias("n"))
    assert owners.agg(F.max("n")).first()[0] == 1


def test_killed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    held = FileSet(spark, str(tmp_path / "set"))
    for seed in range(3):
        held.add(save(spark, seed))
    before = rows(held.read())
    monkeypatch.setattr(held.folder, "create", lambda name, text: False)
    with pytest.raises(VersionConflict):
        held.compact()
    monkeypatch.undo()
    assert held.version() == 3 and rows(held.read()) == before
    assert held.compact() == 4
    assert rows(held.read()) == before


def test_empty_set_and_saves(spark, tmp_path):
    held = FileSet(spark, str(tmp_path / "set"))
    with pytest.raises(ValueError, match="no version"):
        held.read()
    assert held.compact() == 0
    assert held.add(save(spark, 1).limit(0)) == 1
    assert held.read().collect() == []
    assert held.compact() == 1

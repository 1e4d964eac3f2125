"""Saves, envelopes per batch, CSV, metadata."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F

from mergelens.config import ExtractionConfig
from mergelens.functions import text as X
from mergelens.operators import stats
from mergelens.operators.assemble import assemble
from mergelens.plans.fixtures import PR, Fixtures
from mergelens.schemas import CSV_COLUMNS, PULL_REQUEST_FIELDS
from mergelens.sources import envelopes as E
from mergelens.sources import writers as W
from tests.conftest import SF_SMALL, plan_text, rows


@pytest.fixture(scope="module")
def nested(spark, tmp_path_factory):
    fx = Fixtures(spark, SF_SMALL)
    df = assemble(fx.pull_requests(), fx.repositories, fx.commits, fx.comments,
                  fx.files(patch_limit=X.PATCH_LIMIT), key=PR)
    path = str(tmp_path_factory.mktemp("nested") / "records")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_record_has_the_24_fields(nested):
    assert nested.columns == list(PULL_REQUEST_FIELDS)
    assert nested.count() == 1500


def test_envelopes_round_trip(spark, nested, tmp_path):
    target = str(tmp_path / "out")
    W.write_envelopes(nested, target, size=20)
    files = E.read_envelopes(spark, target, "*.json")
    back = E.records(files).select(*PULL_REQUEST_FIELDS)
    plain = [c for c in nested.columns if c != "commits"]
    assert back.count() == nested.count()
    assert back.select(*plain).exceptAll(nested.select(*plain)).isEmpty()
    assert files.agg(F.max(F.size("data"))).first()[0] == 20
    one = files.orderBy("metadata.batch_name").first()
    assert one.metadata.batch_name.startswith("NATION_0_batch_1_of_")
    assert one.metadata.total_prs == len(one.data)
    ids = [r.id for r in one.data]
    assert ids == sorted(ids)


def test_csv_is_readable_by_others(spark, nested, tmp_path):
    flat = stats.flatten(stats.with_measures(nested)).withColumn(
        "description", F.concat(F.lit('quote " and\nbreak, '), "description"))
    W.write_csv(flat.coalesce(1), str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    with part.open(newline="", encoding="utf-8") as handle:
        found = list(csv.DictReader(handle))
    assert list(found[0]) == list(CSV_COLUMNS)
    expected = {r.id: r for r in flat.collect()}
    for line in found:
        assert line["description"] == expected[line["id"]].description
        assert int(line["files_count"]) == expected[line["id"]].files_count


def test_description_is_cut(nested):
    flat = stats.flatten(stats.with_measures(nested))
    longest = flat.agg(F.max(F.length("description"))).first()[0]
    assert longest == X.DESCRIPTION_LIMIT + len(X.DESCRIPTION_SUFFIX)


def test_statistics_skip_patches_and_bodies(nested):
    text = plan_text(stats.statistics(stats.with_measures(nested)))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans and all("patch" not in s and "body" not in s for s in scans)


@pytest.mark.parametrize("output", ["json", "csv"])
def test_save(spark, nested, tmp_path, output):
    target = str(tmp_path / "save")
    W.write_save(nested, target, ExtractionConfig(output_format=output), final=True)
    (line,) = [json.loads(x) for p in (tmp_path / "save" / "metadata").glob("part-*")
               for x in p.read_text().splitlines()]
    assert (line["total_prs"], line["is_final_save"]) == (1500, True)
    assert line["configuration"]["batch_size"] == 300
    assert line["component_updates"] == {"commits": 1500, "comments": 1500, "files": 1500}
    assert (tmp_path / "save" / "csv").exists() == (output == "csv")
    stored = spark.read.json(str(tmp_path / "save" / "statistics"))
    assert rows(stored) == rows(
        stats.statistics(stats.with_measures(nested)).select(*stored.columns))


def test_empty_csv_save_writes_nothing(nested, tmp_path):
    W.write_save(nested.limit(0), str(tmp_path / "none"), ExtractionConfig(output_format="csv"))
    assert not (tmp_path / "none").exists()


def test_empty_input_has_no_statistics(nested):
    assert stats.statistics(stats.with_measures(nested.limit(0))).isEmpty()


def test_percentage_of_nothing(spark):
    empty = spark.createDataFrame(
        [], "id string, has_commits boolean, has_comments boolean, has_files boolean")
    row = stats.coverage_percentages(empty).first()
    assert (row.total_prs, row.prs_with_files_pct) == (0, 0.0)

"""Envelope files, landed pages and file contents."""

from __future__ import annotations

import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from mergelens.operators import snapshots, stats
from mergelens.operators.normalize import split_rejects, with_timestamps
from mergelens.sources import envelopes as E
from mergelens.sources import pages as P
from tests.conftest import rows

LFS = "version https://git-lfs.github.com/spec/v1\noid sha256:0\nsize 5\n"


def _record(number, **fields):
    record = {
        "id": f"o/r_{number}", "repository_name": "r", "repository_full_name": "o/r",
        "pr_number": number, "author": "a", "title": "t", "commits": {"s1": {
            "commit_message": "m", "author": "x", "date": "d"}},
        "pr_comments": [{"id": "1", "body": "b", "author": "y", "date": "d", "type": "issue"}],
        "files": [{"filename": "f", "status": "added", "additions": 2, "deletions": 1,
                   "changes": 3, "patch": "ü"}],
    }
    record.update(fields)
    return {k: v for k, v in record.items() if v is not ...}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("envelopes")

    def save(name, text, mtime):
        file = path / name
        file.write_text(text, encoding="utf-8")
        os.utime(file, (mtime, mtime))

    def envelope(*records):
        return json.dumps({"metadata": {"extraction_timestamp": "20250101_000000"},
                           "data": list(records)}, indent=2, ensure_ascii=False)

    save("enhanced_pr_data_a_1.json", envelope(*[_record(n) for n in (1, 2, 3)]), 1_000)
    save("enhanced_pr_data_a_2.json", envelope(_record(1, files=[]), _record(4, files=...)), 2_000)
    save("enhanced_pr_data_b_final.json", envelope(), 1_500)
    save("enhanced_pr_data_lfs.json", LFS, 1_500)
    save("enhanced_pr_data_cut.json", envelope(_record(7))[:200], 1_500)
    save("enhanced_pr_data_nokey.json",
         envelope(_record(8, id=...), _record(9, repository_name=...)), 1_600)
    save("enhanced_pr_data.json", envelope(_record(10)), 1_700)
    save("metadata_x.json", "{}", 1_000)
    save("other.json", "{}", 1_000)
    return str(path)


@pytest.fixture(scope="module")
def files(spark, folder):
    return E.read_envelopes(spark, folder)


def test_only_result_files_are_matched(spark, folder, files):
    assert files.count() == 7
    named = E.read_envelopes(spark, folder, name_pattern=E.ENVELOPE_PATTERN)
    assert named.count() == 6


def test_bad_files_are_quarantined(files):
    assert rows(E.quarantined(files)) == [
        ("enhanced_pr_data_cut.json", "unreadable"), ("enhanced_pr_data_lfs.json", "unreadable")]


def test_newest_record_and_presence(files):
    flagged = stats.with_presence(E.records(files), "key")
    status = {r.id: r for r in snapshots.component_status(flagged).collect()}
    assert set(status) == {f"o/r_{n}" for n in (1, 2, 3, 4, 10)}
    assert status["o/r_1"].has_files and not status["o/r_4"].has_files
    content = stats.with_presence(snapshots.latest_records(E.records(files)), "nonempty")
    assert {r.id: r.has_files for r in content.collect()}["o/r_1"] is False


def test_counts_keep_records_without_a_repository(files):
    records = E.records(files)
    assert stats.coverage(stats.with_presence(records)).first().total_prs == 8
    assert rows(stats.distinct_per_repository(records)) == [("r", 5), (None, 1)]


def test_commits_are_read_as_a_map(files):
    record = E.records(files).filter("pr_number = 2").first()
    assert record.commits["s1"].commit_message == "m"
    assert record.files[0].patch == "ü"


def test_indented_files_are_read_record_by_record(spark, folder, files):
    records, rejects = E.read_indented(spark, folder)
    plain = E.records(files)
    columns = [c for c in plain.columns if c not in ("pos", "commits")]
    cut = "file <> 'enhanced_pr_data_cut.json'"
    assert rows(records.filter(cut).select(*columns)) == rows(plain.select(*columns))
    assert rows(rejects) == [
        ("enhanced_pr_data_cut.json", "unreadable record"),
        ("enhanced_pr_data_lfs.json", "unreadable record")]
    named, _ = E.read_indented(spark, folder, name_pattern=E.ENVELOPE_PATTERN)
    assert named.count() == records.count() - 1


def test_one_large_indented_file_is_split(spark, tmp_path):
    text = json.dumps({"metadata": {"extraction_timestamp": "t", "configuration": {"a": {}}},
                       "data": [_record(n, title=f"x \\n    }},\\n    {{ {n}") for n in range(400)]}, indent=2)
    (tmp_path / "enhanced_pr_data_x.json").write_text(text)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "16k")
    try:
        records, rejects = E.read_indented(spark, str(tmp_path))
        assert records.select(F.spark_partition_id()).distinct().count() > 5
        in_order = records.orderBy("pos").select("pr_number", "timestamp", "title").collect()
    finally:
        spark.conf.set(name, before)
    assert [r.pr_number for r in in_order] == list(range(400))
    assert {r.timestamp for r in in_order} == {"t"}
    assert in_order[7].title == "x \\n    },\\n    { 7"
    assert rejects.isEmpty()


def _pages(spark, *bodies):
    return spark.createDataFrame(
        [("o/r", 1, page, json.dumps(body) if not isinstance(body, str) else body)
         for page, body in enumerate(bodies, 1)],
        "repository_full_name string, pr_number bigint, page bigint, body string",
    )


def test_commits_keep_page_order(spark):
    def commit(sha):
        return {"sha": sha, "commit": {"message": sha, "author": {"name": "n", "date": "d"}}}

    commits = P.commits_from_pages(_pages(spark, [commit("b"), commit("a")], [commit("c")], "{bad"))
    assert [r.sha for r in commits.orderBy("seq").collect()] == ["b", "a", "c"]


def test_comments_tolerate_missing_users(spark):
    issue = _pages(spark, [{"id": 5, "body": "b", "user": None, "created_at": "d", "position": 3}])
    review = _pages(spark, [{"id": 6, "body": "b", "user": {"login": "u"}, "created_at": "d"}])
    comments = rows(P.comments_from_pages(issue, review), "id", "author", "type", "position")
    assert comments == [("5", "", "issue", None), ("6", "u", "review", None)]


def test_absent_and_null_file_fields_differ(spark):
    pages = _pages(spark, [{"filename": "a", "status": "s"},
                           {"filename": "b", "status": "s", "additions": 4, "patch": None}])
    files = rows(P.files_from_pages(pages), "filename", "additions", "changes", "patch")
    assert files == [("a", 0, 0, ""), ("b", 4, 0, None)]


def test_pull_requests_and_rejects(spark):
    base = {"number": 1, "title": "t", "state": "open", "user": {"login": "u"},
            "labels": [{"name": "bug"}, {"name": None}]}
    pages = _pages(spark, [base, {**base, "number": 2, "user": None},
                           {**base, "number": 3, "title": None, "labels": None}])
    valid, rejects = split_rejects(P.pull_requests_from_pages(pages))
    assert rows(valid, "id", "draft", "labels") == [("o/r_1", False, ["bug", None])]
    assert rows(rejects, "pr_number", "reject_reason") == [
        (2, "missing author"), (3, "missing title")]


def test_items_that_repeat_over_pages_stay_where_they_are(spark):
    item = {"number": 1, "title": "first", "state": "open", "user": {"login": "u"}, "labels": []}
    late = [{**item, "title": "again"}, {**item, "number": None, "title": "no number"}]
    pages = spark.createDataFrame(
        [("o/r", 2, json.dumps(late)), ("o/r", 1, json.dumps([item, {**item, "number": 2}])),
         ("o/s", 9, json.dumps([item]))],
        "repository_full_name string, page bigint, body string",
    )
    found = P.pull_requests_from_pages(pages)
    assert sorted(rows(found, "id", "title"), key=str) == [
        ("o/r_1", "first"), ("o/r_2", "first"), ("o/s_1", "first"), (None, "no number")]
    # Bodies are not moved: nothing but the written names is exchanged.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_typed_times(spark):
    df = spark.createDataFrame([("2023-10-01T12:00:00Z",), ("soon",), (None,)], "created_at string")
    typed = [r[0] for r in with_timestamps(df, "created_at").select(
        F.date_format("created_at_ts", "yyyy-MM-dd HH:mm")).collect()]
    assert typed == ["2023-10-01 12:00", None, None]


def test_repositories_with_languages(spark):
    item = {"name": "r", "full_name": "o/r", "html_url": "h", "stargazers_count": 1,
            "forks_count": 2, "description": None, "size": 3, "fork": False, "archived": False,
            "created_at": "c", "updated_at": "u", "pulls_url": "x/pulls{/number}"}
    repos = _pages(spark, {"items": [item, {**item, "full_name": "o/s", "pulls_url": None}]})
    languages = _pages(spark, {"Go": 5, "C": 1})
    found = P.repositories_from_pages(repos, languages).orderBy("full_name").collect()
    assert [sorted(r.languages) for r in found] == [["C", "Go"], []]
    assert [(r.description, r.pulls_url) for r in found] == [("", "x/pulls"), ("", "")]


def test_contents(spark):
    text = "käse\n" * 30
    encoded = base64.encodebytes(text.encode()).decode()
    df = spark.createDataFrame(
        [(encoded, "base64"), (encoded, "none"), ("@@@", "base64"), (None, "base64"),
         (base64.b64encode(b"\xff\xfe").decode(), "base64"), ("x", None)],
        "content string, encoding string",
    )
    assert [r.text for r in P.decode_contents(df).collect()] == [text, "", "", "", "", ""]


def test_json_lines_of_records(spark, tmp_path):
    lines = "\n".join(json.dumps(_record(n)) for n in (1, 2))
    (tmp_path / "part.json").write_text(lines)
    records = E.read_records(spark, str(tmp_path), "json")
    assert rows(records.select("id", F.size("files"))) == [("o/r_1", 1), ("o/r_2", 1)]

"""The whole job over landed pages, its reports and the command line."""

from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mergelens import __main__ as cli
from mergelens.config import ExtractionConfig
from mergelens.operators import stats
from mergelens.plans import extraction, reports
from tests.conftest import rows

KEYS = "repository_full_name string, pr_number bigint, page bigint, body string"


def _pr(number, **fields):
    base = {"number": number, "title": f"Fix bug {number}", "body": "text", "state": "closed",
            "created_at": "2024", "updated_at": f"2024-0{number}", "merged_at": None,
            "user": {"login": "u"}, "labels": [{"name": "bug"}]}
    return {**base, **fields}


def _commit(sha, message="fix it"):
    return {"sha": sha, "commit": {"message": message, "author": {"name": "n", "date": "d"}}}


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    repo = {"name": "r", "full_name": "o/r", "html_url": "h", "stargazers_count": 5,
            "forks_count": 1, "description": None, "size": 100, "fork": False, "archived": False,
            "created_at": "c", "updated_at": "u", "pulls_url": "p"}

    def land(name, *listings):
        data = [(full, number, page, json.dumps(body)) for full, number, page, body in listings]
        spark.createDataFrame(data, KEYS).write.parquet(f"{root}/{name}")

    land("repositories", (None, None, 1, {"items": [
        repo, {**repo, "name": "s", "full_name": "o/s", "stargazers_count": 9},
        {**repo, "name": "f", "full_name": "o/f", "fork": True}]}))
    land("languages", ("o/r", None, 1, {"Go": 1}), ("o/s", None, 1, {"C": 1}))
    land("pull_requests",
         ("o/r", None, 1, [_pr(1), _pr(2, state="open"), _pr(3, user=None)]),
         ("o/r", None, 2, [_pr(4)]), ("o/s", None, 1, [_pr(1)]), ("o/f", None, 1, [_pr(1)]))
    land("commits", ("o/r", 1, 1, [_commit("a"), _commit("b")]), ("o/r", 1, 2, [_commit("a", "c")]),
         ("o/s", 1, 1, [_commit("z")]))
    land("issue_comments", ("o/r", 1, 1, [{"id": 1, "body": "b", "user": {"login": "x"},
                                            "created_at": "d"}]))
    land("review_comments", ("o/r", 4, 1, [{"id": 2, "body": "b", "user": None,
                                            "created_at": "d", "position": 7}]))
    land("files", ("o/r", 1, 1, [{"filename": "f", "status": "added", "additions": 2,
                                  "deletions": 1, "changes": 3, "patch": "x" * 20}]))
    return root


def test_run_selects_rejects_and_classifies(spark, landing, tmp_path):
    out = str(tmp_path)
    config = ExtractionConfig(max_patch_size=10)
    extraction.run_extraction(spark, landing, out, "run1", config)
    records = {r.id: r for r in extraction.stored_records(spark, out).collect()}
    assert set(records) == {"o/r_1", "o/r_4", "o/s_1"}
    first = records["o/r_1"]
    assert {k: v.commit_message for k, v in first.commits.items()} == {"a": "c", "b": "fix it"}
    assert first.files[0].patch == "x" * 10 + "... [truncated]"
    assert (first.change_type, first.repository_language, first.tags) == ("fix", ["Go"], ["bug"])
    assert first.components_updated.asDict() == {"commits": True, "comments": True, "files": True}
    assert records["o/r_4"].pr_comments[0].position == 7
    rejects = spark.read.json(f"{out}/rejects")
    assert rows(rejects, "id", "reject_reason") == [("o/r_3", "missing author")]
    report = extraction.summaries(extraction.stored_records(spark, out))
    assert rows(report["repositories"]) == [("r", 2), ("s", 1)]


def test_second_run_adds_missing_components_only(spark, landing, tmp_path):
    out = str(tmp_path)
    config = ExtractionConfig(include_repositories=("r",))
    extraction.run_extraction(
        spark, landing, out, "run1", replace(config, include_file_diffs=False))
    extraction.run_extraction(spark, landing, out, "run2", config)
    merged = {r.id: r for r in extraction.stored_records(spark, out).collect()}
    assert set(merged) == {"o/r_1", "o/r_4"}
    assert (len(merged["o/r_1"].commits), len(merged["o/r_1"].files)) == (2, 1)
    assert merged["o/r_1"].components_updated.commits is False
    # The same run again overwrites itself and changes nothing.
    before = rows(spark.read.parquet(f"{out}/records").drop("commits"))
    extraction.run_extraction(spark, landing, out, "run2", config)
    assert rows(spark.read.parquet(f"{out}/records").drop("commits")) == before


def test_all_or_nothing_idempotency(spark, landing, tmp_path):
    out = str(tmp_path)
    config = ExtractionConfig(component_level=False, include_file_diffs=False)
    extraction.run_extraction(spark, landing, out, "run1", config)
    target = extraction.run_extraction(
        spark, landing, out, "run2", replace(config, include_file_diffs=True))
    assert not any(Path(target).rglob("*.parquet"))
    assert extraction.stored_records(spark, out).count() == 3


def test_settings(spark, landing):
    prior = extraction.stored_records(spark, "/tmp/does-not-exist")
    config = ExtractionConfig(
        idempotent=False, include_languages=("C",), enhanced_detection=False, pr_state="all")
    records, _ = extraction.extract(spark, landing, prior, config)
    assert rows(records, "id", "change_type", "change_type_confidence") == [("o/s_1", "fix", 0.5)]
    config = ExtractionConfig(idempotent=False, use_similarity=True, use_commit_profile=True,
                              min_changed_files=1)
    records, _ = extraction.extract(spark, landing, prior, config)
    (only,) = records.collect()
    assert only.id == "o/r_1"
    assert any(r.startswith("NLP semantic similarity to fix") for r in only.change_type_reasons)


def test_reports(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    config = ExtractionConfig(output_format="envelope", batch_size=1)
    extraction.run_extraction(spark, landing, out, "run1", config)
    envelopes = reports.read_results(spark, f"{out}/records", "parquet", False)
    report = reports.coverage_report(envelopes)
    assert report["coverage"].first().asDict() == {
        "total_prs": 3, "unique_prs": 3, "prs_with_files": 1, "prs_with_comments": 2,
        "prs_with_commits": 2, "prs_with_all_components": 1, "prs_with_files_pct": 33.33,
        "prs_with_comments_pct": 66.67, "prs_with_commits_pct": 66.67,
        "prs_with_all_components_pct": 33.33}
    assert rows(report["top_repositories"]) == [("o/r", 2), ("o/s", 1)]
    assert rows(reports.distinct_report(envelopes)["totals"]) == [(2, 3)]
    reports.write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "top_authors")).first()["count"] == 3
    batches = spark.read.json(f"{out}/envelopes/run=run1")
    assert batches.count() == 3


def test_command_line(spark, landing, tmp_path, capsys):
    out = str(tmp_path / "out")
    cli.main(["extract", landing, out, "run1", "--settings", '{"top_n_repositories": 1}'])
    cli.main(["coverage", f"{out}/records", "--format", "parquet", "--save", str(tmp_path / "r")])
    assert "change_types" in capsys.readouterr().out
    assert spark.read.json(f"{out}/data/run=run1").count() == 1
    assert spark.read.json(str(tmp_path / "r" / "coverage")).first()["total_prs"] == 1


def test_assembled_records_agree_with_stats(spark, landing, tmp_path):
    out = str(tmp_path)
    extraction.run_extraction(spark, landing, out, "run1", ExtractionConfig())
    stored = spark.read.json(f"{out}/statistics/run=run1")
    total = stored.filter("metric = 'aggregate_stats' and key = 'total_commits'").first()
    assert total["value"] == 3
    flat = stats.with_measures(extraction.stored_records(spark, out))
    assert stats.totals(flat).first().total_commits == 3
    assert flat.agg(F.sum("additions")).first()[0] == 2


def _land(spark, root, pages):
    for name in ("repositories", "languages", "pull_requests", "commits", "issue_comments",
                 "review_comments", "files"):
        rows_of = [(f, n, p, b if b is None or isinstance(b, str) else json.dumps(b))
                   for f, n, p, b in pages.get(name, [])]
        spark.createDataFrame(rows_of, KEYS).write.mode("overwrite").parquet(f"{root}/{name}")
    return root


REPO = {"name": "r", "full_name": "o/r", "html_url": "h", "stargazers_count": 5, "forks_count": 1,
        "description": None, "size": 100, "fork": False, "archived": False, "created_at": "c",
        "updated_at": "u", "pulls_url": "p"}
FILE = {"filename": "f", "status": "added", "additions": 2, "deletions": 1, "changes": 3, "patch": "x"}


def test_repeated_pages_count_once(spark, tmp_path):
    """A pull request on two pages, a repository listed twice, two language pages."""
    root = _land(spark, str(tmp_path / "in"), {
        "repositories": [(None, None, 1, {"items": [REPO]}),
                         (None, None, 2, {"items": [{**REPO, "stargazers_count": 7}]})],
        "languages": [("o/r", None, 1, {"Go": 1}), ("o/r", None, 2, {"C": 1})],
        "pull_requests": [("o/r", None, 1, [_pr(1), _pr(2)]),
                          ("o/r", None, 2, [_pr(2, title="later"), _pr(3)])],
    })
    records, rejects = extraction.extract(
        spark, root, extraction.stored_records(spark, str(tmp_path / "none")), ExtractionConfig())
    found = rows(records.select("id", "title", "repository_stars", "repository_language"))
    assert found == [(f"o/r_{n}", f"Fix bug {n}", 5, ["Go"]) for n in (1, 2, 3)]
    assert rejects.isEmpty()


def test_cut_pages_and_nameless_children_are_rejected(spark, tmp_path):
    cut = json.dumps([_commit("z")])[:25]
    root, out = _land(spark, str(tmp_path / "in"), {
        "repositories": [(None, None, 1, {"items": [REPO]}), (None, None, 2, '{"items": [{"na')],
        "languages": [("o/r", None, 1, {"Go": 1})],
        "pull_requests": [("o/r", None, 1, [_pr(1), {**_pr(2), "number": None}])],
        "commits": [("o/r", 1, 1, [_commit(None, "fix"), _commit("b", "wip")]), ("o/r", 1, 2, cut),
                    ("o/r", 1, 3, None)],
        "files": [("o/r", 1, 1, [{**FILE, "filename": None}, FILE])],
        "issue_comments": [("o/r", 1, 1, [{"id": None, "body": "b", "user": None, "created_at": "d"}])],
    }), str(tmp_path / "out")
    extraction.run_extraction(spark, root, out, "run1", ExtractionConfig())
    (record,) = extraction.stored_records(spark, out).collect()
    assert (list(record.commits), [f.filename for f in record.files]) == (["b"], ["f"])
    assert record.pr_comments == []
    assert record.change_type_reasons.count("Commit pattern '\\bfix\\b' matches fix") == 1
    rejects = spark.read.json(f"{out}/rejects")
    assert rows(rejects, "listing", "page", "reject_reason") == [
        ("commits", "1", "missing sha"), ("commits", "2", "unreadable page"),
        ("files", "1", "missing filename"), ("issue_comments", "1", "missing id"),
        ("pull_requests", None, "missing number"), ("repositories", "2", "unreadable page")]


def test_equal_runs_end_and_empty_components_are_not_asked_again(spark, landing, tmp_path):
    out = str(tmp_path)
    config = ExtractionConfig()
    extraction.run_extraction(spark, landing, out, "run1", replace(config, include_file_diffs=False))
    for run, written in (("run2", 3), ("run3", 0)):
        target = extraction.run_extraction(spark, landing, out, run, config)
        assert sum(1 for _ in Path(target).rglob("*.parquet")) == 0 or (
            spark.read.parquet(target).count() == written)
        stored = spark.read.parquet(f"{out}/records").filter(F.col("run") == run)
        assert stored.count() == written


def test_minimum_of_files_counts_stored_ones(spark, tmp_path):
    """A run that fetches comments only keeps them, because the files are stored already."""
    pages = {
        "repositories": [(None, None, 1, {"items": [REPO]})],
        "pull_requests": [("o/r", None, 1, [_pr(1)])],
        "files": [("o/r", 1, 1, [FILE])],
        "issue_comments": [("o/r", 1, 1, [{"id": 1, "body": "b", "user": None, "created_at": "d"}])],
    }
    root, out = _land(spark, str(tmp_path / "in"), pages), str(tmp_path / "out")
    config = ExtractionConfig(min_changed_files=1)
    extraction.run_extraction(spark, root, out, "run1", replace(config, include_comments=False))
    extraction.run_extraction(spark, root, out, "run2", replace(config, include_file_diffs=False))
    (record,) = extraction.stored_records(spark, out).collect()
    assert (len(record.pr_comments), len(record.files)) == (1, 1)


def test_document_saves_of_a_run(spark, landing, tmp_path):
    out = str(tmp_path)
    config = ExtractionConfig(output_format="document", batch_size=1)
    extraction.run_extraction(spark, landing, out, "run1", config)
    stored = rows(extraction.stored_records(spark, out), "id", "title", "files", "pr_comments")
    for folder in ("documents", "final"):
        back = reports.read_results(spark, f"{out}/{folder}", "document", False)
        assert rows(back, "id", "title", "files", "pr_comments") == stored
    assert len(list(tmp_path.glob("documents/run=run1/save=*/part-*"))) == 3
    names = {p.name for p in tmp_path.glob("final/run=run1/save=*")}
    assert names == {"save=r_final_1_of_1", "save=s_final_1_of_1"}


def test_pull_requests_without_number_are_rejected_once_each(spark, landing, tmp_path):
    """Several in one repository: none is selected, and their rejects do not multiply."""
    faulty = str(tmp_path / "landing")
    for name in ("repositories", "languages", "commits", "issue_comments", "review_comments", "files"):
        spark.read.parquet(f"{landing}/{name}").write.parquet(f"{faulty}/{name}")
    items = [_pr(1), *({**_pr(n), "number": None} for n in (2, 3, 4, 5))]
    spark.createDataFrame([("o/r", None, 1, json.dumps(items))], KEYS).write.parquet(f"{faulty}/pull_requests")
    out = str(tmp_path / "out")
    extraction.run_extraction(spark, faulty, out, "run1", ExtractionConfig())
    assert rows(extraction.stored_records(spark, out), "id") == [("o/r_1",)]
    rejects = spark.read.schema("id string, reject_reason string").json(f"{out}/rejects")
    assert rows(rejects, "id", "reject_reason") == [(None, "missing number")] * 4

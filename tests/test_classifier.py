"""Golden rows of the change-type classifier and agreement of its two forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mergelens.functions import rules as R
from mergelens.operators import classify
from mergelens.operators import children as C
from mergelens.plans.fixtures import PR, Fixtures
from tests.conftest import SF_MEDIUM, SF_SMALL

# title, body, labels, commits, points (fix, feature, doc), type, confidence, reasons
GOLDEN = [
    ("Fix editor scrolling issue", "This PR fixes a scrolling issue in the editor",
     ["bug", "editor"], ["Fix scrolling behavior in editor"], (140, 0, 0), "fix", 1.40, 6),
    ("Bump version", None, [], [], (0, 0, 0), "feature", 0.0, 1),
    ("Docker image", "", [], [], (0, 0, 50), "feature", 0.5, 3),
    ("Address renewal", "", [], [], (0, 60, 0), "feature", 0.6, 2),
    ("memory", "leak", [], [], (10, 0, 0), "feature", 0.1, 2),
    ("Update README", None, ["Documentation"], ["docs: readme"], (0, 0, 110), "doc", 1.1, 4),
    ("Tidy", "", ["new-feature"], [], (0, 120, 0), "feature", 1.2, 3),
    ("Tidy", "", ["bugfix"], [], (120, 0, 0), "fix", 1.2, 3),
    ("Tidy", "closes #3", [], ["fixes #3", "prefix only"], (40, 0, 0), "feature", 0.4, 4),
    ("add bug", "", [], ["add", "fix"], (50, 50, 0), "feature", 0.5, 5),
    ("Tidy", " ".join(["w"] * 51), [], [], (0, 5, 0), "feature", 0.05, 2),
    ("Tidy", " ".join(["w"] * 50), [], [], (0, 0, 0), "feature", 0.0, 1),
    ("a b c d e fix", "", [], [], (30, 0, 0), "feature", 0.3, 2),
    ("a b c d fix", "", [], ["issue 7"], (60, 0, 0), "fix", 0.6, 3),
]
SCHEMA = "pr_number bigint, title string, body string, labels array<string>"


@pytest.fixture(scope="module")
def golden(spark):
    prs = spark.createDataFrame(
        [(i, t, b, labels) for i, (t, b, labels, *_) in enumerate(GOLDEN)], SCHEMA
    )
    commits = spark.createDataFrame(
        [
            (i, n, f"sha{n}", message)
            for i, row in enumerate(GOLDEN)
            for n, message in enumerate(row[3])
        ],
        "pr_number bigint, seq int, sha string, message string",
    )
    return prs, commits


def _nested(prs, commits):
    messages = (
        commits.groupBy("pr_number")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "message"))).alias("m"))
        .select("pr_number", F.col("m.message").alias("commit_messages"))
    )
    return prs.join(messages, "pr_number", "left")


def test_golden_rows_of_the_row_form(golden):
    scored = classify.score_pull_requests(*golden, key=PR).orderBy("pr_number").collect()
    for row, (*_, points, kind, confidence, reasons) in zip(scored, GOLDEN, strict=True):
        assert (row.points_fix, row.points_feature, row.points_doc) == points
        assert row.change_type == kind
        assert row.change_type_confidence == pytest.approx(confidence, abs=0)
        assert row.reason_count == reasons


def test_golden_rows_of_the_nested_form(golden):
    scored = classify.classify_nested(_nested(*golden)).orderBy("pr_number").collect()
    for row, (*_, points, kind, confidence, reasons) in zip(scored, GOLDEN, strict=True):
        assert (row.points_fix, row.points_feature, row.points_doc) == points
        assert (row.change_type, row.change_type_confidence) == (kind, confidence)
        assert len(row.change_type_reasons) == reasons


def test_reasons_keep_rule_order(golden):
    first = classify.classify_nested(_nested(*golden)).orderBy("pr_number").first()
    assert first.change_type_reasons == [
        "Label 'bug' matches fix",
        "Keyword 'fix' found in title",
        "Keyword 'fixes' found in body",
        "Keyword 'issue' found in title",
        r"Commit pattern '\bfix\b' matches fix",
        "Short fix-type title detected",
    ]


def test_unicode_word_boundaries(spark):
    prs = spark.createDataFrame([(1, "Tidy", "", [])], SCHEMA)
    commits = spark.createDataFrame(
        [(1, 1, "a", "éfix"), (1, 2, "b", "issue ٧"), (1, 3, "c", "FIX")],
        "pr_number bigint, seq int, sha string, message string",
    )
    assert classify.score_pull_requests(prs, commits, PR).first().points_fix == 40


def test_commit_profile_points(spark):
    prs = spark.createDataFrame([(1, "Tidy", "", [])], SCHEMA)
    commits = spark.createDataFrame(
        [(1, 1, "a", "URGENT"), (1, 2, "b", "run tests"), (1, 3, "c", "cleanup specs")],
        "pr_number bigint, seq int, sha string, message string",
    )
    plain = classify.score_pull_requests(prs, commits, PR).first()
    full = classify.score_pull_requests(prs, commits, PR, commit_profile=True).first()
    assert (plain.points_fix, plain.points_feature) == (0, 0)
    assert (full.points_fix, full.points_feature) == (R.URGENT_POINTS, 25)
    assert full.reason_count == plain.reason_count + 3


def test_every_fetched_commit_is_scored(spark):
    """A sha that comes twice scores twice, and counts once."""
    prs = spark.createDataFrame([(1, "Tidy", None, [])], SCHEMA)
    commits = spark.createDataFrame(
        [(1, 1, "a", "fix it"), (1, 2, "a", "fix it"), (1, 3, "b", "wip")],
        "pr_number bigint, seq int, sha string, message string",
    )
    scored = classify.score_pull_requests(prs, commits, PR).first()
    assert (scored.points_fix, scored.commits_count) == (40, 2)
    messages = C.commit_messages(commits, PR)
    nested = classify.classify_nested(prs.join(messages, "pr_number")).first()
    assert nested.points_fix == 40
    assert classify.profile_commits(commits, PR).first().total_commits == 3
    assert classify.profile_commits(commits, PR, cap=2).first().total_commits == 2


def test_null_label_names_are_ignored(spark):
    prs = spark.createDataFrame([(1, "Tidy", None, [None, "Bugfix"]), (2, "Tidy", None, None)], SCHEMA)
    scored = classify.score_pull_requests(prs, None, PR).orderBy("pr_number").collect()
    assert [r.points_fix for r in scored] == [120, 0]


def test_basic_detection(spark):
    texts = [("a PATCH", None, "fix"), ("x", "see Readme", "doc"), ("docs fix", "", "fix"),
             ("x", None, "feature")]
    df = spark.createDataFrame([(t, b) for t, b, _ in texts], "title string, body string")
    assert [r.change_type for r in classify.classify_basic(df).collect()] == [k for *_, k in texts]


def test_expected_classes_of_the_test_tables(spark):
    fx = Fixtures(spark, SF_MEDIUM)
    scored = classify.score_pull_requests(fx.pull_requests(), fx.commits, PR)
    counts = {r[0]: r[1] for r in scored.groupBy("change_type").count().collect()}
    assert counts == {"feature": 5578, "fix": 6109, "doc": 3313}
    assert scored.filter("change_type_confidence < 0.6").count() == 1860


def test_both_forms_agree(spark):
    fx = Fixtures(spark, SF_SMALL)
    prs = fx.pull_requests()
    rowwise = classify.score_pull_requests(prs, fx.commits, PR).select(
        "id", "change_type", "change_type_confidence", F.col("reason_count").cast("int")
    )
    messages = C.nest_commits(fx.commits, PR).select("pr_number", "commit_messages")
    nested = classify.classify_nested(prs.join(messages, "pr_number", "left")).select(
        "id", "change_type", "change_type_confidence", F.size("change_type_reasons")
    )
    assert rowwise.exceptAll(nested).isEmpty()
    assert nested.exceptAll(rowwise).isEmpty()

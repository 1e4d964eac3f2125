"""Caps, last-wins, distinct files and nesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from mergelens.functions import text as X
from mergelens.operators import children as C
from mergelens.operators import stats
from mergelens.plans.fixtures import PR, Fixtures
from tests.conftest import SF_SMALL, plan_text, rows

COMMIT = "pr_number bigint, seq int, sha string, message string, author string, date string"


def test_last_commit_of_a_sha_wins(spark):
    commits = spark.createDataFrame(
        [(1, 1, "a", "old", "x", "d"), (1, 2, "b", "b", "x", "d"), (1, 3, "a", "new", "x", "d")],
        COMMIT,
    )
    nested = C.nest_commits(commits, PR).first()
    assert {k: v.commit_message for k, v in nested.commits.items()} == {"a": "new", "b": "b"}
    assert nested.commit_messages == ["old", "b", "new"]


def test_commits_without_sha_stay_out_of_the_map(spark):
    commits = spark.createDataFrame(
        [(1, 1, None, "no sha", "x", "d"), (1, 2, "b", "b", "x", "d"), (2, 1, None, "c", "x", "d")],
        COMMIT,
    )
    nested = {r.pr_number: r for r in C.nest_commits(commits, PR).collect()}
    assert set(nested[1].commits) == {"b"} and nested[2].commits == {}
    assert nested[1].commit_messages == ["no sha", "b"]


def test_cap_comes_before_last_wins(spark):
    commits = spark.createDataFrame(
        [(1, 1, "a", "old", "x", "d"), (1, 2, "b", "b", "x", "d"), (1, 3, "a", "new", "x", "d")],
        COMMIT,
    )
    assert C.nest_commits(commits, PR, cap=2).first().commits["a"].commit_message == "old"


def test_files_are_distinct_then_capped(spark):
    files = spark.createDataFrame(
        [(1, i, f"f{i % 40}", "added", 1, 0, 1, "p" * 20) for i in range(120)],
        "pr_number bigint, seq int, filename string, status string, additions bigint, "
        "deletions bigint, changes bigint, patch string",
    )
    nested = C.nest_files(files, PR, cap=30, patch_limit=10).first().files
    assert [f.filename for f in nested] == [f"f{i}" for i in range(30)]
    assert nested[0].patch == "p" * 10 + X.PATCH_SUFFIX


def test_review_comments_fill_the_rest_of_the_cap(spark):
    comments = spark.createDataFrame(
        [(1, i, str(i), "issue" if i % 2 else "review", "", "", "", None) for i in range(10)],
        "pr_number bigint, seq int, id string, type string, body string, author string, "
        "date string, position bigint",
    )
    nested = C.nest_comments(comments, PR, cap=7).first().pr_comments
    assert [c.id for c in nested] == ["1", "3", "5", "7", "9", "0", "2"]


def test_patch_limit_counts_characters(spark):
    df = spark.createDataFrame([("é" * 10,), ("é" * 11,), (None,)], "p string")
    cut = [r[0] for r in df.select(X.truncate_patch(F.col("p"), 10)).collect()]
    assert cut == ["é" * 10, "é" * 10 + X.PATCH_SUFFIX, None]


def test_counts_equal_the_nested_form(spark):
    fx = Fixtures(spark, SF_SMALL)
    prs = fx.pull_requests(body=False).select("pr_number")
    caps = (3, 10, 3)
    counts = C.count_children(fx.commits, fx.comments, fx.files(patch=False), PR, caps)
    flat = stats.join_measures(prs, counts, PR)
    nested = prs
    for part in (
        C.nest_commits(fx.commits, PR, 3).drop("commit_messages"),
        C.nest_comments(fx.comments, PR, 10),
        C.nest_files(fx.files(), PR, 3),
    ):
        nested = nested.join(part, "pr_number", "left")
    assert rows(flat, "pr_number", *stats.MEASURES) == rows(
        stats.with_measures(nested), "pr_number", *stats.MEASURES
    )


def test_hot_pull_request(spark):
    """A third of all commits belongs to one pull request; the cap still holds exactly."""
    commits = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("pr_number"),
        F.col("id").alias("seq"),
        F.sha1(F.col("id").cast("string")).alias("sha"),
        F.lit("m").alias("message"),
        F.lit("a").alias("author"),
        F.lit("d").alias("date"),
    )
    hot = C.nest_commits(commits.repartition(8), PR).filter("pr_number = 0").first()
    assert len(hot.commits) == 100


def test_patches_are_grouped_as_they_come_sorted(spark):
    files = spark.createDataFrame([(i % 7, i, f"n{i}", "m", 1, 1, 2, "p" * i) for i in range(50)],
        "pr_number long, seq long, filename string, status string, additions long, deletions long, changes long, patch string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        nested = C.nest_files(files, ["pr_number"])
        plan = plan_text(nested)
        assert nested.count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = plan[: plan.index("SortMergeJoin")]
    assert "SortAggregate" in top and "HashAggregate" not in top and "Sort [" not in top

"""Repository and pull-request selection, tags, keys and the per-repository function."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from mergelens.functions import text as X
from mergelens.operators import apply as A
from mergelens.operators import select as S
from tests.conftest import rows


@pytest.fixture(scope="module")
def repositories(spark):
    data = [
        ("a", "o/a", 50, 1, 10, False, False, ["Go"], "2020", "2021"),
        ("b", "o/b", 40, 9, 20, False, False, ["Python", "C"], "2019", "2023"),
        ("c", "o/c", 90, 5, 30, True, False, [], "2018", "2022"),
        ("d", "o/d", 80, 5, 40, False, True, ["C"], "2017", "2024"),
        ("e", "o/e", 50, 2, 50, False, False, ["python"], "2016", "2025"),
    ]
    return spark.createDataFrame(
        data,
        "name string, full_name string, stars int, forks int, size_kb int, is_fork boolean, "
        "is_archived boolean, languages array<string>, created_at string, updated_at string",
    )


def _names(df):
    return [r.name for r in df.collect()]


def test_top_repositories(repositories):
    assert _names(S.select_repositories(repositories)) == ["a", "e", "b"]
    assert _names(S.select_repositories(repositories, top_n=1)) == ["a"]
    every = dict(exclude_forks=False, exclude_archived=False)
    assert _names(S.select_repositories(repositories, 2, **every)) == ["c", "d"]
    assert _names(S.select_repositories(repositories, 2, "created", "asc", **every)) == ["e", "d"]
    assert _names(S.select_repositories(repositories, 1, "updated", **every)) == ["e"]
    assert _names(S.select_repositories(repositories, 1, "forks", **every)) == ["b"]
    assert _names(S.select_repositories(repositories, min_stars=45, max_size_kb=20)) == ["a"]


def test_include_list(spark, repositories):
    assert S.include_repositories(repositories, []).count() == 5
    assert sorted(_names(S.include_repositories(repositories, ["a", "o/d", "x"]))) == ["a", "d"]
    table = spark.createDataFrame([("a",), ("o/a",), ("o/d",)], "name string")
    assert sorted(_names(S.include_repositories(repositories, table))) == ["a", "d"]


def test_languages_are_case_sensitive(repositories):
    assert _names(S.filter_languages(repositories, include=["Python", "Go"])) == ["a", "b"]
    assert _names(S.filter_languages(repositories, exclude=["C"])) == ["a", "c", "e"]
    assert S.filter_languages(repositories).count() == 5


def test_pull_request_listing(spark):
    data = [(f"o/{i % 2}", f"o/{i % 2}_{i}", "closed" if i % 3 else "open", f"202{i % 4}", i)
            for i in range(20)]
    prs = spark.createDataFrame(
        data, "repository_full_name string, id string, pr_state string, updated_at string, "
        "popularity int")
    listed = S.select_pull_requests(prs, 2)
    assert listed.groupBy("repository_full_name").count().agg(F.max("count")).first()[0] == 2
    assert listed.filter("pr_state <> 'closed'").isEmpty()
    assert S.select_pull_requests(prs, 100, state="all").count() == 20
    top = S.select_pull_requests(prs, 1, "all", "popularity").orderBy("id").collect()
    assert [r.popularity for r in top] == [18, 19]


def test_tags_and_keys(spark):
    df = spark.createDataFrame(
        [(["b", "a", "b", "", None], True, "dirty"), (None, None, None)],
        "labels array<string>, draft boolean, state string",
    )
    tags = [r[0] for r in df.select(X.tags(F.col("labels"), F.col("draft"), F.col("state"))).collect()]
    assert tags == [["a", "b", "draft", "merge-conflict"], []]
    key = df.select(X.pull_request_data_key(F.lit("o/r"), F.lit(5))).first()[0]
    assert key == hashlib.md5(b"pr_data|o/r|5").hexdigest()


@pytest.mark.parametrize("text, count, more", [
    ("a b c", 2, True), ("a b c", 3, False), ("  a\tb\n", 2, False), ("", 0, False),
    ("a b", 1, True), ("a\x1cb", 1, True), (" \n ", 0, False), (None, 0, False),
])
def test_word_counts(spark, text, count, more):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.more_words_than(F.col("t"), count)).first()[0] is more
    assert more is (len((text or "").split()) > count)


def test_function_per_repository(repositories):
    def work(row, extra):
        if row["name"] == "a":
            raise RuntimeError("boom")
        if row["name"] == "b":
            return [{"n": 1, "t": extra}, {"n": 2, "t": extra}]
        return {"n": 3, "t": extra} if row["name"] == "c" else None

    applied = A.apply_per_repository(
        repositories.select("name", "full_name"), work, "n bigint, t string", partitions=3,
        extra="x")
    results, failures = A.split_errors(applied)
    assert rows(results) == [("o/b", 1, "x"), ("o/b", 2, "x"), ("o/c", 3, "x")]
    assert rows(failures, "full_name", "error") == [("o/a", "RuntimeError: boom")]

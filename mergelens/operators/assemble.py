"""The nested 24-field record of a pull request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions import text as X
from mergelens.functions.rules import CONFIDENCE_THRESHOLD, DEFAULT_RULES
from mergelens.operators import children as C
from mergelens.operators.classify import classify_basic, classify_nested, own_text
from mergelens.operators.similarity import pull_request_similarity
from mergelens.schemas import COMMENT_VALUE, COMMIT_VALUE, FILE_VALUE, PULL_REQUEST_FIELDS

NEEDS = ("need_commits", "need_comments", "need_files")
_EMPTY_ARRAY = "array<string>"


def join_repositories(prs: DataFrame, repositories: DataFrame) -> DataFrame:
    """Repository attributes on every pull request.

    The selected repositories are few, so adaptive execution broadcasts them by their size.
    """
    attributes = repositories.select(
        F.col("full_name").alias("repository_full_name"),
        F.col("name").alias("repository_name"),
        F.col("url").alias("repository_url"),
        F.col("languages").alias("repository_language"),
        F.col("stars").alias("repository_stars"),
        F.col("forks").alias("repository_forks"),
    )
    kept = [c for c in prs.columns if c not in attributes.columns or c == "repository_full_name"]
    return prs.select(*kept).join(attributes, "repository_full_name")


def _needed(prs: DataFrame, need: str, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Child rows of pull requests that ask for them (all of them without a need column)."""
    if need not in prs.columns:
        return rows
    return rows.join(prs.filter(F.col(need)).select(*key), list(key), "left_semi")


def join_children(
    prs: DataFrame,
    commits: DataFrame | None,
    comments: DataFrame | None,
    files: DataFrame | None,
    key: Sequence[str] = C.DEFAULT_KEY,
    caps: tuple[int, int, int] = (C.DEFAULT_CAP, C.DEFAULT_CAP, C.DEFAULT_CAP),
    patch_limit: int = X.PATCH_LIMIT,
) -> DataFrame:
    """Nested children on every pull request, empty where there are none."""
    result = prs
    if commits is not None:
        rows = _needed(prs, "need_commits", commits, key)
        result = result.join(C.nest_commits(rows, key, caps[0]), list(key), "left")
    if comments is not None:
        rows = _needed(prs, "need_comments", comments, key)
        result = result.join(C.nest_comments(rows, key, caps[1]), list(key), "left")
    if files is not None:
        rows = _needed(prs, "need_files", files, key)
        result = result.join(C.nest_files(rows, key, caps[2], patch_limit), list(key), "left")

    def or_empty(name: str, empty: Column, kind: str) -> Column:
        if name not in result.columns:
            return empty.cast(kind)
        return F.coalesce(F.col(name), empty.cast(kind))

    return result.withColumns(
        {
            "commits": or_empty("commits", F.create_map(), f"map<string, {COMMIT_VALUE}>"),
            "commit_messages": or_empty("commit_messages", F.array(), _EMPTY_ARRAY),
            "pr_comments": or_empty("pr_comments", F.array(), f"array<{COMMENT_VALUE}>"),
            "files": or_empty("files", F.array(), f"array<{FILE_VALUE}>"),
        }
    )


def _updated(prs: DataFrame) -> Column:
    flags = []
    for need in NEEDS:
        value = F.col(need) if need in prs.columns else F.lit(True)
        flags.append(value.alias(need.removeprefix("need_")))
    return F.struct(*flags)


def assemble(
    prs: DataFrame,
    repositories: DataFrame,
    commits: DataFrame | None,
    comments: DataFrame | None,
    files: DataFrame | None,
    key: Sequence[str] = C.DEFAULT_KEY,
    caps: tuple[int, int, int] = (C.DEFAULT_CAP, C.DEFAULT_CAP, C.DEFAULT_CAP),
    patch_limit: int = X.PATCH_LIMIT,
    enhanced: bool = True,
    analyze_commits: bool = True,
    threshold: float = CONFIDENCE_THRESHOLD,
    similarity: bool = False,
    commit_profile: bool = False,
) -> DataFrame:
    """Join, nest, classify and tag: one output record per pull request.

    Texts are searched before the children are joined, so that no record with patches is held for it.
    """
    searched = own_text(prs, DEFAULT_RULES) if enhanced else prs
    joined = join_children(
        join_repositories(searched, repositories), commits, comments, files, key, caps, patch_limit
    )
    if not enhanced:
        classified = classify_basic(joined)
    else:
        if similarity:
            messages = None
            if commits is not None and analyze_commits:
                rows = _needed(prs, "need_commits", commits, key)
                messages = C.commit_messages(rows, key, caps[0])
            cosines = pull_request_similarity(prs, messages, key)
            joined = joined.join(cosines, list(key), "left")
        classified = classify_nested(
            joined, threshold=threshold, analyze_commits=analyze_commits,
            commit_profile=commit_profile, similarity=similarity,
        )
    return classified.withColumns(
        {
            "description": F.coalesce(F.col("body"), F.lit("")),
            "tags": X.tags(F.col("labels"), F.col("draft"), F.col("mergeable_state")),
            "draft": F.coalesce(F.col("draft"), F.lit(False)),
            "components_updated": _updated(prs),
        }
    ).select(*PULL_REQUEST_FIELDS)

"""Commits, comments and files of a pull request: cap, dedupe, nest.

All functions take the key columns of the pull request and a sortable ``seq`` column. Caps prune
each map task before the shuffle, and nesting only ever sees capped groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions.text import PATCH_LIMIT, truncate_patch
from mergelens.operators.normalize import POSITION
from mergelens.operators.ranking import first_n, first_row

DEFAULT_KEY = ("repository_full_name", "pr_number")
DEFAULT_CAP = 100

# With this setting Spark groups rows that come sorted by their key as a stream, without hashing or
# sorting them again, so that patches are neither held nor spilled a second time.
_SORTED_GROUPS = "spark.sql.execution.replaceHashWithSortAgg"


def cap_commits(
    commits: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """The first ``cap`` commits in page order."""
    return first_n(commits, key, [F.col(POSITION)], cap)


def cap_comments(
    comments: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """Issue comments first, review comments fill what is left of the shared cap."""
    issue_first = F.when(F.col("type") == "issue", F.lit(0)).otherwise(F.lit(1))
    return first_n(comments, key, [issue_first, F.col(POSITION)], cap)


def cap_files(
    files: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """The first ``cap`` distinct file names in page order, each at its first position."""
    distinct = first_row(files, [*key, "filename"], [F.col(POSITION)])
    return first_n(distinct, key, [F.col(POSITION)], cap)


def _last_of_each(rows: Column, name: str) -> Column:
    """Entries of an array whose ``name`` is set and does not come again later."""
    names = F.transform(rows, lambda row: row[name])

    def is_last(row: Column, at: Column) -> Column:
        later = F.slice(names, at + 2, F.greatest(F.size(rows), F.lit(1)))
        return row[name].isNotNull() & ~F.array_contains(later, row[name])

    return F.filter(rows, is_last)


def nest_commits(
    commits: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """Per pull request: ``commits`` as a map by sha, ``commit_messages`` in page order.

    The map has the last occurrence of each sha and leaves commits without one out; the messages
    are those of all commits up to the cap, as the classifier reads them.
    """
    entry = F.struct(
        F.col(POSITION),
        F.col("sha"),
        F.struct(F.col("message").alias("commit_message"), "author", "date").alias("value"),
    )
    nested = (
        cap_commits(commits, key, cap)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    )
    return nested.select(
        *key,
        F.map_from_entries(
            F.transform(
                _last_of_each(F.col("_rows"), "sha"),
                lambda row: F.struct(row["sha"], row["value"]),
            )
        ).alias("commits"),
        F.transform("_rows", lambda row: row["value"]["commit_message"]).alias("commit_messages"),
    )


def commit_messages(
    commits: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """Per pull request: ``commit_messages`` in page order, without the other commit fields."""
    narrow = commits.select(*key, POSITION, "message")
    nested = cap_commits(narrow, key, cap).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct(POSITION, "message"))).alias("_rows")
    )
    return nested.select(*key, F.col("_rows.message").alias("commit_messages"))


def nest_comments(
    comments: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """Per pull request: ``pr_comments`` in fetch order."""
    value = F.struct("id", "body", "author", "date", "type", "position")
    entry = F.struct("rank", value.alias("value"))
    nested = (
        cap_comments(comments, key, cap)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    )
    return nested.select(
        *key, F.transform("_rows", lambda row: row["value"]).alias("pr_comments")
    )


def nest_files(
    files: DataFrame,
    key: Sequence[str] = DEFAULT_KEY,
    cap: int = DEFAULT_CAP,
    patch_limit: int = PATCH_LIMIT,
) -> DataFrame:
    """Per pull request: ``files`` in page order.

    Names are deduplicated and capped without the patches. These are cut before their one shuffle:
    the join with the kept places and the nesting both go by the key.
    """
    files.sparkSession.conf.set(_SORTED_GROUPS, "true")
    cut = files.withColumn("patch", truncate_patch(F.col("patch"), patch_limit))
    kept = (
        cap_files(files.select(*key, POSITION, "filename"), key, cap)
        .groupBy(*key)
        .agg(F.collect_list(POSITION).alias("_kept"))
    )
    value = F.struct("filename", "status", "additions", "deletions", "changes", "patch")
    entry = F.struct(POSITION, value.alias("value"))
    nested = (
        cut.join(kept, list(key))
        .filter(F.array_contains("_kept", F.col(POSITION)))
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    )
    return nested.select(*key, F.transform("_rows", lambda row: row["value"]).alias("files"))


def count_comments(
    comments: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """``comments_count`` per pull request: all comments up to the shared cap."""
    counted = comments.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(*key, F.least("_n", F.lit(cap).cast("bigint")).alias("comments_count"))


def count_files(
    files: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """``files_count`` and line sums per pull request, equal to those of the nested form."""
    sizes = ["additions", "deletions", "changes"]
    kept = cap_files(files.select(*key, POSITION, "filename", *sizes), key, cap)
    return kept.groupBy(*key).agg(
        F.count(F.lit(1)).alias("files_count"),
        *[F.sum(F.coalesce(size, F.lit(0))).alias(size) for size in sizes],
    )


def count_children(
    commits: DataFrame,
    comments: DataFrame,
    files: DataFrame,
    key: Sequence[str] = DEFAULT_KEY,
    caps: tuple[int, int, int] = (DEFAULT_CAP, DEFAULT_CAP, DEFAULT_CAP),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts and line sums per pull request, equal to those of the nested form.

    Nothing is nested: only the columns that are counted travel.
    """
    commit_counts = (
        cap_commits(commits.select(*key, POSITION, "sha"), key, caps[0])
        .groupBy(*key)
        .agg(F.size(F.collect_set("sha")).cast("bigint").alias("commits_count"))
    )
    return (
        commit_counts,
        count_comments(comments, key, caps[1]),
        count_files(files, key, caps[2]),
    )

"""Counts, distributions, totals and reports over pull-request records.

Most functions take the flat form: one row per pull request with the measure columns
``commits_count`` ... ``changes``, from nested records (``with_measures``) or straight from the
child tables (``join_measures``). Everything pre-aggregates before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions import text as X
from mergelens.functions.arrays import each
from mergelens.schemas import CSV_COLUMNS

MEASURES = (
    "commits_count", "comments_count", "files_count", "additions", "deletions", "changes",
)
MEASURE_NAMES = ("commits", "comments", "files", "additions", "deletions", "changes")
UNKNOWN_AUTHOR = "unknown"


def count_of(items: Column) -> Column:
    """Size of an array or map, 0 for null."""
    return F.coalesce(F.size(F.when(items.isNotNull(), items)), F.lit(0)).cast("bigint")


def _sum_of(amounts: Column) -> Column:
    """Sum of an array of numbers, 0 for null."""
    total = F.aggregate(
        amounts,
        F.lit(0).cast("bigint"),
        lambda acc, amount: acc + F.coalesce(amount, F.lit(0)),
    )
    return F.coalesce(total, F.lit(0))


def with_measures(nested: DataFrame) -> DataFrame:
    """Replace the nested components by their counts and line sums.

    Only single fields of the components are touched, so a columnar scan skips the long texts.
    """
    return nested.withColumns(
        {
            "commits_count": count_of(F.map_keys("commits")),
            "comments_count": count_of(F.col("pr_comments.id")),
            "files_count": count_of(F.col("files.filename")),
            "additions": _sum_of(F.col("files.additions")),
            "deletions": _sum_of(F.col("files.deletions")),
            "changes": _sum_of(F.col("files.changes")),
        }
    ).drop("commits", "pr_comments", "files")


def join_measures(prs: DataFrame, counts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Measures from separately aggregated children, without any nested record."""
    result = prs
    for part in counts:
        result = result.join(part, list(key), "left")
    return result.fillna(0, subset=list(MEASURES))


def flatten(flat: DataFrame) -> DataFrame:
    """The 24 CSV columns of records with measures."""
    return flat.withColumns(
        {
            "repository_language": X.join_with("|", F.col("repository_language")),
            "tags": X.join_with("|", F.col("tags")),
            "description": X.cut(F.col("description"), X.DESCRIPTION_LIMIT, X.DESCRIPTION_SUFFIX),
        }
    ).select(*CSV_COLUMNS)


def count_by(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count per value, largest first, value as tie-break."""
    return count_by(df, column).orderBy(F.col("count").desc(), column)


def language_distribution(nested: DataFrame) -> DataFrame:
    """Each pull request once per language; language lists are counted before they are split."""
    lists = count_by(nested, "repository_language", "_n")
    return (
        lists.select(F.explode("repository_language").alias("language"), "_n")
        .groupBy("language")
        .agg(F.sum("_n").alias("count"))
        .orderBy(F.col("count").desc(), "language")
    )


def languages_of_repositories(prs: DataFrame, repositories: DataFrame) -> DataFrame:
    """``language_distribution`` before repositories are joined to pull requests.

    Pull requests are counted per repository first, so a huge repository joins as one row.
    """
    counted = prs.groupBy("repository_full_name").agg(F.count(F.lit(1)).alias("_n"))
    languages = each(
        repositories,
        [F.col("full_name").alias("repository_full_name")],
        F.col("languages"),
        "language",
    )
    return (
        counted.join(languages, "repository_full_name")
        .groupBy("language")
        .agg(F.sum("_n").alias("count"))
        .orderBy(F.col("count").desc(), "language")
    )


def top_values(df: DataFrame, column: str, n: int, missing: str | None = None) -> DataFrame:
    """The ``n`` most frequent values; nulls are skipped, or named when ``missing`` is given."""
    if missing is None:
        kept = df.filter(F.col(column).isNotNull())
    else:
        kept = df.withColumn(column, F.coalesce(F.col(column), F.lit(missing)))
    return distribution(kept, column).limit(n)


def top_authors(df: DataFrame, n: int = 10) -> DataFrame:
    return top_values(df, "author", n, UNKNOWN_AUTHOR)


def totals(flat: DataFrame) -> DataFrame:
    return flat.agg(
        *[
            F.coalesce(F.sum(measure), F.lit(0)).alias(f"total_{name}")
            for measure, name in zip(MEASURES, MEASURE_NAMES, strict=True)
        ]
    )


def averages(flat: DataFrame) -> DataFrame:
    return flat.agg(
        *[
            (F.sum(measure) / F.count(F.lit(1))).alias(f"avg_{name}_per_pr")
            for measure, name in zip(MEASURES, MEASURE_NAMES, strict=True)
        ]
    )


def repository_summary(df: DataFrame) -> DataFrame:
    """Pull requests per repository, by name."""
    return count_by(df, "repository_name").orderBy("repository_name")


def change_type_confidence(df: DataFrame) -> DataFrame:
    """Count and mean confidence per change type; sums are decimal, so order does not matter."""
    confidence = F.coalesce(F.col("change_type_confidence"), F.lit(0.0)).cast("decimal(18,6)")
    return (
        df.groupBy("change_type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            (F.sum(confidence).cast("double") / F.count(F.lit(1))).alias("avg_confidence"),
        )
        .orderBy("change_type")
    )


def statistics(flat: DataFrame) -> DataFrame:
    """All statistics of a save (records with measures) as rows of (metric, key, value).

    Every record gives one (metric, key, amount) row per value it counts under; these are summed
    in one pre-aggregated pass. Only the top authors need a second, single-column pass.
    """
    def row(metric: str, key: Column, amount: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), key.alias("key"), amount.cast("bigint").alias("amount")
        )

    one = F.lit(1)
    rows = F.concat(
        F.array(
            row("repository_distribution", F.col("repository_name"), one),
            row("change_type_distribution", F.col("change_type"), one),
            *[
                row("aggregate_stats", F.lit(name), F.col(measure))
                for measure, name in zip(MEASURES, MEASURE_NAMES, strict=True)
            ],
        ),
        F.transform(
            F.coalesce(F.col("repository_language"), F.array().cast("array<string>")),
            lambda language: row("language_distribution", language, one),
        ),
    )
    summed = (
        each(flat, [], rows, "_r")
        .groupBy("_r.metric", "_r.key")
        .agg(F.sum("_r.amount").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    )
    total = F.col("_sum").cast("double")
    values = F.when(
        F.col("metric") == "aggregate_stats",
        F.array(
            F.struct(F.concat(F.lit("total_"), "key").alias("key"), total.alias("value")),
            F.struct(
                F.concat(F.lit("avg_"), "key", F.lit("_per_pr")).alias("key"),
                (total / F.col("_n")).alias("value"),
            ),
        ),
    ).otherwise(F.array(F.struct(F.col("key"), total.alias("value"))))
    authors = top_authors(flat.select("author")).select(
        F.lit("top_authors").alias("metric"),
        F.col("author").alias("key"),
        F.col("count").cast("double").alias("value"),
    )
    return (
        each(summed, ["metric"], values, "_v")
        .select("metric", "_v.key", "_v.value")
        .unionByName(authors)
    )


def with_presence(nested: DataFrame, presence: str = "nonempty") -> DataFrame:
    """``has_commits``, ``has_comments``, ``has_files`` of nested records.

    ``nonempty`` asks for content, ``key`` only for the field to be there.
    """

    def has(column: str) -> Column:
        items = F.col(column)
        if presence == "key":
            return items.isNotNull()
        return F.coalesce(F.when(items.isNotNull(), F.size(items) > 0), F.lit(False))

    return nested.withColumns(
        {
            "has_commits": has("commits"),
            "has_comments": has("pr_comments"),
            "has_files": has("files"),
        }
    )


def coverage(records: DataFrame) -> DataFrame:
    """Total, distinct and per-component counts over records with ``has_*`` flags."""
    commits, comments, files = (
        F.col(f"has_{name}") for name in ("commits", "comments", "files")
    )
    return records.agg(
        F.count(F.lit(1)).alias("total_prs"),
        F.count_distinct("id").alias("unique_prs"),
        F.count_if(files).alias("prs_with_files"),
        F.count_if(comments).alias("prs_with_comments"),
        F.count_if(commits).alias("prs_with_commits"),
        F.count_if(files & comments & commits).alias("prs_with_all_components"),
    )


def percentage(part: Column, whole: Column) -> Column:
    """Percent with two decimals, 0 for an empty whole."""
    return F.when(whole > 0, F.round(100.0 * part / whole, 2)).otherwise(F.lit(0.0))


def coverage_percentages(records: DataFrame) -> DataFrame:
    counted = coverage(records)
    parts = [c for c in counted.columns if c.startswith("prs_with_")]
    return counted.select(
        "*", *[percentage(F.col(c), F.col("total_prs")).alias(f"{c}_pct") for c in parts]
    )


def distinct_per_repository(records: DataFrame) -> DataFrame:
    """Distinct ids per repository name; a missing name is a group of its own."""
    return records.groupBy("repository_name").agg(F.count_distinct("id").alias("unique_prs"))


def distinct_totals(records: DataFrame) -> DataFrame:
    return distinct_per_repository(records).agg(
        F.count(F.lit(1)).alias("total_repositories"),
        F.coalesce(F.sum("unique_prs"), F.lit(0)).alias("total_prs"),
    )

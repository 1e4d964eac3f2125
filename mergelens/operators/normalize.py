"""Landed API items to flat records, valid rows apart from rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions import text as X

# Child rows carry the page position of their item; it orders them within a pull request.
POSITION = "seq"


def normalize_repositories(items: DataFrame) -> DataFrame:
    """Repository items (column ``item``) to flat records; absent languages become empty."""
    item = F.col("item")
    languages = (
        F.coalesce(F.col("languages"), F.array().cast("array<string>"))
        if "languages" in items.columns
        else F.array().cast("array<string>")
    )
    return items.select(
        item["name"].alias("name"),
        item["full_name"].alias("full_name"),
        item["html_url"].alias("url"),
        languages.alias("languages"),
        item["stargazers_count"].alias("stars"),
        item["forks_count"].alias("forks"),
        F.coalesce(item["description"], F.lit("")).alias("description"),
        item["size"].alias("size_kb"),
        item["fork"].alias("is_fork"),
        item["archived"].alias("is_archived"),
        item["created_at"].alias("created_at"),
        item["updated_at"].alias("updated_at"),
        X.strip_pulls_template(item["pulls_url"]).alias("pulls_url"),
    )


def repository_languages(languages: Column) -> Column:
    """Names of a ``{language: bytes}`` object; an unreadable one gives an empty list."""
    return F.coalesce(F.map_keys(languages), F.array().cast("array<string>"))


def normalize_pull_requests(items: DataFrame) -> DataFrame:
    """Pull-request items (columns ``repository_full_name``, ``item``) to flat records."""
    item = F.col("item")
    return items.select(
        X.pull_request_id(F.col("repository_full_name"), item["number"]).alias("id"),
        "repository_full_name",
        item["number"].alias("pr_number"),
        item["title"].alias("title"),
        item["body"].alias("body"),
        item["state"].alias("pr_state"),
        item["created_at"].alias("created_at"),
        item["updated_at"].alias("updated_at"),
        item["merged_at"].alias("merged_at"),
        item["user"]["login"].alias("author"),
        F.coalesce(item["draft"], F.lit(False)).alias("draft"),
        item["mergeable_state"].alias("mergeable_state"),
        item["comments"].alias("popularity"),
        F.transform(
            F.coalesce(item["labels"], F.array().cast("array<struct<name:string>>")),
            lambda label: label["name"],
        ).alias("labels"),
    )


def normalize_commits(items: DataFrame, *keys: str) -> DataFrame:
    item = F.col("item")
    return items.select(
        *keys,
        POSITION,
        item["sha"].alias("sha"),
        item["commit"]["message"].alias("message"),
        item["commit"]["author"]["name"].alias("author"),
        item["commit"]["author"]["date"].alias("date"),
    )


def normalize_comments(items: DataFrame, comment_type: str, *keys: str) -> DataFrame:
    """Issue or review comments; ids become text, a missing user an empty author."""
    item = F.col("item")
    position = item["position"] if comment_type == "review" else F.lit(None).cast("bigint")
    return items.select(
        *keys,
        POSITION,
        item["id"].cast("string").alias("id"),
        item["body"].alias("body"),
        F.coalesce(item["user"]["login"], F.lit("")).alias("author"),
        item["created_at"].alias("date"),
        F.lit(comment_type).alias("type"),
        position.alias("position"),
    )


def normalize_files(items: DataFrame, *keys: str) -> DataFrame:
    """File items given as maps: absent numbers become 0 and an absent patch ``""``.

    A field that is present and null stays null.
    """
    item = F.col("item")

    def number(name: str) -> Column:
        return (
            F.when(F.map_contains_key(item, name), F.element_at(item, name).cast("bigint"))
            .otherwise(F.lit(0).cast("bigint"))
            .alias(name)
        )

    return items.select(
        *keys,
        POSITION,
        F.element_at(item, "filename").alias("filename"),
        F.element_at(item, "status").alias("status"),
        number("additions"),
        number("deletions"),
        number("changes"),
        F.when(F.map_contains_key(item, "patch"), F.element_at(item, "patch"))
        .otherwise(F.lit(""))
        .alias("patch"),
    )


def with_timestamps(df: DataFrame, *columns: str, suffix: str = "_ts") -> DataFrame:
    """Typed copies of ISO-8601 text columns; unreadable text becomes null."""
    return df.withColumns({f"{c}{suffix}": F.try_to_timestamp(F.col(c)) for c in columns})


def with_reject_reason(df: DataFrame, required: dict[str, str]) -> DataFrame:
    """Add ``reject_reason``: the first required column that is null, as its given text."""
    reason = F.lit(None).cast("string")
    for name, text in reversed(required.items()):
        reason = F.when(F.col(name).isNull(), F.lit(text)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


# A pull request cannot be processed without these.
REQUIRED_PULL_REQUEST = {
    "pr_number": "missing number",
    "title": "missing title",
    "author": "missing author",
}


def split_rejects(
    df: DataFrame, required: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    marked = with_reject_reason(df, required or REQUIRED_PULL_REQUEST)
    valid = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, marked.filter(F.col("reject_reason").isNotNull())


def reject_summary(df: DataFrame, required: dict[str, str] | None = None) -> DataFrame:
    """Rows per (status, reason)."""
    marked = with_reject_reason(df, required or REQUIRED_PULL_REQUEST)
    return marked.groupBy(
        F.when(F.col("reject_reason").isNull(), F.lit("valid"))
        .otherwise(F.lit("rejected"))
        .alias("status"),
        F.coalesce(F.col("reject_reason"), F.lit("")).alias("reason"),
    ).agg(F.count(F.lit(1)).alias("count"))

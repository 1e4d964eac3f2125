"""Scalar text expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes and limits of stored text.
PATCH_SUFFIX = "... [truncated]"
PATCH_LIMIT = 10_000
DESCRIPTION_SUFFIX = "..."
DESCRIPTION_LIMIT = 500
TAG_DRAFT = "draft"
TAG_CONFLICT = "merge-conflict"
CONFLICT_STATE = "dirty"
PULLS_URL_TEMPLATE = "{/number}"

# White space as a Unicode-aware split sees it.
_SPACE = r"[\s\x1c-\x1f]"
_WORD = r"[^\s\x1c-\x1f]"


def lower_or_empty(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def cut(text: Column, limit: int, suffix: str) -> Column:
    """The text, or its first ``limit`` characters and a suffix when it is longer."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(suffix))
    ).otherwise(text)


def truncate_patch(patch: Column, limit: int = PATCH_LIMIT) -> Column:
    return cut(patch, limit, PATCH_SUFFIX)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(word)) for word in words))


def more_words_than(text: Column, count: int) -> Column:
    """True when the text has more than ``count`` words; stops reading at that word.

    A null text has no words.
    """
    pattern = f"(?U)^{_SPACE}*+(?:{_WORD}++{_SPACE}++){{{count}}}{_WORD}"
    return F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False))


def search(text: Column, pattern: str) -> Column:
    """Regular-expression search with Unicode word boundaries, digits and spaces.

    Texts without the letters that the pattern begins with are not given to it.
    """
    found = F.rlike(text, F.lit("(?U)" + pattern))
    needed = needed_letters(pattern)
    return F.contains(text, F.lit(needed)) & found if needed else found


def needed_letters(pattern: str) -> str:
    """Plain letters at the start of a pattern that every match has; empty if none are known."""
    start = re.match(r"(?:\\b)?([A-Za-z0-9 ]+)(.?)", pattern, re.DOTALL)
    if not start or "|" in pattern:
        return ""
    return start[1][:-1] if start[2] in ("?", "*", "{") and start[2] else start[1]


def strip_pulls_template(url: Column) -> Column:
    return F.replace(F.coalesce(url, F.lit("")), F.lit(PULLS_URL_TEMPLATE), F.lit(""))


def pull_request_id(full_name: Column, number: Column) -> Column:
    """``{full_name}_{number}``; null if either is, so such rows never pass for one another."""
    return F.concat(full_name, F.lit("_"), number.cast("string"))


def stable_key(*parts: Column) -> Column:
    """md5 of the parts joined by ``|``."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))


def repository_languages_key(full_name: Column) -> Column:
    return stable_key(F.lit("repo_languages"), full_name)


def pull_request_data_key(full_name: Column, number: Column) -> Column:
    return stable_key(F.lit("pr_data"), full_name, number)


def tags(labels: Column, draft: Column, mergeable_state: Column) -> Column:
    """Distinct label names plus inferred tags, ascending.

    ``labels`` is an array of names; null and empty names are ignored.
    """
    named = F.filter(
        F.coalesce(labels, F.array().cast("array<string>")),
        lambda name: name.isNotNull() & (name != ""),
    )
    inferred = F.array_compact(
        F.array(
            F.when(draft, F.lit(TAG_DRAFT)),
            F.when(mergeable_state == CONFLICT_STATE, F.lit(TAG_CONFLICT)),
        )
    )
    return F.array_sort(F.array_distinct(F.concat(named, inferred)))


def decode_content(content: Column, encoding: Column) -> Column:
    """Base64 file content as UTF-8 text; anything else gives an empty string."""
    raw = F.try_to_binary(F.regexp_replace(content, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return F.when(
        (encoding == "base64") & F.coalesce(F.is_valid_utf8(raw.cast("string")), F.lit(False)),
        raw.cast("string"),
    ).otherwise(F.lit(""))


def join_with(separator: str, items: Column) -> Column:
    return F.concat_ws(separator, items)


def total(parts: Sequence[Column]) -> Column:
    """Sum of integer columns."""
    return reduce(lambda a, b: a + b, parts, F.lit(0))

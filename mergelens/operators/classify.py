"""Change-type classification of pull requests.

``score_pull_requests`` works on child rows: points are summed per commit row before the shuffle,
so no message list is ever built. ``classify_nested`` works on assembled records and also gives
the ordered reasons; it needs no shuffle at all. Both use the same expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.functions import rules as R
from mergelens.functions import scoring as S
from mergelens.functions import text as X
from mergelens.functions.arrays import each
from mergelens.functions.rules import DEFAULT_RULES, RuleSet
from mergelens.operators.children import DEFAULT_CAP, DEFAULT_KEY, cap_commits
from mergelens.operators.normalize import POSITION

_PROFILE = ("urgent", "refactor", "test")


def profile_commits(
    commits: DataFrame, key: Sequence[str] = DEFAULT_KEY, cap: int = DEFAULT_CAP
) -> DataFrame:
    """Commits per word list, total and mean message length, per pull request.

    All commits up to the cap count, as in the classifier; a repeated sha counts each time.
    """
    lowered = F.lower(F.col("message"))
    # Messages are read before the cap, so that only lengths and flags are ranked and moved.
    narrow = commits.select(
        *key,
        POSITION,
        F.length("message").alias("_length"),
        *[flag.alias(name) for name, flag in S.commit_profile_flags(lowered).items()],
    )
    flags = cap_commits(narrow, key, cap)
    return flags.groupBy(*key).agg(
        *[F.count_if(F.col(name)).alias(f"{name}_commits") for name in _PROFILE],
        F.count(F.lit(1)).alias("total_commits"),
        (F.sum("_length") / F.count(F.lit(1))).alias("avg_commit_length"),
    )


def _commit_points(
    commits: DataFrame, key: Sequence[str], rules: RuleSet, cap: int
) -> DataFrame:
    """Pattern hits per type and profile counts, summed over the commits of a pull request.

    All commits up to the cap are scored; ``commits_count`` is the number of distinct ones.
    """
    rows = cap_commits(commits.select(*key, POSITION, "sha", "message"), key, cap).withColumn(
        "_text", F.lower(F.col("message"))
    )
    hits = rows.select(
        *key,
        "sha",
        *[
            S.commit_hits(F.col("_text"), typed.commit_patterns).alias(f"commit_{name}")
            for name, typed in rules.types.items()
        ],
        *[flag.alias(name) for name, flag in S.commit_profile_flags(F.col("_text")).items()],
    )
    return hits.groupBy(*key).agg(
        *[F.sum(f"commit_{name}").alias(f"commit_{name}") for name in rules.types],
        *[F.count_if(F.col(name)).alias(f"{name}_commits") for name in _PROFILE],
        F.count(F.lit(1)).alias("total_commits"),
        F.size(F.collect_set("sha")).alias("commits_count"),
    )


def own_text(prs: DataFrame, rules: RuleSet) -> DataFrame:
    """Add the hits that need only the pull request itself."""
    lowered = prs.withColumns(
        {
            "_title": X.lower_or_empty(F.col("title")),
            "_body": X.lower_or_empty(F.col("body")),
            "_labels": S.lowered(F.col("labels")),
        }
    ).withColumn("_combined", F.concat_ws(" ", "_title", "_body"))
    title, body, combined = F.col("_title"), F.col("_body"), F.col("_combined")
    coded = lowered.withColumn("_keywords", S.keyword_codes(title, combined, rules))
    flags = S.metadata_flags(title, body, combined, F.col("_keywords"), rules)
    found = coded.withColumns({f"_{name}": flag.cast("int") for name, flag in flags.items()})
    found = found.drop("_title", "_body", "_combined")
    hits: dict[str, Column] = {}
    for name, (in_title, anywhere) in S.keyword_counts(F.col("_keywords"), rules).items():
        hits[f"_label_{name}"] = S.label_hits(F.col("_labels"), rules.types[name].labels)
        hits[f"_title_{name}"] = in_title
        hits[f"_any_{name}"] = anywhere
    return found.withColumns(hits)


def _profile_bonus() -> dict[str, list[tuple[Column, int, str]]]:
    """(condition, points, reason) of the commit profile, per type."""
    urgent, refactor, test = (F.col(f"{name}_commits") for name in _PROFILE)
    return {
        "fix": [(urgent > 0, R.URGENT_POINTS, R.REASON_URGENT)],
        "feature": [
            (test * 2 > F.col("total_commits"), R.TEST_POINTS, R.REASON_TEST),
            (refactor > 0, R.REFACTOR_POINTS, R.REASON_REFACTOR),
        ],
    }


def _metadata_bonus() -> dict[str, list[tuple[str, int, str]]]:
    return {
        "fix": [("_short_title", R.SHORT_TITLE_POINTS, R.REASON_SHORT_TITLE)],
        "feature": [("_long_body", R.LONG_BODY_POINTS, R.REASON_LONG_BODY)],
        "doc": [("_doc_words", R.DOC_WORD_POINTS, R.REASON_DOC_WORDS)],
    }


def _points(rules: RuleSet, commit_profile: bool) -> dict[str, Column]:
    points = {}
    for name in rules.types:
        title, found = F.col(f"_title_{name}"), F.col(f"_any_{name}")
        parts = [
            F.col(f"_label_{name}") * R.LABEL_POINTS,
            title * R.TITLE_KEYWORD_POINTS,
            (found - title) * R.BODY_KEYWORD_POINTS,
            F.col(f"commit_{name}") * R.COMMIT_POINTS,
        ]
        parts += [F.col(flag) * n for flag, n, _ in _metadata_bonus().get(name, [])]
        if commit_profile:
            parts += [
                F.when(test, n).otherwise(0) for test, n, _ in _profile_bonus().get(name, [])
            ]
        points[name] = X.total(parts).cast("bigint")
    return points


def _count_reasons(rules: RuleSet, commit_profile: bool, similarity: bool) -> Column:
    parts = []
    for name in rules.types:
        parts += [F.col(f"_label_{name}"), F.col(f"_any_{name}"), F.col(f"commit_{name}")]
        parts += [F.col(flag) for flag, _, _ in _metadata_bonus().get(name, [])]
        if commit_profile:
            parts += [F.when(t, 1).otherwise(0) for t, _, _ in _profile_bonus().get(name, [])]
    if similarity:
        parts.append(F.lit(len(rules.types)))
    return X.total(parts)


def score_pull_requests(
    prs: DataFrame,
    commits: DataFrame | None,
    key: Sequence[str] = DEFAULT_KEY,
    rules: RuleSet = DEFAULT_RULES,
    threshold: float = R.CONFIDENCE_THRESHOLD,
    cap: int = DEFAULT_CAP,
    commit_profile: bool = False,
    similarity: DataFrame | None = None,
) -> DataFrame:
    """Add ``points_*``, ``change_type``, ``change_type_confidence`` and ``reason_count``.

    The body is dropped as soon as its points are known, so long texts are never joined.
    ``commits_count`` is the number of distinct commits among those that were looked at.
    ``similarity`` has the key columns and one cosine column ``similarity_*`` per type.
    """
    own = own_text(prs, rules).drop("body", "_labels", "_keywords")
    names = list(rules.types)
    filled = [f"commit_{n}" for n in names] + [f"{p}_commits" for p in _PROFILE]
    filled += ["total_commits", "commits_count"]
    if commits is None:
        own = own.withColumns({name: F.lit(0) for name in filled})
    else:
        own = own.join(_commit_points(commits, key, rules, cap), list(key), "left")
        own = own.fillna(0, subset=filled)
    if similarity is not None:
        own = own.join(similarity, list(key), "left")
    points = _points(rules, commit_profile)
    scored = own.withColumns({f"points_{name}": value for name, value in points.items()})
    return _decided(scored, rules, threshold, commit_profile, similarity is not None).select(
        *[c for c in prs.columns if c not in ("body", "labels")],
        *[f"points_{name}" for name in names],
        "change_type",
        "change_type_confidence",
        "reason_count",
        F.col("commits_count").cast("bigint").alias("commits_count"),
    )


def _decided(
    scored: DataFrame, rules: RuleSet, threshold: float, commit_profile: bool, similarity: bool
) -> DataFrame:
    if similarity:
        scores = {
            name: F.col(f"points_{name}") / 100.0
            + F.coalesce(F.col(f"similarity_{name}"), F.lit(0.0)) * R.SIMILARITY_WEIGHT
            for name in rules.types
        }
        chosen, top = S.decide(scores, threshold, 1.0)
        confidence = top
    else:
        chosen, top = S.decide(
            {name: F.col(f"points_{name}") for name in rules.types}, threshold, 100.0
        )
        confidence = top / 100.0
    defaulted = (confidence < threshold).cast("int")
    return scored.withColumns(
        {
            "change_type": chosen,
            "change_type_confidence": confidence,
            "reason_count": (
                _count_reasons(rules, commit_profile, similarity) + defaulted
            ).cast("bigint"),
        }
    )


def classify_nested(
    df: DataFrame,
    rules: RuleSet = DEFAULT_RULES,
    threshold: float = R.CONFIDENCE_THRESHOLD,
    analyze_commits: bool = True,
    commit_profile: bool = False,
    similarity: bool = False,
) -> DataFrame:
    """Add ``change_type``, ``change_type_confidence`` and ``change_type_reasons``.

    Needs ``title``, ``body``, ``labels`` and ``commit_messages``; with ``similarity`` also one
    ``similarity_*`` column per type. What ``own_text`` has added before is not searched again.
    """
    own = df if "_keywords" in df.columns else own_text(df, rules)
    messages = (
        S.lowered(F.col("commit_messages")) if analyze_commits else F.array().cast("array<string>")
    )
    own = own.withColumn("_messages", messages)
    own = own.withColumn("_patterns", S.commit_codes(F.col("_messages"), rules))
    counts: dict[str, Column] = {
        f"commit_{name}": count
        for name, count in S.commit_counts(F.col("_patterns"), rules).items()
    }
    for word_list in _PROFILE:
        counts[f"{word_list}_commits"] = S.profile_count(F.col("_messages"), word_list)
    counts["total_commits"] = F.size("_messages")
    own = own.withColumns(counts)
    scored = own.withColumns(
        {f"points_{name}": value for name, value in _points(rules, commit_profile).items()}
    )
    decided = _decided(scored, rules, threshold, commit_profile, similarity)
    tail: list[Column] = []
    if similarity:
        for name in rules.types:
            prefix = R.REASON_SIMILARITY.format(type=name, value="")
            cosine = F.coalesce(F.col(f"similarity_{name}"), F.lit(0.0))
            tail.append(F.concat(F.lit(prefix), F.format_string("%.2f", cosine)))
    if commit_profile:
        for bonus in _profile_bonus().values():
            tail += [F.when(test, F.lit(reason)) for test, _, reason in bonus]
    for bonus in _metadata_bonus().values():
        tail += [F.when(F.col(flag) == 1, F.lit(reason)) for flag, _, reason in bonus]
    tail.append(F.when(F.col("change_type_confidence") < threshold, F.lit(R.REASON_DEFAULT)))
    reasons = F.concat(
        S.label_reasons(F.col("_labels"), rules),
        S.keyword_reasons(F.col("_keywords"), rules),
        S.commit_reasons(F.col("_patterns"), rules),
        F.array_compact(F.array(*tail)),
    )
    return decided.withColumn("change_type_reasons", reasons).select(
        *df.columns,
        *[f"points_{name}" for name in rules.types],
        "change_type",
        "change_type_confidence",
        "change_type_reasons",
    )


def classify_basic(prs: DataFrame) -> DataFrame:
    """Keyword-only fallback with a fixed confidence."""
    return prs.withColumns(
        {
            "change_type": S.basic_type(F.col("title"), F.col("body")),
            "change_type_confidence": F.lit(R.BASIC_CONFIDENCE),
            "change_type_reasons": F.array(F.lit(R.REASON_BASIC)),
        }
    )


def count_rule_hits(
    prs: DataFrame,
    commits: DataFrame,
    key: Sequence[str] = DEFAULT_KEY,
    rules: RuleSet = DEFAULT_RULES,
    cap: int = DEFAULT_CAP,
) -> DataFrame:
    """Hits and points of every rule that matched anything.

    Texts are matched in place; only numbers of matched rules are sent and counted, and label
    names are counted before they are matched. Rules are attached to the few counts at the end.
    """
    names = (
        each(prs, [], S.lowered(F.col("labels")), "_name")
        .groupBy("_name")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    texts = prs.select(
        X.lower_or_empty(F.col("title")).alias("_title"),
        X.lower_or_empty(F.col("body")).alias("_body"),
    ).select("_title", F.concat_ws(" ", "_title", "_body").alias("_combined"))
    messages = cap_commits(commits.select(*key, POSITION, "message"), key, cap)
    one = F.lit(1).cast("bigint").alias("_n")
    codes = {
        "label": each(names, ["_n"], S.label_codes(F.col("_name"), rules), "code"),
        "keyword": each(
            texts, [one], S.keyword_codes(F.col("_title"), F.col("_combined"), rules), "code"
        ),
        "commit": each(
            messages, [one], S.commit_codes(F.array(F.lower("message")), rules), "code"
        ),
    }
    parts = [df.withColumn("source", F.lit(source)) for source, df in codes.items()]
    counted = (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .groupBy("source", "code")
        .agg(F.sum("_n").alias("_n"))
    )
    table = prs.sparkSession.createDataFrame(
        S.code_table(rules),
        "source string, code int, change_type string, pattern string, weight int",
    )
    return (
        counted.join(table, ["source", "code"])
        .groupBy("change_type", "source", "pattern")
        .agg(
            F.sum("_n").alias("hits"), F.sum(F.col("_n") * F.col("weight")).alias("points")
        )
    )

"""Change-type points, decision and reasons as column expressions.

Scores are whole hundredths, so sums do not depend on order or partitioning. Labels are an array
of names, commits an array of messages; both are short per pull request. For messages that are
rows of their own, see ``commit_points`` and the row form in ``operators.classify``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergelens.functions import keywords
from mergelens.functions import rules as R
from mergelens.functions import text as X
from mergelens.functions.rules import RuleSet


def _count(conditions: list[Column]) -> Column:
    return X.total([F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in conditions])


def _fold(items: Column, hits) -> Column:
    """Sum of ``hits(item)`` over an array."""
    return F.aggregate(items, F.lit(0), lambda acc, item: acc + hits(item))


def lowered(names: Column) -> Column:
    """Lower-cased names; null entries and a null array vanish."""
    return F.transform(
        F.array_compact(F.coalesce(names, F.array().cast("array<string>"))), F.lower
    )


def label_hits(labels: Column, patterns: tuple[str, ...]) -> Column:
    """Number of (label, pattern) pairs where the label contains the pattern."""
    return _fold(
        labels, lambda name: _count([F.contains(name, F.lit(p)) for p in patterns])
    )


def keyword_codes(title: Column, combined: Column, rules: RuleSet) -> Column:
    """Found keywords as an array of codes, in rule order.

    The code is twice the number of the keyword, plus one when the title has it. All keywords are
    searched in one pass over a text; counts and reasons are read off the codes.
    """
    return keywords.keyword_codes(title, combined, _all_keywords(rules))


def _all_keywords(rules: RuleSet) -> list[str]:
    return [keyword for typed in rules.types.values() for keyword in typed.keywords]


def _all_patterns(rules: RuleSet) -> list[tuple[str, str]]:
    return [(name, p) for name, typed in rules.types.items() for p in typed.commit_patterns]


def _ranges(sizes: dict[str, int]) -> dict[str, tuple[int, int]]:
    """First and one-past-last number of each type."""
    ranges, start = {}, 0
    for name, size in sizes.items():
        ranges[name] = (start, start + size)
        start += size
    return ranges


def keyword_counts(codes: Column, rules: RuleSet) -> dict[str, tuple[Column, Column]]:
    """Per type: keywords found in the title, keywords found anywhere."""
    ranges = _ranges({name: len(typed.keywords) for name, typed in rules.types.items()})

    def of_range(first: int, last: int) -> tuple[Column, Column]:
        def within(code: Column) -> Column:
            return (code >= 2 * first) & (code < 2 * last)

        return (
            F.size(F.filter(codes, lambda code: within(code) & (code % 2 == 1))),
            F.size(F.filter(codes, within)),
        )

    return {name: of_range(*limits) for name, limits in ranges.items()}


def label_codes(label: Column, rules: RuleSet) -> Column:
    """Numbers of the label patterns contained in one lower-cased label."""
    patterns = [p for typed in rules.types.values() for p in typed.labels]
    return F.array_compact(
        F.array(*[F.when(F.contains(label, F.lit(p)), F.lit(i)) for i, p in enumerate(patterns)])
    )


def code_table(rules: RuleSet) -> list[tuple[str, int, str, str, int]]:
    """(source, code, change type, pattern, points) of every code of this module."""
    rows = []
    numbers = dict.fromkeys(("label", "keyword", "commit"), 0)
    for rule in rules.flat():
        number = numbers[rule.source]
        numbers[rule.source] += 1
        name, pattern = rule.change_type, rule.pattern
        if rule.source == "keyword":
            rows.append(("keyword", 2 * number, name, pattern, R.BODY_KEYWORD_POINTS))
            rows.append(("keyword", 2 * number + 1, name, pattern, R.TITLE_KEYWORD_POINTS))
        else:
            points = R.LABEL_POINTS if rule.source == "label" else R.COMMIT_POINTS
            rows.append((rule.source, number, name, pattern, points))
    return rows


def commit_codes(messages: Column, rules: RuleSet) -> Column:
    """Numbers of the patterns found in lower-cased messages, message by message."""
    patterns = _all_patterns(rules)

    def of_message(message: Column) -> Column:
        return F.array_compact(
            F.array(
                *[F.when(X.search(message, p), F.lit(i)) for i, (_, p) in enumerate(patterns)]
            )
        )

    return F.flatten(F.transform(messages, of_message))


def commit_counts(codes: Column, rules: RuleSet) -> dict[str, Column]:
    """Pattern hits per type."""
    ranges = _ranges({name: len(typed.commit_patterns) for name, typed in rules.types.items()})

    def of_range(first: int, last: int) -> Column:
        return F.size(F.filter(codes, lambda code: (code >= first) & (code < last)))

    return {name: of_range(*limits) for name, limits in ranges.items()}


def commit_hits(message: Column, patterns: tuple[str, ...]) -> Column:
    """Number of patterns found in one lower-cased message."""
    return _count([X.search(message, p) for p in patterns])


def commit_profile_flags(message: Column) -> dict[str, Column]:
    """Which of the profile word lists a lower-cased message touches."""
    return {
        "urgent": X.contains_any(message, R.URGENT_WORDS),
        "refactor": X.contains_any(message, R.REFACTOR_WORDS),
        "test": X.contains_any(message, R.TEST_WORDS),
    }


def profile_count(messages: Column, word_list: str) -> Column:
    """Number of lower-cased messages that touch a profile word list."""
    return F.size(F.filter(messages, lambda message: commit_profile_flags(message)[word_list]))


def _found(words: tuple[str, ...], text: Column, codes: Column, rules: RuleSet, title: bool) -> Column:
    """Whether a text has any of the words, read off the keyword codes where these have them."""
    numbers = {keyword: 2 * i for i, keyword in enumerate(_all_keywords(rules))}
    if any(word not in numbers for word in words):
        return X.contains_any(text, words)
    wanted = [numbers[w] + place for w in words for place in ((1,) if title else (0, 1))]
    return F.arrays_overlap(codes, F.array(*map(F.lit, wanted)))


def metadata_flags(
    title: Column, body: Column, combined: Column, codes: Column, rules: RuleSet
) -> dict[str, Column]:
    """Short fix title, long description, documentation words; ``codes`` of ``keyword_codes``."""
    return {
        "short_title": ~X.more_words_than(title, R.SHORT_TITLE_WORDS)
        & _found(R.SHORT_TITLE_FIX_WORDS, title, codes, rules, True),
        "long_body": X.more_words_than(body, R.LONG_BODY_WORDS),
        "doc_words": _found(R.DOC_WORDS, combined, codes, rules, False),
    }


def decide(points: dict[str, Column], threshold: float, scale: float) -> tuple[Column, Column]:
    """(change type, top score); ties go to the first type, weak scores to the default."""
    top = F.greatest(*points.values())
    chosen = F.when(top < F.lit(threshold * scale), F.lit(R.DEFAULT_TYPE))
    for name, value in points.items():
        chosen = chosen.when(value == top, F.lit(name))
    return chosen, top


def label_reasons(labels: Column, rules: RuleSet) -> Column:
    def of_type(name: str, patterns: tuple[str, ...]) -> Column:
        prefix, suffix = R.REASON_LABEL.format(label="\0", type=name).split("\0")

        def of_label(label: Column) -> Column:
            text = F.concat(F.lit(prefix), label, F.lit(suffix))
            return F.array_compact(
                F.array(*[F.when(F.contains(label, F.lit(p)), text) for p in patterns])
            )

        return F.flatten(F.transform(labels, of_label))

    return F.concat(*[of_type(name, typed.labels) for name, typed in rules.types.items()])


def _texts_of(codes: Column, texts: list[str]) -> Column:
    lookup = F.array(*map(F.lit, texts))
    return F.transform(codes, lambda code: F.element_at(lookup, code + 1))


def keyword_reasons(codes: Column, rules: RuleSet) -> Column:
    texts = [
        R.REASON_KEYWORD.format(keyword=keyword, place=place)
        for keyword in _all_keywords(rules)
        for place in ("body", "title")
    ]
    return _texts_of(codes, texts)


def commit_reasons(codes: Column, rules: RuleSet) -> Column:
    texts = [
        R.REASON_COMMIT.format(pattern=p, type=name) for name, p in _all_patterns(rules)
    ]
    return _texts_of(codes, texts)


def basic_type(title: Column, body: Column) -> Column:
    """Keyword-only fallback."""
    title, body = X.lower_or_empty(title), X.lower_or_empty(body)

    def either(words: tuple[str, ...]) -> Column:
        return X.contains_any(title, words) | X.contains_any(body, words)

    return (
        F.when(either(R.BASIC_FIX_WORDS), F.lit("fix"))
        .when(either(R.BASIC_DOC_WORDS), F.lit("doc"))
        .otherwise(F.lit(R.DEFAULT_TYPE))
    )

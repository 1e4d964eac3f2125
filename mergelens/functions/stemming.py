"""Porter's 1980 suffix-stripping algorithm as expressions over an array of lower-case words.

Each step is one ``transform`` over the array, so every word is bound once per step and the
expressions stay small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letter classes: a consonant, a vowel, runs of each; a leading y is written Y while stemming.
_c, _v = "[^aeiou]", "[aeiouy]"
_C, _V = f"{_c}[^aeiouy]*", f"{_v}[aeiou]*"
_MEASURE_OVER_0 = f"^(?:{_C})?{_V}{_C}"
_MEASURE_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
_MEASURE_OVER_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
_HAS_VOWEL = f"^(?:{_C})?{_v}"
_SHORT_END = f"^{_C}{_v}[^aeiouwxy]$"
_DOUBLE_END = r"([^aeiouylsz])\1$"

# Suffix tables of steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _matches(word: Column, pattern: str) -> Column:
    return F.rlike(word, F.lit(pattern))


def _without(word: Column, suffix: str) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.lit(len(suffix)))


def _longest_suffix(
    word: Column, table: dict[str, str], applies: Callable[[Column, str], Column]
) -> Column:
    """Replace the longest suffix of ``table`` that the word ends with, if its stem applies."""
    result = F.when(F.lit(False), word)
    for suffix in sorted(table, key=len, reverse=True):
        stem = _without(word, suffix)
        result = result.when(
            F.endswith(word, F.lit(suffix)),
            F.when(applies(stem, suffix), F.concat(stem, F.lit(table[suffix]))).otherwise(word),
        )
    return result.otherwise(word)


def _plural(word: Column) -> Column:
    return (
        F.when(_matches(word, "(?:ss|i)es$"), _without(word, "es"))
        .when(_matches(word, "[^s]s$"), _without(word, "s"))
        .otherwise(word)
    )


def _past(word: Column) -> Column:
    """-eed, -ed, -ing; a shortened word is marked with a trailing ``+`` for the tidy step."""

    def shortened(suffix: str) -> Column:
        stem = _without(word, suffix)
        return F.when(_matches(stem, _HAS_VOWEL), F.concat(stem, F.lit("+"))).otherwise(word)

    return (
        F.when(
            F.endswith(word, F.lit("eed")),
            F.when(
                _matches(_without(word, "eed"), _MEASURE_OVER_0), _without(word, "d")
            ).otherwise(word),
        )
        .when(F.endswith(word, F.lit("ed")), shortened("ed"))
        .when(F.endswith(word, F.lit("ing")), shortened("ing"))
        .otherwise(word)
    )


def _tidy(word: Column) -> Column:
    stem = _without(word, "+")
    return F.when(
        F.endswith(word, F.lit("+")),
        F.when(_matches(stem, "(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(_matches(stem, _DOUBLE_END), F.substring(stem, F.lit(1), F.length(stem) - 1))
        .when(_matches(stem, _SHORT_END), F.concat(stem, F.lit("e")))
        .otherwise(stem),
    ).otherwise(word)


def _final_y(word: Column) -> Column:
    stem = _without(word, "y")
    return F.when(
        F.endswith(word, F.lit("y")) & _matches(stem, _HAS_VOWEL), F.concat(stem, F.lit("i"))
    ).otherwise(word)


def _step_4(word: Column) -> Column:
    def applies(stem: Column, suffix: str) -> Column:
        long_enough = _matches(stem, _MEASURE_OVER_1)
        return long_enough & _matches(stem, "[st]$") if suffix == "ion" else long_enough

    return _longest_suffix(word, dict.fromkeys(STEP_4, ""), applies)


def _final_e(word: Column) -> Column:
    stem = _without(word, "e")
    drop = _matches(stem, _MEASURE_OVER_1) | (
        _matches(stem, _MEASURE_IS_1) & ~_matches(stem, _SHORT_END)
    )
    return F.when(F.endswith(word, F.lit("e")) & drop, stem).otherwise(word)


def _final_ll(word: Column) -> Column:
    return F.when(
        F.endswith(word, F.lit("ll")) & _matches(word, _MEASURE_OVER_1), _without(word, "l")
    ).otherwise(word)


def stem_words(words: Column) -> Column:
    """Stems of an array of lower-case words; words of one or two letters stay as they are."""

    def over_0(stem: Column, _suffix: str) -> Column:
        return _matches(stem, _MEASURE_OVER_0)

    steps: list[Callable[[Column], Column]] = [
        lambda w: F.regexp_replace(w, "^y", "Y"),
        _plural,
        _past,
        _tidy,
        _final_y,
        lambda w: _longest_suffix(w, STEP_2, over_0),
        lambda w: _longest_suffix(w, STEP_3, over_0),
        _step_4,
        _final_e,
        _final_ll,
    ]

    def unless_short(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda w: F.when(F.length(w) <= 2, w).otherwise(step(w))

    for step in steps:
        words = F.transform(words, unless_short(step))
    return F.transform(words, lambda w: F.regexp_replace(w, "^Y", "y"))

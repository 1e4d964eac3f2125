"""Keywords found in one pass against the direct form."""

from __future__ import annotations

import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mergelens.functions import keywords as K
from mergelens.functions import text as X
from mergelens.functions.rules import DEFAULT_RULES
from tests.conftest import rows


def drawn(draw, signs, longest):
    return "".join(draw.choice(signs) for _ in range(draw.randrange(longest)))


@pytest.mark.parametrize("chunk", [K.CHUNK, 50])
@pytest.mark.parametrize("signs", ["ab", "abc é😀", "abcdefghijklmnopqrstuvwxyz0123456789 -"])
def test_finder_equals_the_direct_form(monkeypatch, chunk, signs):
    monkeypatch.setattr(K, "CHUNK", chunk)
    draw = random.Random(len(signs))
    words = list({drawn(draw, signs, 9) for _ in range(60)})
    texts = [*(drawn(draw, signs, 80) for _ in range(200)), None, "", "a"]
    array = pa.array(texts, pa.string())
    want = [(i, n) for i, t in enumerate(texts) if t is not None for n, w in enumerate(words) if w in t]
    grams = [w[draw.randrange(len(w)) :][:3] if w else "" for w in words]
    for finder in (K.Finder(words), K.Finder(words, grams)):
        assert list(zip(*map(list, finder.found(array)), strict=True)) == want
        part = [(i - 7, n) for i, n in want if 7 <= i < 90]
        assert list(zip(*map(list, finder.found(array.slice(7, 83))), strict=True)) == part
    assert len(K.Finder([]).found(array)[0]) == len(K.Finder(words).found(array.slice(0, 0))[0]) == 0


def test_many_keywords_take_little_more_than_few():
    draw = random.Random(5)
    words = list({"".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(2_000)})
    texts = pa.array([" ".join(draw.choice(words)[::-1] for _ in range(300)) for _ in range(400)])
    times = []
    for some in (words[:40], words):
        finder, began = K.Finder(some), time.process_time()
        finder.found(texts)
        times.append(time.process_time() - began)
    assert times[1] < 25 * times[0] + 0.5


def test_codes_keep_order_and_title(spark):
    frame = spark.createDataFrame([(1, "fix", "fix bug"), (2, "", ""), (3, None, None), (4, "zz", "bugfix zz")], "n int, t string, c string")
    got = rows(frame.select("n", K.keyword_codes(F.col("t"), F.col("c"), ["bug", "fix", "zz"]).alias("codes")))
    assert got == [(1, [0, 3]), (2, []), (3, []), (4, [0, 2, 5])]


def test_needed_letters_are_in_every_match():
    patterns = [p for typed in DEFAULT_RULES.types.values() for p in typed.commit_patterns]
    texts = [drawn(random.Random(i), "fixesd issue#12 closed", 30) for i in range(500)] + [
        "fix", "fixes #1", "fixe 3", "issue12", "resolved", "docs", "add new"
    ]
    for pattern in patterns:
        assert X.needed_letters(pattern)
        assert all(X.needed_letters(pattern) in t for t in texts if re.search(pattern, t))
    assert [X.needed_letters(p) for p in (r"\bfixes?\b", "ab*c", "a|b", "(?i)fix", "a?", r"\w+")] == ["fixe", "a", "", "", "", ""]

"""Tokens, stems, TF-IDF and cosine against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mergelens.functions.words import ngram_totals
from mergelens.operators import similarity as S
from mergelens.plans.queries import QUERIES
from tests.conftest import SF_SMALL, rows

STOPS = ["the", "of", "in", "a"]


def _terms(text):
    words = [w for w in re.findall(r"\w+", text.lower()) if len(w) > 1 and w not in STOPS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _fit(texts, limit=1000):
    tf, df = Counter(), Counter()
    for text in texts:
        tf.update(_terms(text))
        df.update(set(_terms(text)))
    kept = sorted(tf, key=lambda t: (-tf[t], t))[:limit]
    return {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}


def _weights(text, idf):
    raw = {t: n * idf[t] for t, n in Counter(_terms(text)).items() if t in idf}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    return {t: v / norm for t, v in raw.items()} if norm else {}


def _cosine(a, b):
    return sum(v * b.get(t, 0.0) for t, v in a.items())


def test_porter_stems(spark):
    expected = {
        "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
        "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
        "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
        "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
        "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
        "conditional": "condit", "rational": "ration", "digitizer": "digit",
        "vietnamization": "vietnam", "operator": "oper", "feudalism": "feudal",
        "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal",
        "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
        "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
        "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
        "replacement": "replac", "adoption": "adopt", "communism": "commun", "activate": "activ",
        "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
        "controll": "control", "roll": "roll", "yes": "ye", "is": "is", "documentation": "document",
        "update": "updat", "resolve": "resolv",
    }
    df = spark.createDataFrame([(list(expected),)], "w array<string>")
    assert dict(zip(expected, df.select(S.stem_words(F.col("w"))).first()[0], strict=True)) == expected


def test_tokens(spark):
    df = spark.createDataFrame([("The Fixes of the PARSER, naïve_x 2nd",), (None,)], "t string")
    plain, empty = [r[0] for r in df.select(S.tokens(F.col("t"), STOPS)).collect()]
    assert (plain, empty) == (["fixes", "parser", "naïve_x", "2nd"], [])
    assert df.select(S.tokens(F.col("t"), STOPS, stem=True)).first()[0][0] == "fix"


def test_tfidf_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    idf = _fit(list(texts.values()), 200)
    terms = S.with_terms(docs, "text", STOPS)
    found = S.tfidf_weights(terms, S.fit_vocabulary(terms, 200), ["doc_id"]).collect()
    expected = {(d, t): w for d, x in texts.items() for t, w in _weights(x, idf).items()}
    assert len(found) == len(expected)
    for r in found:
        assert r.weight == pytest.approx(expected[r.doc_id, r.term], abs=1e-9)


def test_text_vocabulary_and_weights_equal_brute_force(spark):
    """Terms are counted over slices of many texts; rows of one key go together, null keys have no weights."""
    texts = ["Fix the bug, fix the bug", "İstanbul naïve_x 2nd bug", "", None, "a", "the fix", "bug fix bug fix bug"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = _fit([t or "" for t in texts], 6)
    fitted = S.fit_text_vocabulary(docs, "text", STOPS, max_features=6)
    assert {r.term: r.idf for r in fitted.collect()} == pytest.approx(idf)
    older = S.fit_vocabulary(S.with_terms(docs, "text", STOPS), 6)
    assert rows(fitted) == rows(older)
    known = sorted(idf)
    keyed = docs.withColumn("doc_id", F.when(F.col("doc_id") == 6, None).otherwise(F.least("doc_id", F.lit(4))))
    terms = S.with_terms(keyed, "text", STOPS, known=known)
    found = {(r.doc_id, r.term): r.weight for r in S.tfidf_weights(terms, fitted, ["doc_id"]).collect()}
    expected = {(d, t): w for d in (0, 1) for t, w in _weights(texts[d], idf).items()}
    expected |= {(4, t): w for t, w in _weights("a the fix", idf).items()}
    assert found == pytest.approx(expected)
    empty = S.fit_text_vocabulary(docs.where("doc_id in (2, 3)"), "text", STOPS)
    assert empty.count() == 0
    assert S.tfidf_weights(S.with_terms(docs, "text", STOPS, known=[]), empty, ["doc_id"]).count() == 0


def test_long_ngrams_are_counted_within_texts(spark):
    texts = ["a b c d a b c", "b c", "c d a b c x", ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.term: (r.tf, r.df) for r in ngram_totals(docs, "text", [], 1, (2, 3)).collect()}
    tf, df = Counter(), Counter()
    for text in texts:
        words = text.split()
        own = [" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)]
        tf.update(own)
        df.update(set(own))
    assert found == {t: (tf[t], df[t]) for t in tf}


def test_tfidf_cuts_each_text_twice_at_most(spark):
    """Once to count all terms, which happens at once, and once to weigh the known ones."""
    plan = QUERIES["tfidf"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "regexp_extract_all" not in plan


def test_cosine_equals_brute_force(spark):
    texts = [
        "Fix the bug in the authentication module", "add new user, create user manual",
        "Update README documentation", "nothing known here", "", None,
        "fix fix bug bug error typo in documentation",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = S.text_similarity(df, ["k"], prototypes=S.Prototypes(spark, stop_words=STOPS)).orderBy("k").collect()
    idf = _fit(S.TRAINING_SENTENCES)
    for row, text in zip(found, texts, strict=True):
        for name, prototype in S.PROTOTYPES.items():
            expected = _cosine(_weights(text or "", idf), _weights(prototype, idf))
            assert row[f"similarity_{name}"] == pytest.approx(expected, abs=1e-9)


def test_stemmed_inputs_meet_an_unstemmed_vocabulary(spark):
    df = spark.createDataFrame([(1, "resolve")], "k int, text string")
    assert S.text_similarity(df, ["k"], prototypes=S.Prototypes(spark, stop_words=STOPS)).first().similarity_fix > 0
    assert S.text_similarity(
        df, ["k"], prototypes=S.Prototypes(spark, stop_words=STOPS), stem=True).first().similarity_fix == 0


def test_default_stop_words(spark):
    assert {"the", "and", "of"} <= set(S.english_stop_words())
    df = spark.createDataFrame([(1, "fix the bug")], "k int, text string")
    assert rows(S.text_similarity(df, ["k"]).select("k")) == [(1,)]


def test_parts_equal_the_whole_text(spark):
    """Bigrams across the border of body and messages count as in one text."""
    data = [(1, "Update", "some readme", ["examples", "fix bug"]), (2, "create api", None, None),
            (3, "x", "security", ["vulnerability in the user", "manual"]), (4, "", "", ["typo"])]
    prs = spark.createDataFrame([d[:3] for d in data], "k int, title string, body string")
    messages = spark.createDataFrame([(d[0], d[3]) for d in data if d[3]],
                                     "k int, commit_messages array<string>")
    model = S.Prototypes(spark, stop_words=STOPS)
    whole = spark.createDataFrame(
        [(k, " ".join([t, b or "", *(m or [])])) for k, t, b, m in data], "k int, text string")
    parts = S.pull_request_similarity(prs, messages, ["k"], model)
    assert rows(parts) == rows(S.text_similarity(whole, ["k"], prototypes=model))
    assert rows(S.pull_request_similarity(prs, None, ["k"], model)) != rows(parts)

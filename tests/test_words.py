"""Words cut over whole columns, against the same done word by word in Spark and Python."""

from __future__ import annotations

from pyspark.sql import functions as F

from mergelens.functions.words import known_ngrams
from mergelens.operators import similarity as S

TEXTS = [
    None, "", " ", "a", "Fix bug", "fix-bug,fix_bug fix  bug!", "É l'été “neuf” naïve—ÉTÉ 42 ½ ²", "日本 語。fix", "ΟΔΟΣ x İi",
    "the fix the bug", "add\x00new add new add", "🙂fix🙂bug", "fix", "bug fix bug fix bug " * 40, "é è ab",
]
STOP = ["the", "of"]


def _docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3, "id")


def _by_spark(spark, min_length):
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"))
    kept = F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(STOP))
    return {r.id: r.w for r in _docs(spark).select("id", kept.alias("w")).collect()}


def test_ngrams_stay_in_their_text(spark):
    expected = {
        i: words + [" ".join(p) for p in zip(words, words[1:])] + [" ".join(p) for p in zip(words, words[1:], words[2:])]
        for i, words in _by_spark(spark, 2).items()
    }
    known = ["fix", "fix bug", "bug fix bug", "add new", "été"]
    some = _docs(spark).select("id", known_ngrams(F.col("text"), known, STOP, 2, (1, 3)).alias("k")).select("id", "k.*")
    parts = {word for term in known for word in term.split(" ")}
    blanked = {i: [w if w in parts else None for w in words] for i, words in _by_spark(spark, 2).items()}
    for row in some.collect():
        assert row.terms == [t for t in expected[row.id] if t in known]
        assert row["last"] == blanked[row.id][-2:]
    none = _docs(spark).select(known_ngrams(F.col("text"), [], STOP, 2, (1, 2)).alias("k")).select("k.terms").collect()
    assert all(row.terms == [] for row in none)


def test_a_text_is_cut_by_no_expression_for_each_word(spark):
    docs = _docs(spark)
    df = S.text_similarity(docs, ["id"], prototypes=S.Prototypes(spark, stop_words=STOP))
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()

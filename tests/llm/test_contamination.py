from __future__ import annotations

import re
from hashlib import sha256

from mergelens.llm.contamination import contamination
from tests.conftest import SF_SMALL, plan_text
from tests.llm.fixtures import documents, odd_texts, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_force(rows, items, window=13):
    out = []
    for key, text in rows:
        own = words(text)
        hit, found = set(), set()
        for item, item_text in items:
            theirs = words(item_text)
            size = min(window, len(theirs))
            runs = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if size else ()
            for i in range(len(own) - size + 1 if size else 0):
                if tuple(own[i : i + size]) in runs:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
        digest = sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out)


def result(df):
    return sorted(
        (r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()
    )


def test_odd_items_and_documents(spark):
    passage = prose(40, 900)
    items = [
        (10, passage), (2, prose(40, 901)), (3, "same " * 20), (4, "one"), (5, "two WORDS"), (6, None),
        (7, ""), (8, "ÀÉÎ Straße"), (9, "THREE little words"), (11, passage), (12, "..."),
        (13, " ".join(passage.split()[5:17])), (14, "same same"),
    ]
    texts = odd_texts() + [
        f"{prose(100, 1)} {passage.upper()} {prose(60, 2)}",
        f"{passage} {prose(2000, 3)}",
        ", ".join(passage.split()[3:16]),
        ", ".join(passage.split()[3:15]),
        f"{passage} {passage}",
        "zwei two words three LITTLE words",
        "Same.same;same-same",
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = list(zip(range(0, 3 * len(texts), 3), texts, strict=True))
    df = contamination(documents(spark, texts, clashing=True), benchmark)
    assert result(df) == brute_force(rows, items)
    assert "Python" not in plan_text(df) and "Arrow" not in plan_text(df)


def test_given_tables_with_long_items(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = result(contamination(docs, benchmark))
    assert got == brute_force(rows, items)
    assert any(r[-1] for r in got)


def test_empty_tables_and_null_ids(spark):
    benchmark = spark.createDataFrame([(1, "a b c d"), (None, "a b")], "item_id long, text string")
    assert contamination(documents(spark, []), benchmark).count() == 0
    clean = contamination(documents(spark, ["a b c d", None], [1, None]), benchmark.limit(0)).collect()
    assert sorted(r.n_hit for r in clean) == [0, 0]
    got = contamination(documents(spark, ["a b c d", "a b c d", None], [1, None, None]), benchmark)
    assert sorted((r.doc_id or 0, r.n_hit) for r in got.collect()) == [(0, 0), (0, 0), (1, 4)]


def test_repeated_rows(spark):
    benchmark = spark.createDataFrame([(1, "a b c d")] * 2, "item_id long, text string")
    got = contamination(documents(spark, ["x a b c d"] * 2, [4, 4]), benchmark).collect()
    assert [(r.n_hit, r.n_items) for r in got] == [(4, 1)] * 2

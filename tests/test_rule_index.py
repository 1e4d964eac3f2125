"""Many substring rules against the direct form."""

from __future__ import annotations

import random

import pytest

from mergelens.operators import rule_index as I
from tests.conftest import plan_text, rows

TEXTS = "id long, text string"
RULES = "rule long, pattern string"


def made(seed, count, signs="abcde \n.é😀"):
    draw = random.Random(seed)
    return ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 9))) for _ in range(count)]


def direct(texts, rules):
    return sorted((i, r) for i, t in texts if t is not None for r, p in rules if p and p in t)


@pytest.mark.parametrize("limit", [I.BROADCAST_RULES, 0])
def test_equals_the_direct_form(spark, monkeypatch, limit):
    monkeypatch.setattr(I, "BROADCAST_RULES", limit)
    draw = random.Random(1)
    texts = [(i, "".join(made(i, draw.randrange(40)))) for i in range(60)] + [(60, None), (61, ""), (62, "a" * 500), (63, "ab")]
    rules = list(enumerate([*made(99, 400), "a", "é", "ab", "", None, "a" * 30, "a.*", "x", "ab", "no such rule at all"]))
    got = I.rule_matches(spark.createDataFrame(texts, TEXTS), "id", "text", spark.createDataFrame(rules, RULES))
    assert rows(got) == sorted(direct(texts, rules), key=repr)


def test_a_hundred_thousand_rules_read_the_texts_once(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(4, 14)))
    patterns = list({word() for _ in range(100_000)})
    texts = [(i, " ".join(draw.choice(patterns) if draw.random() < 0.1 else word() for _ in range(300))) for i in range(40)]
    frame = spark.createDataFrame(texts, TEXTS)
    got = I.rule_matches(frame, "id", "text", spark.createDataFrame(list(enumerate(patterns)), RULES))
    assert plan_text(got).count("Scan ExistingRDD") == 2
    assert "Exchange hashpartitioning" not in plan_text(got)
    held = {}
    for n, p in enumerate(patterns):
        held.setdefault(p[:4], []).append((n, p))
    want = {(i, n) for i, t in texts for s in range(len(t)) for n, p in held.get(t[s : s + 4], ()) if t.startswith(p, s)}
    assert {tuple(r) for r in got.collect()} == want


def test_no_rules_and_no_texts(spark):
    none, some = spark.createDataFrame([], RULES), spark.createDataFrame([(1, "a")], RULES)
    assert I.rule_matches(spark.createDataFrame([(1, "a")], TEXTS), "id", "text", none).collect() == []
    assert I.rule_matches(spark.createDataFrame([], TEXTS), "id", "text", some).collect() == []

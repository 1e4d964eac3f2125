from __future__ import annotations

import random

import numpy as np
import pytest

from mergelens.llm.components import components
from mergelens.llm.neardup import NearDuplicates, near_duplicates, signature, text_shingles
from tests.llm.fixtures import documents, edited, odd_texts, prose


def brute_force(rows, size: int, percent: int):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if words and len(words) < size:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                label[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return sorted(
        (key, len(sets[i]), least[find(i)], least[find(i)] == key) for i, (key, _) in enumerate(rows)
    )


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_odd_texts(spark):
    texts = odd_texts()
    rows = list(zip(range(0, 3 * len(texts), 3), texts, strict=True))
    got = result(near_duplicates(documents(spark, clashing=True)))
    assert got == brute_force(rows, 4, 80)


@pytest.mark.parametrize("shingle", [4, 5])
def test_dense_groups_in_small_blocks(spark, shingle):
    """Groups far larger than a block, with similarities on both sides of the threshold."""
    texts = []
    for group in range(3):
        base = prose(120, 100 + group)
        texts += [edited(base, 20 + 15 * (k % 9), 1000 * group + k) for k in range(70)]
        texts += [base] * 5
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    settings = NearDuplicates(shingle=shingle, region=16, cluster=8)
    got = result(near_duplicates(documents(spark, texts, range(len(texts))), settings))
    assert got == brute_force(rows, shingle, 80)


def test_empty_and_null_ids(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    text = prose(50, 1)
    got = near_duplicates(documents(spark, [text, text, "b", None], [None, 4, None, None])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(4, 4, True)]
    assert all(r.kept for r in got)


def test_repeated_rows_share_a_component(spark):
    text = prose(50, 1)
    got = result(near_duplicates(documents(spark, [text, text, prose(50, 2)], [2, 2, 2])))
    assert {r[2] for r in got} == {2} and len(got) == 3


def test_signature_estimates_similarity():
    base = prose(400, 9)
    a, b = (text_shingles(t.encode(), 4) for t in (base, edited(base, 30, 1)))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, 512) == signature(b, 512)).mean() - true) < 0.08


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (9, 8)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(7, 60)} == {7}
    assert 5 not in got
    assert components(df.limit(0)).count() == 0

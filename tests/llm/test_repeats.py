from __future__ import annotations

import random
from hashlib import sha256

import numpy as np

from mergelens.llm.recompression import window_names
from mergelens.llm.repeats import remove_repeats
from mergelens.llm.words import word_hashes
from tests.llm.fixtures import documents, edited, odd_texts, prose


def brute_force(rows, window: int):
    least: dict[tuple, int] = {}
    split = [(key, (text or "").encode().split()) for key, text in rows]
    for key, words in split:
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            least[run] = min(key, least.get(run, key))
    out = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < key:
                gone |= set(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def result(df):
    return sorted(
        (r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in df.collect()
    )


def test_odd_texts(spark):
    texts = odd_texts()
    rows = list(zip(range(0, 3 * len(texts), 3), texts, strict=True))
    assert result(remove_repeats(documents(spark, clashing=True))) == brute_force(rows, 13)


def test_shared_passages_few_words_and_runs(spark):
    """Passages at different places, texts of five words, and long runs of one word."""
    draw = random.Random(3)
    passages = [prose(60, 50 + k) for k in range(4)] + [prose(14, 60), prose(13, 61), prose(12, 62)]
    texts = []
    for k in range(60):
        parts = [prose(draw.randrange(40), 200 + k)]
        parts += [draw.choice(passages), prose(draw.randrange(20), 300 + k, 5)]
        parts += ["ha " * draw.randrange(30), edited(draw.choice(passages), 12, k)]
        texts.append(" ".join(parts))
    rows = list(enumerate(texts))
    got = result(remove_repeats(documents(spark, texts, range(len(texts)))))
    assert got == brute_force(rows, 13)


def test_names_depend_on_the_window_alone():
    draw = random.Random(5)
    for vocabulary in (2, 5, 50, 10_000):
        words = [f"{draw.randrange(vocabulary)}".encode() for _ in range(3000)]
        hashes = word_hashes(words)
        names = window_names(hashes, 13)
        for _ in range(200):
            start = draw.randrange(len(words) - 13)
            before, after = draw.randrange(20), draw.randrange(20)
            fresh = np.random.default_rng(start).integers(0, 1 << 63, before + after).astype(np.uint64)
            own = np.concatenate([fresh[:before], hashes[start : start + 13], fresh[before:]])
            assert window_names(own, 13)[before] == names[start]


def test_empty_null_ids_and_repeated_rows(spark):
    assert remove_repeats(documents(spark, [])).count() == 0
    text = prose(40, 1)
    got = remove_repeats(documents(spark, [text] * 4, [None, 3, 3, 5])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (3, 0), (3, 0), (5, 40)]

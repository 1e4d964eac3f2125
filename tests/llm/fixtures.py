"""Small tables with every odd case, and columns whose names the operators use inside."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "node long, hash long, shard int, size long, words string, text_order int, hi long, codes string, place int"


def prose(words: int, seed: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def edited(text: str, every: int, seed: int) -> str:
    """The text with one word in ``every`` replaced."""
    draw = random.Random(seed)
    return " ".join(
        f"x{draw.randrange(10**6)}" if draw.randrange(every) == 0 else w for w in text.split(" ")
    )


def odd_texts() -> list[str | None]:
    long = prose(30_000, 1, 5_000)
    base = prose(200, 2)
    return [
        None,
        "",
        " \n\t ",
        "one",
        "two words",
        base,
        base,
        base.upper(),
        edited(base, 40, 3),
        edited(base, 40, 4),
        "same " * 300,
        "same " * 40,
        prose(30, 5) + " " + base + " " + prose(30, 6),
        long,
        long[: len(long) // 2] + " " + prose(50, 7),
        "ÀÉÎ Straße 日本語 text😀 " * 20,
        "z" * 5_000,
    ]


def documents(spark, texts=None, ids=None, clashing: bool = False):
    texts = odd_texts() if texts is None else texts
    ids = range(0, 3 * len(texts), 3) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    if not clashing:
        return spark.createDataFrame(rows, DOCUMENTS)
    return spark.createDataFrame(
        [(*r, 1, 2, 3, 4, "a", 5, 6, "b", 7) for r in rows], f"{DOCUMENTS}, {CLASHING}"
    )

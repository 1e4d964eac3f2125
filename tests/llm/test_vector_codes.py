from __future__ import annotations

from fractions import Fraction
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest

from mergelens.llm.vector_codes import Codes, compress, nearest, sequency_order, transformed

SCHEMA = "vec_id long, embedding array<float>, label int, part int, vector string, code long"
LONG_MAX = (1 << 63) - 1


def brute(rows: list[tuple], codes: Codes) -> list[tuple]:
    """The contract with Python's own numbers, every distance in full."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and isfinite(x) for x in r[1])]
    if not kept:
        return []
    longest = max(len(r[1]) for r in kept)
    step = -(-longest // codes.parts)
    number = lambda x: min(max(floor(Fraction(x) * codes.scale), -LONG_MAX - 1), LONG_MAX)
    whole = [[number(x) for x in r[1]] + [0] * (step * codes.parts - len(r[1])) for r in kept]
    cut = lambda v, p: v[p * step : (p + 1) * step]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[list(cut(whole[i], p)) for i in order[: codes.entries]] for p in range(codes.parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    pick = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(codes.rounds):
        for p in range(codes.parts):
            chosen = [pick(v, p) for v in whole]
            for e in range(len(books[p])):
                members = [cut(v, p) for v, c in zip(whole, chosen, strict=True) if c == e]
                if members:
                    books[p][e] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for r, v in zip(kept, whole, strict=True):
        chosen = [pick(v, p) for p in range(codes.parts)]
        error = min(sum(far(cut(v, p), books[p][c]) for p, c in enumerate(chosen)), LONG_MAX)
        sums[r[2]] = sums.get(r[2], 0) + error
        out.append((r[0], "".join(f"{c:02x}" for c in chosen), error, r[2]))
    return [(i, code, error, min(sums[label], LONG_MAX), digest) for i, code, error, label in out]


def run(spark, rows, codes=Codes()):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = compress(df, codes=codes)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(n: int, size: int, seed: int, spread: float = 0.2) -> list[list[float]]:
    draw = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in row] for row in draw.normal(0, spread, (n, size))]


@pytest.mark.parametrize(("n", "size"), [(120, 64), (40, 20), (7, 8), (60, 5), (1, 16)])
def test_equals_brute_force(spark, n, size):
    rows = [(7 * i - 30, v, i % 4 or None) for i, v in enumerate(vectors(n, size, n))]
    assert run(spark, rows) == sorted(brute(rows, Codes()), key=repr)


def test_odd_rows(spark):
    base = vectors(30, 16, 3)
    bad = [None, [None] * 16, [float("nan"), *base[0][1:]], [*base[0][1:], float("inf")], [-float("inf")] * 16]
    rows = [(i, v, 1) for i, v in enumerate(base)]
    rows += [(1_000 + i, v, None) for i, v in enumerate(bad)]
    rows += [(3, base[3], 1), (3, base[4], 2), (None, base[5], None), (None, base[6], 2), (50, [], 3), (51, base[0][:5], 3)]
    rows += [(60 + i, base[0], 9) for i in range(40)]
    assert run(spark, rows) == sorted(brute(rows, Codes()), key=repr)


def test_very_large_components(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(25, 16, 4, 1e5) + vectors(25, 16, 5, 1e18))]
    rows += [(90, [3.0e38] * 16, 1), (91, [-3.0e38] * 16, 1)]
    assert run(spark, rows) == sorted(brute(rows, Codes()), key=repr)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    assert [r[1:4] for r in run(spark, [(1, [], 1)])] == [("00" * 8, 0, 0)]


def test_ties_go_to_the_lower_index():
    entries = np.array([[0, 0, 0], [2, 0, 0], [0, 0, 0], [1, 1, 0]])
    index, distance = nearest(np.array([[1, 0, 0], [0, 0, 0], [2, 2, 0]]), entries)
    assert index.tolist() == [0, 0, 3]
    assert distance.tolist() == [1, 0, 2]


@pytest.mark.parametrize("size", [1, 2, 3, 8, 13, 32])
def test_transform_keeps_scaled_distances(size):
    draw = np.random.default_rng(size)
    a, b = draw.integers(-5000, 5000, (2, 50, size))
    padded = 1 << (size - 1).bit_length()
    gap = transformed(a) - transformed(b)
    assert ((gap**2).sum(1) == padded * ((a - b) ** 2).sum(1)).all()
    signs = np.sign(transformed(np.eye(padded, dtype=np.int64))).T
    assert [int((np.diff(row) != 0).sum()) for row in signs] == list(range(padded))
    assert sorted(sequency_order(padded)) == list(range(padded))


@pytest.mark.parametrize("spread", [3, 300, 1 << 40])
def test_nearest_equals_full_search(spread):
    draw = np.random.default_rng(spread)
    parts, entries = draw.integers(-spread, spread, (400, 8)), draw.integers(-spread, spread, (16, 8))
    index, distance = nearest(parts, entries)
    full = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e, strict=True)) for e in entries] for p in parts]
    assert distance.tolist() == [min(row) for row in full]
    assert index.tolist() == [row.index(min(row)) for row in full]

"""Locally consistent names of word stretches, by rounds of recompression (Jez, 2013).

Each round names runs and pairs of neighbouring symbols. A name is a hash of what it stands for, and
whether two neighbours become a pair depends on hashes of the two alone, so the same words get
the same names in every document and on every machine, without a table of names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from mergelens.llm.words import mixed

_RUN = np.uint64(0xD6E8FEB86659FD93)
_PAIR = np.uint64(0xA0761D6478BD642F)
_BASE = 0x9E3779B97F4A7C15
# Bits of a window's name: 5 for the span, 19 of the symbol's hash, 40 of the deciding words' hash.
_SPAN_SHIFT, _NAME_SHIFT = np.uint64(59), np.uint64(40)
_NAME_CUT, _AROUND_CUT = np.uint64(45), np.uint64(24)


@dataclass
class Symbols:
    """Symbols in order: name, words covered, and the words [low, high) that decide on them."""

    name: np.ndarray
    span: np.ndarray
    low: np.ndarray
    high: np.ndarray


def words_as_symbols(hashes: np.ndarray) -> Symbols:
    places = np.arange(len(hashes))
    return Symbols(hashes, np.ones(len(hashes), np.int64), places, places + 1)


def _beyond(values: np.ndarray, missing: int, step: int) -> np.ndarray:
    """The values of the neighbours on one side, ``missing`` where there is none."""
    out = np.full(len(values), missing, np.int64)
    if step > 0:
        out[:-1] = values[1:]
    else:
        out[1:] = values[:-1]
    return out


def name_runs(s: Symbols, total: int) -> Symbols:
    """Longest runs of one symbol become one; both neighbours decide that a run ends."""
    heads = np.flatnonzero(np.r_[True, s.name[1:] != s.name[:-1]])
    counts = np.diff(np.r_[heads, len(s.name)])
    names = s.name[heads]
    names = np.where(counts > 1, mixed(names * _RUN + counts.astype(np.uint64)), names)
    lows = _beyond(s.low, -total, -1)[heads]
    highs = _beyond(s.high, 2 * total, 1)[heads + counts - 1]
    return Symbols(names, np.add.reduceat(s.span, heads), lows, highs)


def name_pairs(s: Symbols, number: int, total: int) -> Symbols:
    """Left symbols followed by right ones become pairs; a hash of the name says which it is.

    A left symbol needs its right neighbour to decide whether it stays alone, a right one its left.
    """
    salt = np.uint64((number + 1) * int(_PAIR) % (1 << 64))
    right = (mixed(s.name + salt) & np.uint64(1)).astype(bool)
    opens = np.zeros(len(s.name), bool)
    opens[:-1] = ~right[:-1] & right[1:]
    closes = np.zeros(len(s.name), bool)
    closes[1:] = opens[:-1]
    after = np.minimum(np.arange(len(s.name)) + 1, len(s.name) - 1)
    names = np.where(opens, mixed(s.name * _PAIR + mixed(s.name[after])), s.name)
    spans = np.where(opens, s.span + s.span[after], s.span)
    lows = np.minimum(
        s.low, np.where(right, _beyond(s.low, -total, -1), _beyond(s.low, -total, 1))
    )
    highs = np.maximum(
        s.high, np.where(right, _beyond(s.high, 2 * total, -1), _beyond(s.high, 2 * total, 1))
    )
    kept = ~closes
    return Symbols(names[kept], spans[kept], lows[kept], highs[kept])


def window_names(hashes: np.ndarray, window: int, rounds: int = 2) -> np.ndarray:
    """For each window of words a name of something inside that the window alone decides on.

    It is the symbol of the highest round that has one decided by words of the window; of several
    the one that covers most words, then the largest hash. The name also has the words that
    decide on the symbol, so that common symbols in other company differ. A window without any, as
    inside a long run of one word, is named by its own words. Equal windows so have equal names
    wherever they stand, and neighbours mostly share one.
    """
    total = len(hashes)
    count = total - window + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    levels = [name_runs(words_as_symbols(hashes), total)]
    for number in range(rounds):
        levels.append(name_pairs(levels[-1], number, total))
    best = np.zeros(count, np.uint64)
    for level in reversed(levels):
        unnamed = np.r_[0, np.cumsum(best == 0)]
        fits = (level.high - level.low <= window) & (level.low >= 0) & (level.high <= total)
        first = np.maximum(level.high - window, 0)
        last = np.minimum(level.low, count - 1)
        fits &= first <= last
        fits[fits] = unnamed[last[fits] + 1] > unnamed[first[fits]]
        picked = np.flatnonzero(fits)
        around = stretch_hashes(hashes, level.low[picked], level.high[picked])
        keys = np.minimum(level.span[picked], 31).astype(np.uint64) << _SPAN_SHIFT
        keys |= mixed(level.name[picked]) >> _NAME_CUT << _NAME_SHIFT
        keys |= around >> _AROUND_CUT
        first, last = first[picked], last[picked]
        found = np.zeros(count, np.uint64)
        for step in range(window):
            at = last - step
            inside = at >= first
            if not inside.any():
                break
            np.maximum.at(found, at[inside], keys[inside])
        best = np.where(best == 0, found, best)
    bare = np.flatnonzero(best == 0)
    if len(bare):
        best[bare] = stretch_hashes(hashes, bare, bare + window)
    return best


_powers: dict[str, np.ndarray] = {}


def _power_rows(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < count:
        size = max(count, 1 << 18)
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def stretch_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each stretch [start, end) of words, from sums of shifted word hashes."""
    up, down = _power_rows(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _RUN)

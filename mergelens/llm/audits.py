"""Cheapest edit scripts of conversations, as strings that share their beginnings.

A script is a string of K (keep), R (change the role), D (delete) and I (insert). Scripts are linked
nodes; each knows its ancestors at powers of two and a rolling hash of its whole string, so that two
scripts of equal cost are compared by a search for their longest common prefix.
"""

from __future__ import annotations

from collections.abc import Iterable

_MODULUS = (1 << 61) - 1
_BASE = 911_382_323
#: What may follow: NOTHING has been put out, or what was last is of SYSTEM, USER or ASSISTANT.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The role put out next, by edits that may choose it.
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (NOTHING, ASSISTANT)


class Script:
    """A string as a node: its parent's string and one more piece."""

    __slots__ = ("above", "depth", "hash", "length", "piece")

    def __init__(self, parent: Script | None, piece: str):
        self.piece = piece
        if parent is None:
            self.depth = self.length = self.hash = 0
            self.above: list[Script] = []
            return
        self.depth, self.length = parent.depth + 1, parent.length + len(piece)
        self.hash = rolled(parent.hash, piece)
        above = [parent]
        while len(above[-1].above) >= len(above):
            above.append(above[-1].above[len(above) - 1])
        self.above = above

    def covering(self, length: int) -> Script:
        """The first node of this line whose string has at least ``length`` signs."""
        node = self
        for k in range(len(node.above) - 1, -1, -1):
            while k < len(node.above) and node.above[k].length >= length:
                node = node.above[k]
        return node

    def prefix_hash(self, length: int) -> int:
        node = self.covering(length)
        if node.length == length:
            return node.hash
        parent = node.above[0]
        return rolled(parent.hash, node.piece[: length - parent.length])

    def sign(self, place: int) -> str:
        node = self.covering(place + 1)
        return node.piece[place - node.length + len(node.piece)]

    def between(self, start: int, stop: int) -> str:
        """The signs from ``start`` up to ``stop``."""
        pieces, node = [], self.covering(stop)
        end = node.length
        while node.above and node.length > start:
            pieces.append(node.piece)
            node = node.above[0]
        text = "".join(reversed(pieces))
        return text[start - node.length : len(text) - (end - stop)]

    def text(self) -> str:
        return self.between(0, self.length)


def rolled(value: int, piece: str) -> int:
    for sign in piece:
        value = (value * _BASE + ord(sign)) % _MODULUS
    return value


def shared(a: Script, b: Script) -> Script:
    """The last node that two lines have in common."""
    if a.depth < b.depth:
        a, b = b, a
    gap = a.depth - b.depth
    while gap:
        k = gap.bit_length() - 1
        a = a.above[k]
        gap -= 1 << k
    if a is b:
        return a
    for k in range(len(a.above) - 1, -1, -1):
        if k < len(a.above) and a.above[k] is not b.above[k]:
            a, b = a.above[k], b.above[k]
    return a.above[0]


def common_prefix(a: Script, b: Script) -> int:
    """The length of the longest common prefix, verified sign by sign beyond the shared node."""
    start = shared(a, b).length
    low, high = start, min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if a.prefix_hash(middle) == b.prefix_hash(middle):
            low = middle
        else:
            high = middle - 1
    left, right = a.between(start, low), b.between(start, low)
    if left == right:
        return low
    return start + next(i for i, (x, y) in enumerate(zip(left, right, strict=True)) if x != y)


def before(a: Script, b: Script) -> bool:
    """Whether the string of ``a`` is less than that of ``b``."""
    if a is b:
        return False
    place = common_prefix(a, b)
    if place == b.length:
        return False
    return place == a.length or a.sign(place) < b.sign(place)


Label = tuple[int, Script]
Labels = list[Label | None]
EMPTY = Script(None, "")


def offer(labels: Labels, state: int, cost: int, script: Script, piece: str) -> bool:
    """Take ``script`` + ``piece`` as the state's label if it is cheaper, or as cheap and less."""
    held = labels[state]
    if held is not None and held[0] < cost:
        return False
    made = Script(script, piece) if piece else script
    if held is not None and held[0] == cost and not before(made, held[1]):
        return False
    labels[state] = (cost, made)
    return True


def with_inserts(labels: Labels) -> Labels:
    """Labels after any inserts. A state's label is final once all cheaper ones have been passed on."""
    waiting = [state for state in range(4) if labels[state] is not None]
    while waiting:
        state = min(waiting, key=lambda s: labels[s][0])
        waiting.remove(state)
        cost, script = labels[state]
        if offer(labels, NEXT[state], cost + 2, script, "I") and NEXT[state] not in waiting:
            waiting.append(NEXT[state])
    return labels


def after_deletes(labels: Labels, times: int) -> Labels:
    """Labels after rows that must all go; an insert among them is never less than one behind them."""
    gone = [None if held is None else (held[0] + 3 * times, Script(held[1], "D" * times)) for held in labels]
    return with_inserts(gone)


def after_row(labels: Labels, initial: str, truncated: bool) -> Labels:
    """Labels after one more row, that may stay or go, and any inserts behind it."""
    new: Labels = [None] * 4
    kept = KEPT.get(initial)
    for state, held in enumerate(labels):
        if held is None:
            continue
        cost, script = held
        offer(new, state, cost + 3, script, "D")
        follows = NEXT[state]
        if kept == follows or (kept == SYSTEM and state == NOTHING):
            offer(new, kept, cost + truncated, script, "K")
        offer(new, follows, cost + 2 + truncated, script, "R")
    return with_inserts(new)


Row = tuple[str, bool, bool, int]


def transfer(rows: Iterable[Row], start: int) -> list[tuple[int, str] | None]:
    """Cost and script from ``start`` to each state over rows (initial, delete, truncated, times).

    The second and further times of a row are repeats and must go.
    """
    labels: Labels = [None] * 4
    labels[start] = (0, EMPTY)
    with_inserts(labels)
    for initial, delete, truncated, times in rows:
        if not delete:
            labels = after_row(labels, initial, truncated)
        if times > (not delete):
            labels = after_deletes(labels, times - (not delete))
    return [None if held is None else (held[0], held[1].text()) for held in labels]


def extended(labels: Labels, steps: list[list[tuple[int, str] | None]]) -> Labels:
    """Labels after a segment, by its transfers from each state."""
    new: Labels = [None] * 4
    for held, row in zip(labels, steps, strict=True):
        for state, step in enumerate(row):
            if held is not None and step is not None:
                offer(new, state, held[0] + step[0], held[1], step[1])
    return new


def best(labels: Labels) -> tuple[int, str]:
    """Cost and script of the cheapest valid end, the least of equal ones."""
    ends: Labels = [None]
    for state in ENDS:
        if labels[state] is not None:
            offer(ends, 0, *labels[state], "")
    cost, script = ends[0]
    return cost, script.text()

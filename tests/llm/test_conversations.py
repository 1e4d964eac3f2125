from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256
from itertools import pairwise

import pytest

from mergelens.llm import audits, conversations
from mergelens.llm.audits import Script, before, common_prefix, transfer

SCHEMA = "conv_id long, turn long, role string, text string, kind string, part int, digest string, times int"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
            out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def scripts(rows):
    """Every state's cheapest script over (initial, delete, truncated), as plain strings."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}

    def closed(found):
        for _ in range(4):
            for state, (cost, text) in list(found.items()):
                new = (cost + 2, text + "I")
                found[follows[state]] = min(found.get(follows[state], new), new)
        return found

    found = closed({"": (0, "")})
    for initial, delete, truncated in rows:
        new = {}

        def offer(state, cost, text, new=new):
            new[state] = min(new.get(state, (cost, text)), (cost, text))

        for state, (cost, text) in found.items():
            offer(state, cost + 3, text + "D")
            if not delete:
                if initial == follows[state] or (initial == "s" and state == ""):
                    offer(initial, cost + truncated, text + "K")
                offer(follows[state], cost + 2 + truncated, text + "R")
        found = closed(new)
    return min(found[s] for s in ("", "a") if s in found)


def every_script(rows, limit):
    """The least (cost, script) of all scripts there are, up to ``limit`` inserts."""
    best = None

    def walk(i, out, cost, text, left):
        nonlocal best
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            best = min(best or (cost, text), (cost, text))
        if left:
            for role in "ua":
                walk(i, out + role, cost + 2, text + "I", left - 1)
        if i == len(rows):
            return
        initial, delete, truncated = rows[i]
        walk(i + 1, out, cost + 3, text + "D", left)
        if not delete:
            walk(i + 1, out + initial, cost + truncated, text + "K", left)
            for role in "ua":
                walk(i + 1, out + role, cost + 2 + truncated, text + "R", left)

    walk(0, "", 0, "", limit)
    return best


def brute(rows, ids):
    """The contract, one conversation after another, in plain Python."""
    out = []
    for conv in ids:
        mine = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).digest()),
        )
        seen, faults = set(), []
        for _, _, role, text in mine:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairwise(mine))
        cost, audit = scripts([(r[2][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(mine, faults, strict=True)])
        left, last, lines = iter(mine), "", []
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = row[2] if edit == "K" else {"u": "assistant"}.get(last, "user")
            last = role[:1]
            lines.append(f"{role}:{row[3] if row else ''}")
        digest = sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def run(spark, rows, every=None):
    df = spark.createDataFrame([(*r, "k", 1, "d", 2) for r in rows], SCHEMA).repartition(5)
    if every is None:
        return sorted((tuple(r) for r in conversations.audits(df).collect()), key=repr)
    found = conversations.audits(conversations.damage(df), every=df).collect()
    return sorted((tuple(r) for r in found), key=repr)


def talk(seed, conversations_, rows):
    draw = random.Random(seed)
    texts = ["Hello.", "No", "", " \t\x0b", "Why?\n", "Go!", "x" * 50, "…", "é.", "a:b\nc", None, "Hello. \x85"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "umpire", "Ä", None]
    return [
        (draw.choice([c, c, c, None]) if c == 3 else c, draw.choice([t, t, t, t + 3, None]), draw.choice(roles), draw.choice(texts))
        for c in range(conversations_)
        for t in range(draw.randrange(rows))
    ]


@pytest.mark.parametrize("seed", range(3))
def test_damage_and_repair_equal_brute_force(spark, seed):
    rows = talk(seed, 60, 12)
    ids = {r[0] for r in rows}
    assert run(spark, rows, every=True) == brute(damaged(rows), ids)
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert run(spark, rows) == brute(spaced, ids)


def test_long_conversation_in_segments_and_ranges(spark, monkeypatch):
    """One conversation has most rows, and is cut inside and at the ends of ranges."""
    draw = random.Random(9)
    rows = [(1, t // 2 if t % 7 else None, draw.choice(["user", "assistant", "system"]), f"{draw.randrange(600)}{draw.choice('.a')}") for t in range(900)]
    rows += [(2, 5, "user", "same.")] * 300 + talk(4, 10, 8)
    expected = brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows})
    monkeypatch.setattr(conversations, "SEGMENT", 40)
    assert run(spark, rows) == expected


def test_repaired_rows_have_the_hash(spark):
    rows = [r for r in talk(8, 40, 9) if r[0] is not None]
    df = spark.createDataFrame([(*r, "k", 1, "d", 2) for r in rows], SCHEMA)
    lines: dict[int, list[str]] = {}
    for r in sorted(conversations.repaired(df).collect()):
        assert r.place == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    hashes = {r[0]: r[-1] for r in run(spark, rows)}
    for conv, digest in hashes.items():
        assert sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest


def test_edges(spark):
    empty = sha256(b"").hexdigest()
    assert run(spark, []) == []
    dropped = next(t for t in range(99) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert run(spark, [(7, dropped, "user", "a.")], every=True) == [(7, 0, 0, 0, 0, 0, 0, "", empty)]
    assert run(spark, [(7, None, None, None)]) == [(7, 0, 1, 0, 0, 0, 3, "D", empty)]
    long = "word " * 100_000 + "end."
    hashed = sha256(f"user:{long}\nassistant:".encode()).hexdigest()
    assert run(spark, [(7, 1, "user", long), (7, 2, "user", long)]) == [(7, 0, 0, 1, 0, 1, 5, "KDI", hashed)]


@pytest.mark.parametrize("seed", range(6))
def test_scripts_equal_full_enumeration(seed):
    draw = random.Random(seed)
    for _ in range(40):
        rows = [(draw.choice("suax"), draw.random() < 0.2, draw.random() < 0.4) for _ in range(draw.randrange(4))]
        want = every_script(rows, len(rows) + 1)
        assert scripts(rows) == want
        found = [transfer([(*r, 1) for r in rows], 0)[s] for s in audits.ENDS]
        assert min(f for f in found if f) == want


def test_scripts_compare_as_strings(monkeypatch):
    draw = random.Random(2)
    nodes, texts = [audits.EMPTY], [""]
    for _ in range(400):
        i = draw.randrange(len(nodes)) if draw.random() < 0.5 else len(nodes) - 1
        piece = "".join(draw.choice("DK") for _ in range(draw.choice([1, 1, 1, 7, 40])))
        nodes.append(Script(nodes[i], piece))
        texts.append(texts[i] + piece)
    for modulus in (audits._MODULUS, 3):  # A small modulus makes most hashes collide.
        monkeypatch.setattr(audits, "_MODULUS", modulus)
        if modulus == 3:
            nodes, texts = [audits.EMPTY], [""]
            for _ in range(200):
                i = draw.randrange(len(nodes))
                piece = "".join(draw.choice("DK") for _ in range(draw.choice([1, 1, 5])))
                nodes.append(Script(nodes[i], piece))
                texts.append(texts[i] + piece)
        for _ in range(3_000):
            i, j = draw.randrange(len(nodes)), draw.randrange(len(nodes))
            assert nodes[i].text() == texts[i]
            assert before(nodes[i], nodes[j]) == (texts[i] < texts[j])
            if modulus != 3:
                shortest = min(len(texts[i]), len(texts[j]))
                same = next((k for k in range(shortest) if texts[i][k] != texts[j][k]), shortest)
                assert common_prefix(nodes[i], nodes[j]) == same

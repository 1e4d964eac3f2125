"""Labelled findings for the secret scanner: text around a value, and whether it is a secret.

They are drawn from templates with a fixed seed, so training needs no stored data. Every value is
random; none is a credential.
"""

from __future__ import annotations

import random
import string
from dataclasses import dataclass

_ALNUM = string.ascii_letters + string.digits
_HEX = "0123456789abcdef"
_WORDS = "load the user file and start server with local data from main report store daily".split()
#: Names, prefixes and sentences in which credentials are commonly written.
_NAMES = ("auth_key", "access_key", "client_key", "private_key", "credential", "pwd", "signing_key")
_PREFIXES = ("sk_live_", "ghp_", "xoxb-", "glpat-", "npm_", "shpat_", "key-", "pk_live_")
_BEFORE = ("Authorization: Bearer ", "X-Auth: ", "export {name}=", '{name}: "', "{name} = '", "-u admin:")
_PLAIN = (
    "see ", "in ", "order ", "call ", "file ", "version ", "invoice ", "card ", "from ", "id ", "and ",
    "| ", "path ", "commit message ", "the ", "",
)


@dataclass(frozen=True)
class Finding:
    before: str
    value: str
    after: str
    secret: bool


def labelled_findings(count: int = 6000, seed: int = 11) -> list[Finding]:
    """``count`` findings, one in three a secret."""
    draw = random.Random(seed)
    return [_secret(draw) if i % 3 == 0 else _plain(draw) for i in range(count)]


def _some(draw: random.Random, signs: str, least: int, most: int) -> str:
    return "".join(draw.choices(signs, k=draw.randint(least, most)))


def _sentence(draw: random.Random) -> str:
    return " ".join(draw.choices(_WORDS, k=draw.randint(0, 6)))


def _secret(draw: random.Random) -> Finding:
    kind = draw.randrange(4)
    if kind == 0:
        value = draw.choice(_PREFIXES) + _some(draw, _ALNUM, 20, 44)
        before = draw.choice((*_BEFORE, *_PLAIN)).format(name=draw.choice(_NAMES))
    elif kind == 1:
        parts = ("eyJ" + _some(draw, _ALNUM, 14, 30), "eyJ" + _some(draw, _ALNUM, 14, 40))
        value = ".".join((*parts, _some(draw, _ALNUM + "-_", 20, 43)))
        before = draw.choice((*_BEFORE, *_PLAIN)).format(name=draw.choice(_NAMES))
    elif kind == 2:
        value = _some(draw, _ALNUM + "+/", 24, 64)
        before = draw.choice(_BEFORE).format(name=draw.choice(_NAMES))
    else:
        value = _some(draw, draw.choice((_HEX.upper(), _ALNUM + "_-")), 20, 48)
        before = draw.choice(_BEFORE).format(name=draw.choice(_NAMES))
    return Finding(_sentence(draw) + " " + before, value, draw.choice(('"', "'", "\n", " ")) + _sentence(draw), True)


def _long_word(draw: random.Random) -> str:
    """Letters as languages put them together: consonants around vowels, now and then a stop."""
    value = ""
    while len(value) < 16:
        value += _some(draw, "bcdfghlmnprstvwz", 0, 2) + draw.choice("aeiou") + _some(draw, "hlnrstcu", 0, 2)
    style = draw.randrange(6)
    if style == 0:
        return value.upper()
    if style == 1:
        return value[: len(value) // 2] + "." + value[len(value) // 2 :].title()
    return value + draw.choice((".", "", ""))


def _plain(draw: random.Random) -> Finding:
    kind = draw.randrange(12)
    digits = string.digits
    if kind == 0:
        value = _some(draw, digits, 16, 19)
    elif kind == 1:
        value = ".".join(_some(draw, digits, 1, 3) for _ in range(4)) + _some(draw, ".0123456789", 1, 9)
    elif kind == 2:
        value = "-".join(_some(draw, _HEX, n, n) for n in (8, 4, 4, 4, 12))
    elif kind == 3:
        value = "/".join(draw.choices(_WORDS, k=draw.randint(4, 8))) + "/v" + _some(draw, digits, 1, 3)
    elif kind == 4:
        value = "".join(draw.choices(_WORDS, k=draw.randint(3, 6))) + _some(draw, digits, 0, 2)
    elif kind == 5:
        value = "_".join(draw.choices(_WORDS, k=draw.randint(3, 6)))
    elif kind == 6:
        value = f"20{_some(draw, digits, 2, 2)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}_" + _some(draw, digits, 6, 12)
    elif kind == 7:
        value = draw.choice("=-_.") * draw.randint(16, 40)
    else:
        value = _long_word(draw)
    if draw.random() < 0.3:
        value = value.title()
    return Finding(_sentence(draw) + " " + draw.choice(_PLAIN), value, draw.choice((" ", "\n", ", ")) + _sentence(draw), False)

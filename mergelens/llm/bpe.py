"""Byte-pair encoding with word ends, and the way back, on whole texts."""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

#: White space of Unicode, as the tokenizer's expressions take it (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def piece_pattern(letters: str, numbers: str) -> regex.Pattern:
    """The tokenizer's split (fixed values), for these letters and numbers of a character class."""
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACE}{letters}{numbers}]+"
    )


PIECE = piece_pattern(r"\p{L}", r"\p{N}")
#: Pieces up to so many symbols are merged by scans; the work of a scan grows with the square.
SCAN = 64
#: Pieces whose encoding a Python worker keeps between groups of texts, and texts in a group.
KEPT = 300_000
TEXTS = 250


@cache
def byte_symbols() -> tuple[str, ...]:
    """The printable sign of each byte: itself if it is printable Latin-1, else the next from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return tuple(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256))


@dataclass(frozen=True)
class Signs:
    """Where the Unicode tables of the tokenizer's library differ from those of Python.

    ``odd`` holds the signs that one of them takes for a letter or number, lower-cases or composes
    in another way; ``letters`` and ``numbers`` are the library's classes, as ranges.
    """

    odd: frozenset[str]
    letters: str
    numbers: str

    @staticmethod
    @cache
    def of_library() -> Signs:
        """The tables of the installed library, asked sign by sign (about two seconds, once a driver)."""
        from tokenizers import Regex, normalizers, pre_tokenizers

        every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
        joined = "".join(every)

        def ranges(pattern: str) -> tuple[set[str], str]:
            splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
            members = [s for part, _ in splitter.pre_tokenize_str(joined) for s in part]
            places = np.array([ord(s) for s in members])
            breaks = np.flatnonzero(np.diff(places) != 1)
            starts = places[np.r_[0, breaks + 1]].tolist()
            stops = places[np.r_[breaks, len(places) - 1]].tolist()
            text = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, stops, strict=True))
            return set(members), text

        letters, letter_ranges = ranges(r"\p{L}+")
        numbers, number_ranges = ranges(r"\p{N}+")
        lower = normalizers.Lowercase().normalize_str
        composed = normalizers.NFC().normalize_str
        odd = letters ^ set(regex.findall(r"\p{L}", joined))
        odd |= numbers ^ set(regex.findall(r"\p{N}", joined))
        odd |= {s for s in every if lower(s) != s.lower()}
        marks = set(regex.findall(r"\p{M}", joined))
        for sign in marks.union(s for s in every if unicodedata.decomposition(s)):
            apart = unicodedata.normalize("NFD", sign)
            # Marks below and above the letter move before or after a mark of another class.
            for tried in (sign, f"a{sign}\u0323\u0301", f"a\u0301{sign}", apart):
                if composed(tried) != unicodedata.normalize("NFC", tried):
                    odd.update(sign, apart)
        odd |= {s for s in every if not odd.isdisjoint(s.lower())}
        return Signs(frozenset(odd), letter_ranges, number_ranges)


@cache
def _library_pieces(signs: Signs) -> regex.Pattern:
    return piece_pattern(signs.letters, signs.numbers)


class Vocabulary:
    """Ids, merge ranks and special tokens of a vocabulary with word ends."""

    def __init__(self, text: str):
        data = json.loads(text)
        model = data["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.tokens = {i: t for t, i in (self.ids | self.specials).items()}
        shown = byte_symbols()
        self.inner = np.array([self.ids[c] for c in shown], np.int64)
        self.ending = np.array([self.ids[c + self.suffix] for c in shown], np.int64)
        keys = np.array([(self.ids[a] << 32) + self.ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        #: Pairs of ids in order, with the rank of each; the id that each rank makes.
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids; ``none`` for those that do not merge (or have no right part)."""
        keys = (left << 32) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (right >= 0), self.key_ranks[at], self.none)

    def merge(self, pieces: list[str]) -> list[list[int]]:
        """The ids of every piece. Short pieces of like length are merged side by side."""
        coded = [piece.encode() for piece in pieces]
        out: list[list[int]] = [[]] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, data in enumerate(coded):
            if len(data) > SCAN:
                out[i] = self._merge_long(pieces[i])
            else:
                groups.setdefault(max(4, 1 << (len(data) - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            for start in range(0, len(members), 20_000):
                part = members[start : start + 20_000]
                found = self._merge_short([coded[i] for i in part], width)
                for i, ids in zip(part, found, strict=True):
                    out[i] = ids
        return out

    def _merge_short(self, coded: list[bytes], width: int) -> list[list[int]]:
        """Rows of parts (their boundaries are the row's cells) beside rows of adjacent ranks.

        In each step every row finds its least rank, deletes the boundary there (so the cells to
        the right move up), and refreshes the ranks on either side.
        """
        sizes = np.array([len(c) for c in coded])
        cells = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in coded), np.uint8)
        cells = cells.reshape(len(coded), width)
        columns = np.arange(width)
        parts = self.inner[cells]
        rows = np.arange(len(coded))
        parts[rows, sizes - 1] = self.ending[cells[rows, sizes - 1]]
        parts[columns >= sizes[:, None]] = -1
        ranks = np.full(parts.shape, self.none, np.int32)
        ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        out: list[list[int]] = [[]] * len(coded)
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            least = ranks[here, at]
            done = np.flatnonzero(least == self.none)
            for row, ids, size in zip(
                rows[done].tolist(), parts[done].tolist(), (parts[done] >= 0).sum(1).tolist(), strict=True
            ):
                out[row] = ids[:size]
            going = np.flatnonzero(least < self.none)
            rows, parts, ranks, at = rows[going], parts[going], ranks[going], at[going]
            here = np.arange(len(rows))
            parts[here, at] = self.made[least[going]]
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, 1)
            ranks = np.take_along_axis(ranks, source, 1)
            parts[:, -1] = -1
            ranks[:, -1] = self.none
            after = np.where(at + 1 < width, parts[here, np.minimum(at + 1, width - 1)], -1)
            ranks[here, at] = self.rank(parts[here, at], after)
            left = np.flatnonzero(at)
            before = at[left] - 1
            ranks[left, before] = self.rank(parts[left, before], parts[left, at[left]])
        return out

    def _merge_long(self, piece: str) -> list[int]:
        """The same merges for a long piece: a heap of pairs over a linked list, n log n steps."""
        shown = byte_symbols()
        symbols = [shown[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        ranks = self.ranks
        heap = [
            (ranks[pair], i, pair)
            for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
            if pair in ranks
        ]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                new = (symbols[i], symbols[after[i]])
                if new in ranks:
                    heapq.heappush(heap, (ranks[new], i, new))
            if before[i] >= 0:
                new = (symbols[before[i]], symbols[i])
                if new in ranks:
                    heapq.heappush(heap, (ranks[new], before[i], new))
        return [self.ids[s] for s in symbols if s]


class Coder:
    """Encodes texts with one vocabulary and keeps what it has found for short pieces."""

    def __init__(self, vocabulary: Vocabulary, signs: Signs | None = None):
        self.vocabulary = vocabulary
        self.signs = signs or Signs.of_library()
        self.kept: dict[str, tuple[str, int, str]] = {}
        listed = sorted(vocabulary.specials, key=len)[::-1]
        self.special = regex.compile("(" + "|".join(map(regex.escape, listed)) + ")")

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text in order; a special token stands as itself, after a zero sign."""
        if not any(token in text for token in self.vocabulary.specials):
            return split(text, self.signs)
        out: list[str] = []
        for part in self.special.split(text):
            out += ["\0" + part] if part in self.vocabulary.specials else split(part, self.signs)
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[str, int, str]]]:
        """For each text and piece: its ids joined by a space, how many, its tokens joined."""
        parted = [self.pieces(text) for text in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        fresh = list(set().union(*parted) - self.kept.keys())
        tokens, specials = self.vocabulary.tokens, self.vocabulary.specials
        own = [p for p in fresh if p[0] == "\0" and p[1:] in specials]
        for piece in own:
            self.kept[piece] = (str(specials[piece[1:]]), 1, piece[1:])
        fresh = [p for p in fresh if p not in self.kept]
        for piece, ids in zip(fresh, self.vocabulary.merge(fresh), strict=True):
            self.kept[piece] = (
                " ".join(map(str, ids)), len(ids), " ".join([tokens[i] for i in ids])
            )
        found = self.kept.__getitem__
        return [list(map(found, pieces)) for pieces in parted]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space; ids that the vocabulary lacks are left out."""
        tokens = self.vocabulary.tokens
        return " ".join(tokens[i] for i in ids if i in tokens)


def split(text: str, signs: Signs) -> list[str]:
    """The pieces of a text after composing (NFC) and lower-casing sign by sign.

    Texts with signs that Python's tables know otherwise are composed, lower-cased and split by
    the library's tables.
    """
    if text.isascii():
        return PIECE.findall(text.lower())
    if signs.odd.isdisjoint(text):
        composed = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return PIECE.findall(composed.lower())
    from tokenizers import normalizers

    shown = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
    return _library_pieces(signs).findall(shown)


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The vocabulary file's text, read where the path points to: the driver, or a shared store."""
    if "://" in path:
        return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    with open(path, encoding="utf-8") as file:
        return file.read()


@cache
def _coder(text: str, signs: Signs) -> Coder:
    return Coder(Vocabulary(text), signs)


def encode_texts(
    docs: DataFrame, path: str, keep: list[str], with_ids: bool = True, with_text: bool = False
) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256, and on demand ids and decoded.

    Whole texts are encoded; null counts as empty (no tokens, the hashes of the empty text). The
    decoded text is the tokens of the ids joined by a space, special tokens included. Rows are
    coded one by one, so repeated rows and an empty table need no care; other columns than ``keep``
    and text are not read. The vocabulary and the tables of signs have a fixed size and are
    broadcast once.
    """
    fixed = read_vocabulary(docs.sparkSession, path), Signs.of_library()
    shared = docs.sparkSession.sparkContext.broadcast(fixed)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                out = [], [], [], [], []
                texts = [text or "" for text in part.column(len(keep)).to_pylist()]
                for found in coder.encode(texts):
                    ids = " ".join([f[0] for f in found])
                    decoded = " ".join([f[2] for f in found])
                    out[0].append(sum([f[1] for f in found]))
                    out[1].append(sha256(ids.encode()).hexdigest())
                    out[2].append(sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        out[3].append(list(map(int, ids.split())))
                    if with_text:
                        out[4].append(decoded)
                arrays = [
                    *(part.column(i) for i in range(len(keep))),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.string()),
                    pa.array(out[2], pa.string()),
                ]
                if with_ids:
                    arrays.append(pa.array(out[3], pa.list_(pa.int32())))
                if with_text:
                    arrays.append(pa.array(out[4], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    made += ["ids"] * with_ids + ["decoded"] * with_text
    names = [*keep, *made]
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string")
    schema = schema.add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    if with_text:
        schema = schema.add("decoded", "string")
    return docs.select(*keep, "text").mapInArrow(code, schema)

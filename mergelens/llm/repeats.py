"""Passages that repeat across documents: found by recompression names, confirmed by their words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelens.llm.recompression import stretch_hashes, window_names
from mergelens.llm.words import as_bytes, signed, word_hashes
from mergelens.session import cut_lineage

#: Words that are named together, to spare calls; texts are never cut.
TOGETHER = 150_000


@dataclass
class Parsed:
    """One text: its words, the name of each window and the cells of equal names in a row."""

    words: list[bytes]
    hashes: np.ndarray
    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def parsed(texts: list[bytes], window: int) -> Iterator[Parsed]:
    """Every text in order. Texts are named side by side, with a sign between that none has."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        held.append(text.split())
        size += len(held[-1])
        if size >= TOGETHER:
            yield from _parsed_together(held, window)
            held, size = [], 0
    yield from _parsed_together(held, window)


def _parsed_together(texts: list[list[bytes]], window: int) -> Iterator[Parsed]:
    parts, offsets, at = [], [], 0
    for number, words in enumerate(texts):
        offsets.append(at)
        parts += [word_hashes(words), np.array([_border(number)], np.uint64)]
        at += len(words) + 1
    if not texts:
        return
    hashes = np.concatenate(parts)
    names = window_names(hashes, window)
    for words, start in zip(texts, offsets, strict=True):
        own = names[start : start + max(0, len(words) - window + 1)]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, int)
        ends = np.r_[starts[1:], len(own)] if len(own) else starts
        yield Parsed(words, hashes[start : start + len(words)], own, starts, ends)


def _border(number: int) -> int:
    return (0xF1EA5EED << 32) + number


def _cell_hashes(text: Parsed, window: int) -> np.ndarray:
    """Hashes of the words that the windows of each cell cover."""
    return stretch_hashes(text.hashes, text.starts, text.ends + window - 1)


def cells(docs: DataFrame, window: int) -> DataFrame:
    """name, words (a hash of those the cell covers) and doc_id of every cell of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            names, covered, owners = [], [], []
            for owner, text in zip(ids, parsed(as_bytes(batch.column(1)), window), strict=True):
                if len(text.names):
                    names.append(text.names[text.starts])
                    covered.append(_cell_hashes(text, window))
                    owners.append(np.full(len(text.starts), owner, np.int64))
            if names:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(names))),
                        pa.array(signed(np.concatenate(covered))),
                        pa.array(np.concatenate(owners)),
                    ],
                    names=["name", "words", "doc_id"],
                )

    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(cut, "name long, words long, doc_id long")


def _marks(found: DataFrame) -> DataFrame:
    """doc_id, plain and mixed: names whose windows may stand in a smaller document.

    A name that covers the same words wherever it stands is plain: its windows repeat in every
    document but the smallest. One that covers different words is mixed: its windows are compared
    one by one. Names of one document are dropped. Names are aggregated before the shuffle; the
    join back on the few that repeat can be split where one stands in very many documents.
    """
    shared = (
        found.groupBy("name")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("doc_id").alias("most"),
            (F.min("words") != F.max("words")).alias("differs"),
        )
        .where(F.col("least") < F.col("most"))
        .select("name", "least", "differs")
    )
    mine = found.select("name", "doc_id").join(shared, "name")
    mine = mine.where(F.col("differs") | (F.col("doc_id") > F.col("least")))
    return mine.groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("differs"), F.col("name"))).alias("plain"),
        F.collect_set(F.when(F.col("differs"), F.col("name"))).alias("mixed"),
    )


def _covered(windows: np.ndarray, words: int, window: int) -> np.ndarray:
    """Which words the marked windows cover."""
    steps = np.zeros(words + 1, np.int64)
    np.add.at(steps, windows, 1)
    np.add.at(steps, windows + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _listed(column: pa.Array) -> Iterator[np.ndarray]:
    for values in column:
        values = values.values
        yield np.empty(0, np.uint64) if values is None else values.to_numpy().view(np.uint64)


_NAMES = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _kept(words: list[bytes], covered: np.ndarray, texts: bool) -> tuple[str, str | None]:
    """The digest of the kept words joined by a space, and on demand the text."""
    if covered.any():
        words = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
    text = b" ".join(words)
    return sha256(text).hexdigest(), text.decode() if texts else None


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield batch.slice(start, 500)


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id and the compressed text, for the way to other machines; null counts as empty."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for part in _parts(batches):
            made = [compress(text) for text in as_bytes(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(made, pa.binary())], names=["doc_id", "packed"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pack, "doc_id long, packed binary"
    )


def _unpacked(column: pa.Array) -> list[bytes]:
    restore = zstandard.ZstdDecompressor().decompress
    return [restore(value) for value in column.to_pylist()]


def _mixed_windows(marked: DataFrame, window: int) -> DataFrame:
    """doc_id, hash and check (both of its words) of every window that has a mixed name."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            raw = _unpacked(part.column("packed"))
            asked = [(i, n) for i, n in enumerate(_listed(part.column("mixed"))) if len(n)]
            hashes, checks, owners = [], [], []
            texts = parsed([raw[i] for i, _ in asked], window)
            for (i, names), text in zip(asked, texts, strict=True):
                at = np.flatnonzero(np.isin(text.names, names))
                one = stretch_hashes(text.hashes, at, at + window)
                one, first = np.unique(one, return_index=True)
                hashes.append(one)
                checks.append(text.names[at][first])
                owners.append(np.full(len(one), ids[i], np.int64))
            if hashes:
                check = (np.concatenate(checks) & np.uint64(0x7FFFFFFF)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(owners)),
                        pa.array(signed(np.concatenate(hashes))),
                        pa.array(check),
                    ],
                    names=["doc_id", "hash", "check"],
                )

    return marked.mapInArrow(look, "doc_id long, hash long, check int")


def _repeated(windows: DataFrame) -> DataFrame:
    """doc_id and the hashes of its windows that also stand in a smaller document."""
    shared = (
        windows.groupBy("hash", "check")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where(F.col("least") < F.col("most"))
        .select("hash", "check", "least")
    )
    return (
        windows.join(shared, ["hash", "check"])
        .where(F.col("doc_id") > F.col("least"))
        .groupBy("doc_id")
        .agg(F.collect_set("hash").alias("repeated"))
    )


def _judge(rows: DataFrame, window: int, texts: bool) -> DataFrame:
    """The result of every text with its plain and mixed names and its repeated windows."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            raw = _unpacked(part.column("packed"))
            plain, mixed_names, repeated = (
                list(_listed(part.column(n))) for n in ("plain", "mixed", "repeated")
            )
            named = [i for i in range(len(raw)) if len(plain[i]) or len(repeated[i])]
            found = dict(zip(named, parsed([raw[i] for i in named], window), strict=True))
            out: list[list] = [[], [], [], []]
            for i, text in enumerate(raw):
                words = found[i].words if i in found else text.split()
                covered = np.zeros(len(words), bool)
                if i in found:
                    one = found[i]
                    hit = np.isin(one.names, plain[i])
                    if len(repeated[i]):
                        at = np.flatnonzero(np.isin(one.names, mixed_names[i]))
                        again = np.isin(stretch_hashes(one.hashes, at, at + window), repeated[i])
                        hit[at[again]] = True
                    covered = _covered(np.flatnonzero(hit), len(words), window)
                row = (len(words), int(covered.sum()), *_kept(words, covered, texts))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))],
                names=_NAMES,
            )

    return rows.select("doc_id", "packed", "plain", "mixed", "repeated").mapInArrow(judge, _RESULT)


def remove_repeats(docs: DataFrame, window: int = 13, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept_text of every row.

    A word goes if a window of ``window`` words that covers it also stands in a document with a
    smaller doc_id; windows are those of the input. Words are runs without ASCII white space, kept
    unchanged and joined by one space.

    1. Recompression names every window; a row for each stretch of equal names (cell) is counted.
    2. Names in several documents are sent back to them. Where such a name always covers the same
       words, its windows are decided; the others are compared window by window, by their words.

    Null and empty texts have no words. Rows of one doc_id do not count against each other; a row
    without doc_id neither loses words nor takes any. An empty table gives no rows. Other columns
    are not read. Words and stretches are compared by 64-bit hashes, windows by 31 bits more. Texts
    are sent to the marks of their documents once, compressed, for both looks at them.
    """
    marks = cut_lineage(_marks(cells(docs, window)))
    marked = _packed(docs).join(marks, "doc_id", "left")
    marked = marked.select("doc_id", "packed", "plain", "mixed")
    repeated = _repeated(_mixed_windows(marked, window))
    rows = _judge(marked.join(repeated, "doc_id", "left"), window, texts)
    return rows if texts else rows.drop("kept_text")

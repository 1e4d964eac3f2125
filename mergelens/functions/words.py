"""N-grams over whole Arrow columns, many texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text, or words, that are cut at a time.
SLICE = 1 << 21
#: Bytes of text whose n-grams are counted together.
COUNTED = 1 << 23
_IS_WORD = np.zeros(256, bool)
_IS_WORD[128:] = True
for _sign in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_":
    _IS_WORD[_sign] = True


def _blanked(text: Column) -> Column:
    """Lower case; beyond ASCII only letters and digits are left, so that every such byte is a word's."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    plain = F.length(lower) == F.octet_length(lower)
    return F.when(plain, lower).otherwise(F.regexp_replace(lower, r"[^\x00-\x7F\p{L}\p{N}]+", " "))


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _in_slices(column: pa.Array, sizes: Callable[[pa.Array], np.ndarray], one: Callable, kind: pa.DataType) -> pa.Array:
    """``one`` over neighbouring rows of about SLICE together; a longer row is a slice of its own."""
    parts = [one(part).cast(kind) for part in _slices(column, sizes, SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _slices(column: pa.Array, sizes: Callable[[pa.Array], np.ndarray], limit: int) -> Iterator[pa.Array]:
    places = (np.cumsum(sizes(column)) // limit) if len(column) else np.zeros(0, int)
    start = 0
    for end in [*(np.flatnonzero(np.diff(places)) + 1).tolist(), len(column)]:
        if end > start:
            yield column.slice(start, end - start)
        start = end


def _bytes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def _cut(texts: pa.Array, min_length: int, stop_words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and where those of each text begin; one place more for the end."""
    texts = pa.concat_arrays([texts.cast(pa.string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside & edge[:-1]
    starts[1:] |= inside[1:] & ~inside[:-1]
    stops = inside & edge[1:]
    stops[:-1] |= inside[:-1] & ~inside[1:]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    ends = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    first = np.searchsorted(starts, offsets)
    keep = None
    if min_length > 1:
        keep = pc.utf8_length(words).to_numpy(zero_copy_only=False) >= min_length
    if len(stop_words):
        other = ~pc.is_in(words, value_set=stop_words).to_numpy(zero_copy_only=False)
        keep = other if keep is None else keep & other
    if keep is not None:
        words = words.filter(pa.array(keep))
        first = np.concatenate([[0], np.cumsum(keep)])[first]
    return words, first


def _rows(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _by_row(rows: list[np.ndarray], values: list[pa.Array], count: int) -> pa.ListArray:
    """Lists of the values of each row, those of an earlier part first."""
    every = np.concatenate(rows)
    order = np.argsort(every, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(every, minlength=count))])
    return _lists(offsets, pa.concat_arrays(values).take(pa.array(order)))


def known_ngrams(
    text: Column, known: Sequence[str], stop_words: Sequence[str], min_length: int, lengths: tuple[int, int]
) -> Column:
    """``terms``: the n-grams of a text that are ``known``, the shorter ones first; ``last``: its last
    words, one less than the longest n-gram, null where they are part of no known one."""
    stops = pa.array(sorted(set(stop_words)), pa.string())
    low, high = lengths
    parts = sorted({word for term in known for word in term.split(" ")})
    place = {word: i for i, word in enumerate(parts)}
    listed = pa.array(list(known), pa.string())
    # Beginnings of known terms by their number of words; a longer one is the beginning and a word.
    begun: dict[tuple[int, ...], int] = {(i,): i for i in range(len(parts))}
    steps: list[dict[int, int]] = []
    terms: list[np.ndarray] = []
    for n in range(1, high + 1):
        paths = sorted({tuple(place[w] for w in t.split(" "))[:n] for t in known if len(t.split(" ")) >= n})
        if n > 1:
            longer = {path: i for i, path in enumerate(paths)}
            steps.append({begun[path[:-1]] * len(parts) + path[-1]: i for path, i in longer.items()})
            begun = longer
        at = np.full(max(len(begun), 1), -1)
        for i, term in enumerate(known):
            path = tuple(place[w] for w in term.split(" "))
            if len(path) == n:
                at[begun[path]] = i
        terms.append(at)
    tables = [
        (np.array(sorted(step), np.int64), np.array([step[k] for k in sorted(step)], np.int64)) for step in steps
    ]
    kind = pa.struct([("terms", pa.list_(pa.string())), ("last", pa.list_(pa.string()))])
    values = pa.array(parts, pa.string())

    def one(texts: pa.Array) -> pa.Array:
        words, first = _cut(texts, min_length, stops)
        own = _rows(first)
        codes = pc.fill_null(pc.index_in(words, value_set=values), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(codes >= 0)
        ids, rows, found = codes[at], [], []
        for n in range(1, high + 1):
            if n > 1:
                # Beginnings that the next word of the same text goes on with.
                follows = at + n - 1 < len(codes)
                at, ids = at[follows], ids[follows]
                goes = (own[at] == own[at + n - 1]) & (codes[at + n - 1] >= 0)
                at, ids = at[goes], ids[goes]
                keys, numbers = tables[n - 2]
                wanted = ids * len(parts) + codes[at + n - 1]
                near = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
                hit = keys[near] == wanted if len(keys) else np.zeros(len(wanted), bool)
                at, ids = at[hit], numbers[near[hit]] if len(keys) else ids[:0]
            if n >= low:
                term = terms[n - 1][ids]
                rows.append(own[at[term >= 0]])
                found.append(listed.take(pa.array(term[term >= 0])))
        tail = np.maximum(first[1:] - (high - 1), first[:-1])
        sizes = first[1:] - tail
        begins = np.concatenate([[0], np.cumsum(sizes)])
        spots = np.arange(begins[-1]) - np.repeat(begins[:-1] - tail, sizes)
        ending = values.take(pa.array(codes[spots], mask=codes[spots] < 0))
        made = [_by_row(rows, found, len(first) - 1), _lists(begins, ending)]
        return pa.StructArray.from_arrays(made, names=["terms", "last"])

    @F.arrow_udf("struct<terms: array<string>, last: array<string>>")
    def known_terms(texts: pa.Array) -> pa.Array:
        return _in_slices(texts, _bytes, one, kind)

    return known_terms(_blanked(text))


def _totals(texts: pa.Array, stops: pa.Array, min_length: int, lengths: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of the texts with its occurrences and the number of texts that have it."""
    words, first = _cut(texts, min_length, stops)
    own = _rows(first)
    encoded = words.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    listed = names = encoded.dictionary
    at, keys = np.arange(len(codes)), codes
    low, high = lengths
    for n in range(1, high + 1):
        if n > 1:
            # An n-gram is a shorter one and the next word of the same text.
            follows = at + n - 1 < len(codes)
            at, ids = at[follows], ids[follows]
            goes = own[at] == own[at + n - 1]
            at, ids = at[goes], ids[goes]
            keys = ids * len(listed) + codes[at + n - 1]
        if not len(keys):
            return
        # Equal keys keep their order, so that those of one text are neighbours.
        order = np.argsort(keys, kind="stable")
        ordered, rows = keys[order], own[at][order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        starts = np.flatnonzero(new)
        fresh = new | np.concatenate([[True], rows[1:] != rows[:-1]])
        found = ordered[starts]
        if n > 1:
            before, last = pa.array(found // len(listed)), pa.array(found % len(listed))
            names = pc.binary_join_element_wise(names.take(before), listed.take(last), " ")
        else:
            names = listed.take(pa.array(found))
        ids = np.empty(len(keys), np.int64)
        ids[order] = np.cumsum(new) - 1
        if n >= low:
            tf = np.diff(np.append(starts, len(keys)))
            df = np.add.reduceat(fresh.astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays([names, pa.array(tf), pa.array(df)], names=["term", "tf", "df"])


def ngram_totals(
    docs: DataFrame, text: str, stop_words: Sequence[str], min_length: int, lengths: tuple[int, int]
) -> DataFrame:
    """``term``, ``tf``, ``df`` of all n-grams: occurrences, and rows that have it.

    Tasks count each term once for many texts; Spark adds the counts up.
    """
    stops = pa.array(sorted(set(stop_words)), pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _slices(batch.column(0), _bytes, COUNTED):
                yield from _totals(texts, stops, min_length, lengths)

    counted = docs.select(_blanked(F.col(text)).alias("text")).mapInArrow(count, "term string, tf bigint, df bigint")
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))

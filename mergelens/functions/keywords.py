"""Which of many keywords a text has, by one pass over the bytes of a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes that are looked at together.
CHUNK = 1 << 21


class Finder:
    """Keywords filed under three of their bytes: the first ones, or those where ``grams`` have theirs.

    Every byte of a keyword has a class of its own, all others share class 0, so equal classes are
    equal bytes. Keywords below three bytes are searched one by one.
    """

    def __init__(self, keywords: Sequence[str], grams: Sequence[str] | None = None) -> None:
        self.keywords = list(keywords)
        coded = [k.encode() for k in self.keywords]
        used = sorted({byte for word in coded for byte in word})
        self.bits = max(1, len(used).bit_length())
        self.kind = np.uint16 if 3 * self.bits <= 16 else np.uint32
        self.classes = np.zeros(256, self.kind)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.starts = np.zeros(1 << 3 * self.bits, bool)
        #: Number, size, place of the filed bytes, other places with their bytes.
        self.long: list[tuple[int, int, int, list[tuple[int, int]]]] = []
        filed = []
        for number, word in enumerate(coded):
            if len(word) >= 3:
                runs = self._runs(np.frombuffer(word, np.uint8))
                at = min(word.find(grams[number].encode()), len(word) - 3) if grams else 0
                others = {*range(0, len(word) - 2, 3), len(word) - 3} - {at}
                self.long.append((number, len(word), at, [(p, int(runs[p])) for p in sorted(others)]))
                filed.append(runs[at])
        self.filed = np.array(filed, self.kind)
        self.starts[self.filed] = True
        self.short = [number for number, word in enumerate(coded) if len(word) < 3]

    def _runs(self, data: np.ndarray) -> np.ndarray:
        """The classes of every three neighbouring bytes as one number."""
        one, bits = self.classes[data], self.kind(self.bits)
        return ((one[:-2] << bits | one[1:-1]) << bits) | one[2:]

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows and numbers of the keywords that each text has, ascending; null texts have none."""
        count = len(self.keywords)
        if not len(texts) or not count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = []
        for number in self.short:
            hit = pc.match_substring(texts, self.keywords[number]).fill_null(False)
            pairs.append(np.flatnonzero(hit.to_numpy(zero_copy_only=False)) * count + number)
        texts = texts.fill_null("").cast(pa.large_string())
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)
        for first, last in self._chunks(ends):
            rows, numbers = self._hits(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
            pairs.append((rows + first) * count + numbers)
        return np.divmod(np.unique(np.concatenate(pairs)), count)

    @staticmethod
    def _chunks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
        first = 0
        while first < len(ends) - 1:
            last = int(np.searchsorted(ends, ends[first] + CHUNK, "right")) - 1
            last = max(last, first + 1)
            yield first, last
            first = last

    def _hits(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and numbers of all places of the longer keywords."""
        starts, numbers, sizes = [np.zeros(0, np.int64)], [0], [0]
        if len(data) >= 3:
            runs = self._runs(data)
            at = np.flatnonzero(self.starts[runs])
            held = runs[at]
            order = np.argsort(held, kind="stable")
            at, held = at[order], held[order]
            low, high = np.searchsorted(held, self.filed, "left"), np.searchsorted(held, self.filed, "right")
            for i in np.flatnonzero(high > low):
                number, size, place, others = self.long[i]
                hits = at[low[i] : high[i]] - place
                hits = hits[(hits >= 0) & (hits + size <= len(data))]
                for other, run in others:
                    hits = hits[runs[hits + other] == run]
                    if not len(hits):
                        break
                starts.append(hits)
                numbers.append(number)
                sizes.append(size)
        counts = [len(hits) for hits in starts]
        begun = np.concatenate(starts)
        rows = np.searchsorted(ends, begun, "right") - 1
        within = begun + np.repeat(sizes, counts) <= ends[rows + 1]
        return rows[within], np.repeat(numbers, counts)[within]


def keyword_codes(title: Column, combined: Column, keywords: Sequence[str]) -> Column:
    """Ascending codes of the keywords in ``combined``: twice the number, plus one if ``title`` has it too."""
    finder = Finder(keywords)

    def codes(titles: pa.Array, texts: pa.Array) -> pa.Array:
        rows, numbers = finder.found(texts)
        places = [r * len(finder.keywords) + n for r, n in ((rows, numbers), finder.found(titles))]
        values = 2 * numbers + np.isin(places[0], places[1])
        offsets = np.searchsorted(rows, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    codes.__annotations__ = {"titles": pa.Array, "texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(codes, "array<int>")(title, combined)

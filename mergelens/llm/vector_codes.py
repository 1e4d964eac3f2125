"""Product quantisation in whole numbers; distances come from Walsh-Hadamard coefficients."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelens.session import cut_lineage

LONG = np.iinfo(np.int64)
#: Vectors that are compared with a codebook at a time.
BLOCK = 8_192
#: Labels up to which their sums are broadcast (two longs each); more are joined by a shuffle.
BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class Codes:
    """``parts`` parts of a vector, ``entries`` entries of each part's codebook, update ``rounds``."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@cache
def sequency_order(size: int) -> tuple[int, ...]:
    """Rows of the Hadamard matrix of a power of two by their number of sign changes."""
    signs = np.array([[bin(i & j).count("1") & 1 for j in range(size)] for i in range(size)])
    changes = np.abs(np.diff(signs, axis=1)).sum(axis=1) if size > 1 else np.zeros(1, int)
    return tuple(int(i) for i in np.argsort(changes, kind="stable"))


def transformed(parts: np.ndarray) -> np.ndarray:
    """Unscaled Walsh-Hadamard coefficients of each row, zero-padded to a power of two, by sequency.

    Squared differences of coefficients sum to the size times the squared distance, exactly.
    """
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    out = np.zeros((len(parts), size), parts.dtype)
    out[:, : parts.shape[1]] = parts
    step = 1
    while step < size:
        pairs = out.reshape(len(out), -1, 2, step)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        out = out.reshape(len(parts), size)
        step *= 2
    return out[:, list(sequency_order(size))]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower index of equal ones, and the squared distance.

    The entry nearest in the first coefficient is measured in full; all others add coefficients in
    sequency order, in groups of 1, 1, 2, 4 …, and are given up once they are farther than it.
    """
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    if max(_largest(parts), _largest(entries)) > (1 << 30) // size:
        parts, entries = parts.astype(object), entries.astype(object)
    rows, columns = transformed(parts), transformed(entries)
    first = rows[:, :1] - columns[:, 0][None, :]
    first = first * first
    lead = rows - columns[np.argmin(first, axis=1)]
    bound = (lead * lead).sum(axis=1)
    row, entry = np.nonzero((first <= bound[:, None]).astype(bool))
    total = first[row, entry]
    start = 1
    while start < size:
        gap = rows[row, start : 2 * start] - columns[entry, start : 2 * start]
        total = total + (gap * gap).sum(axis=1)
        live = (total <= bound[row]).astype(bool)
        row, entry, total = row[live], entry[live], total[live]
        start *= 2
    starts = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(total, starts) if len(parts) else total
    best = (total == least[row]).astype(bool)
    index = np.zeros(len(parts), np.int64)
    # Written from the last to the first, so that the lowest index stays.
    index[row[best][::-1]] = entry[best][::-1]
    return index, least // size


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), kept within the range of a long."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    low, high = int(LONG.min), int(LONG.max)
    clipped = np.clip(scaled, -(2.0**64), 2.0**64).ravel().tolist()
    return np.array([min(max(int(x), low), high) for x in clipped], object).reshape(scaled.shape)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """One row for each vector, shorter ones filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], width: int, scale: int):
    """(batch, whole numbers) of at most BLOCK vectors."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, whole(matrix(part.column("vector"), width), scale)


def _is_whole(vector: Column) -> Column:
    """Vectors without null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def kept_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and the vector as doubles, of rows whose vector is whole."""
    rows = df.select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    return rows.where(_is_whole(F.col("vector")))


def _partial_sums(kept: DataFrame, books: np.ndarray, width: int, codes: Codes) -> DataFrame:
    """part, entry, members and their sum by position, one row for each task and used entry."""
    parts, step = len(books), books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for _, vectors in _blocks(batches, width, codes.scale):
            for part in range(parts):
                piece = vectors[:, part * step : (part + 1) * step]
                index, _ = nearest(piece, books[part])
                order = np.argsort(index, kind="stable")
                used, starts, members = np.unique(index[order], return_index=True, return_counts=True)
                # A block's sums may leave the range of a long only where values do.
                wide = _largest(piece) > LONG.max // (2 * BLOCK)
                members_of = piece.astype(object) if wide else piece
                added = np.add.reduceat(members_of[order], starts, axis=0)
                for entry, count, row in zip(used.tolist(), members.tolist(), added.tolist(), strict=True):
                    n, old = sums.get((part, entry), (0, [0] * step))
                    sums[part, entry] = (n + count, [int(a) + b for a, b in zip(row, old, strict=True)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part for part, _ in sums], pa.int32()),
                pa.array([entry for _, entry in sums], pa.int32()),
                pa.array([n for n, _ in sums.values()], pa.int64()),
                pa.array([[Decimal(x) for x in row] for _, row in sums.values()], pa.list_(pa.decimal128(38, 0))),
            ],
            ["part", "entry", "members", "sums"],
        )

    return kept.select("vector").mapInArrow(run, "part int, entry int, members long, sums array<decimal(38,0)>")


def fit_codebooks(kept: DataFrame, codes: Codes) -> np.ndarray:
    """Entries by (part, entry, position), as Python or 64-bit whole numbers.

    Each round is one pass over the rows; tasks return a sum for every entry, which Spark adds up.
    Only the codebooks, whose size is fixed by the parameters, reach the driver.
    """
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    step = -(-longest // codes.parts)
    width = step * codes.parts
    seeds = (
        kept.orderBy(F.col("vec_id").asc_nulls_last(), F.col("vector").asc()).limit(codes.entries).collect()
    )
    flat = np.zeros((len(seeds), width))
    for row, seed in zip(flat, seeds, strict=True):
        row[: len(seed.vector)] = seed.vector
    books = whole(flat, codes.scale).reshape(len(seeds), codes.parts, step).transpose(1, 0, 2)
    if not len(seeds) or not step:
        return books
    for _ in range(codes.rounds):
        totals = (
            _partial_sums(kept, books, width, codes)
            .groupBy("part", "entry")
            .agg(F.sum("members").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(step)))
            .collect()
        )
        books = books.astype(object)
        for row in totals:
            books[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(step)]
        if _largest(books) < 1 << 62:
            books = books.astype(np.int64)
    return books


def with_codes(kept: DataFrame, books: np.ndarray, codes: Codes) -> DataFrame:
    """vec_id, label, code and error of every vector."""
    parts, entries, step = books.shape
    width = parts * step
    schema = kept.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    digits = np.array([f"{i:02x}" for i in range(max(entries, 1))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, vectors in _blocks(batches, width, codes.scale):
            error = np.zeros(batch.num_rows, object)
            written = [np.full(batch.num_rows, "00")] * parts
            for part in range(parts if step else 0):
                index, distance = nearest(vectors[:, part * step : (part + 1) * step], books[part])
                error = error + distance.astype(object)
                written[part] = digits[index]
            text = ["".join(row) for row in zip(*(column.tolist() for column in written), strict=True)]
            error = [min(e, int(LONG.max)) for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return kept.mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def compress(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", codes: Codes = Codes()
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row with a whole vector.

    Null vectors and those with null, NaN or infinite components are left out. Components become
    floor(scale * x), kept within the range of a long as Spark's floor does; distances are exact, and
    errors above a long's range are the greatest long. The longest vector, filled up to a multiple of
    ``parts``, gives the width; shorter ones end in zeros, empty ones are all zeros. Codebooks start
    with the smallest ids, null ids after all others, and of rows of one id the smallest vector; with
    fewer rows they have fewer entries. Equal rows get equal results, each its own row. Labels may be
    null, which is one label. An empty table gives no rows. Other columns are not read. Rows are read
    ``rounds`` + 3 times, so give a written table. One label may hold any share of the rows: its sum
    is added up in the tasks first, and is broadcast up to BROADCAST_LABELS labels.
    """
    kept = kept_vectors(df, key, vector, label)
    books = fit_codebooks(kept, codes)
    coded = cut_lineage(with_codes(kept, books, codes))
    most = F.lit(int(LONG.max)).cast("decimal(38,0)")
    sums = cut_lineage(
        coded.groupBy("label").agg(
            F.least(F.sum(F.col("error").cast("decimal(28,0)")), most).cast("long").alias("label_error")
        )
    )
    known = sums.select(F.col("label").alias("_label"), "label_error")
    if sums.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return (
        coded.join(known, F.col("label").eqNullSafe(F.col("_label")))
        .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
    )

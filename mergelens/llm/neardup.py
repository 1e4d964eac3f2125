"""Near duplicates: an LSH forest over MinHash signatures, confirmed on full shingle sets.

The forest is that of Bawa, Condie and Ganesan, 2005: several orders of the same signatures, in each
of which documents with a long common prefix stand together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

from mergelens.llm.components import components
from mergelens.llm.positions import numbered
from mergelens.llm.words import as_bytes, mixed, shingle_hashes, signed, word_hashes
from mergelens.session import cut_lineage


@dataclass(frozen=True)
class NearDuplicates:
    """Sets of ``shingle`` words are linked from a similarity of ``percent`` / 100 on.

    ``trees`` orders of a signature each start with ``prefix`` values of their own: two linked
    sets share none of these prefixes with a probability of at most (1 - 0.8^4)^32 < 1e-7.
    Pairs with a common prefix whose signatures agree in less than ``agree`` places are not
    looked at again; a linked pair is below that with a probability of about 1e-9.
    ``region`` and ``cluster``: rows that one comparison block takes; larger groups are cut
    into blocks, all pairs of which are compared.
    """

    shingle: int = 4
    percent: int = 80
    trees: int = 32
    prefix: int = 4
    agree: int = 70
    region: int = 2048
    cluster: int = 256

    @property
    def values(self) -> int:
        return self.trees * self.prefix


def text_shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in order; words end at ASCII white space."""
    return np.unique(shingle_hashes(word_hashes(text.lower().split()), size))


@cache
def _hash_rows(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_05)
    draw = random.integers(0, 1 << 32, (2, count, 1), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of the set under each of ``count`` hash functions (32 bits)."""
    factor, shift = _hash_rows(count)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(count, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 2048):
        out = np.minimum(out, (short[None, start : start + 2048] * factor + shift).min(1))
    return out


def set_facts(docs: DataFrame, settings: NearDuplicates) -> DataFrame:
    """doc_id, n_shingles, hi, lo (a 128-bit name of the set) and signature of every row."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, signatures = [], [], []
            for text in as_bytes(batch.column(1)):
                found = text_shingles(text, settings.shingle)
                sizes.append(len(found))
                names.append(xxh3_128_intdigest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, settings.values).tobytes() if len(found) else None)
            low = (1 << 63) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([n if n is None else n >> 65 for n in names], pa.int64()),
                    pa.array([n if n is None else n & low for n in names], pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "hi", "lo", "signature"],
            )

    schema = "doc_id long, n_shingles long, hi long, lo long, signature binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look, schema)


def _values(column: pa.ChunkedArray | pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, count)


def forest(nodes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """A row per node and tree: region (tree and prefix), tail (the next values) and node.

    The tail holds 16 bits of each of the next four values, so rows of a region sorted by it
    stand by their longest common prefix.
    """
    count, prefix = settings.values, settings.prefix

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _values(batch.column(1), count).astype(np.uint64)
            regions, tails = [], []
            for tree in range(settings.trees):
                order = (np.arange(prefix + 4) + tree * prefix) % count
                region = np.full(len(values), tree + 1, np.uint64)
                for at in order[:prefix]:
                    region = mixed(region + values[:, at])
                tail = np.zeros(len(values), np.uint64)
                for at in order[prefix:]:
                    tail = (tail << np.uint64(16)) | (values[:, at] >> np.uint64(16))
                regions.append(region)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate(regions))),
                    pa.array(signed(np.concatenate(tails))),
                    pa.array(np.tile(batch.column(0).to_numpy(), settings.trees)),
                ],
                names=["region", "tail", "node"],
            )

    return nodes.select("node", "signature").mapInArrow(plant, "region long, tail long, node long")


def in_blocks(members: DataFrame, group: str, order: list[str], rows: int) -> DataFrame:
    """``members`` (with the ``size`` of their group) once for each pair of blocks they are in.

    Groups of up to ``rows`` rows are one block. Larger ones are cut into blocks of so many rows in
    order; block i comes with every block j, as (first, second), and ``block`` says which one a
    row is from. All pairs of rows of a group so meet in some (group, first, second).
    """
    one = F.lit(0)
    small = members.where(F.col("size") <= rows).select(
        *members.columns, one.alias("first"), one.alias("second"), one.alias("block")
    )
    large = numbered(
        members.where(F.col("size") > rows), [group], [F.col(c).asc() for c in order], "position"
    )
    block = F.floor(F.col("position") / rows).cast("int")
    last = F.floor((F.col("size") - 1) / rows).cast("int")
    large = (
        large.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(
            *members.columns,
            F.least("block", "other").alias("first"),
            F.greatest("block", "other").alias("second"),
            "block",
        )
    )
    return small.unionByName(large)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, list[int]]]:
    """Sorted rows as tables that end where a group ends, with the bounds of their groups."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        columns = [table.column(k).to_numpy() for k in keys]
        changes = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = [0, *(np.flatnonzero(changes) + 1).tolist()]
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        held = table.slice(starts[-1])
    if held is not None:
        yield held, [0, held.num_rows]


class Linked:
    """Rows joined so far, and the pairs that joined them: at most one for each row but one."""

    def __init__(self, count: int):
        self.labels = np.arange(count)
        self.pairs: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        for other in others.tolist():
            if self.labels[row] != self.labels[other]:
                self.pairs.append((row, other))
                self.labels[self.labels == self.labels[other]] = self.labels[row]


def _compared(
    rows: int, block: np.ndarray, cross: bool, alike: Callable[[int, np.ndarray], np.ndarray]
) -> list[tuple[int, int]]:
    """Pairs that connect what ``alike`` connects; neighbours in the order are tried first.

    Rows already connected are not compared again. With ``cross`` only rows of different blocks.
    """
    linked = Linked(rows)
    if not cross:
        for row in range(rows - 1):
            linked.join(row, alike(row, np.array([row + 1])))
    for row in range(rows - 1):
        others = np.flatnonzero(linked.labels[row + 1 :] != linked.labels[row]) + row + 1
        if cross:
            others = others[block[others] != block[row]]
        if len(others):
            linked.join(row, alike(row, others))
    return linked.pairs


def _linking(group: str, matcher) -> Callable:
    """A function over sorted batches: the connecting pairs (a, b) of every group of blocks."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, [group, "first", "second"]):
            nodes = table.column("node").to_numpy()
            block = table.column("block").to_numpy()
            cross = table.column("first").to_numpy() != table.column("second").to_numpy()
            pairs: list[tuple[int, int]] = []
            match = matcher(table)
            for start, end in zip(bounds, bounds[1:], strict=False):
                if end - start > 1:
                    found = _compared(
                        end - start, block[start:end], bool(cross[start]), match(start, end)
                    )
                    pairs += [(start + a, start + b) for a, b in found]
            picked = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[picked[:, 0]]), pa.array(nodes[picked[:, 1]])], names=["a", "b"]
            )

    return link


def _by_signature(settings: NearDuplicates):
    def matcher(table: pa.Table):
        values = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8)
        values = values.reshape(-1, settings.values)

        def match(start: int, end: int):
            own = values[start:end]
            return lambda row, others: others[
                (own[others] == own[row]).sum(1) >= settings.agree
            ]

        return match

    return matcher


def _by_set(settings: NearDuplicates):
    """Exact similarities: for a row, shared shingles are counted through lists of their rows."""

    def matcher(table: pa.Table):
        raw = table.column("shingles").to_pylist()

        def match(start: int, end: int):
            sets = [np.frombuffer(raw[i], np.uint64) for i in range(start, end)]
            sizes = np.array([len(s) for s in sets])
            if len(sets) == 2:
                shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
                close = 100 * shared >= settings.percent * (sizes.sum() - shared)
                return lambda row, others: others if close else others[:0]
            _, numbers, counts = np.unique(
                np.concatenate(sets), return_inverse=True, return_counts=True
            )
            owners = np.repeat(np.arange(len(sets)), sizes)[np.argsort(numbers, kind="stable")]
            heads = np.concatenate([[0], np.cumsum(counts)])
            ends = np.concatenate([[0], np.cumsum(sizes)])

            def alike(row: int, others: np.ndarray) -> np.ndarray:
                if len(others) == 1:
                    shared = np.array(
                        [len(np.intersect1d(sets[row], sets[others[0]], assume_unique=True))]
                    )
                else:
                    own = numbers[ends[row] : ends[row + 1]]
                    many = counts[own]
                    firsts = np.repeat(heads[own] - np.cumsum(many) + many, many)
                    listed = owners[firsts + np.arange(len(firsts))]
                    shared = np.bincount(listed, minlength=len(sets))[others]
                union = sizes[row] + sizes[others] - shared
                return others[100 * shared >= settings.percent * union]

            return alike

        return match

    return matcher


def _dealt(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    keys = [group, "first", "second"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def candidate_pairs(nodes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """Pairs (a, b) of nodes that connect all pairs with a common prefix and like signatures."""
    trees = forest(nodes, settings)
    sizes = trees.groupBy("region").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    members = trees.join(sizes, "region")
    rows = in_blocks(members, "region", ["tail", "node"], settings.region)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = (_values(batch.column(1), settings.values) & np.uint32(255)).astype(np.uint8)
            rows = [r.tobytes() for r in low]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary())], names=["node", "bits"]
            )

    short = nodes.select("node", "signature").mapInArrow(shorten, "node long, bits binary")
    dealt = _dealt(rows.join(short, "node"), "region", ["tail", "node"])
    link = _linking("region", _by_signature(settings))
    return dealt.mapInArrow(link, "a long, b long").distinct()


def exact_pairs(docs: DataFrame, clusters: DataFrame, settings: NearDuplicates) -> DataFrame:
    """Pairs (a, b) of nodes that connect all truly similar pairs inside the clusters."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    members = clusters.join(sizes, "component").select("component", "node", "size")
    placed = cut_lineage(in_blocks(members, "component", ["node"], settings.cluster))
    wanted = placed.groupBy("node").agg(
        F.collect_list(F.struct("component", "first", "second", "block")).alias("places")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sets = [
                text_shingles(t, settings.shingle).tobytes()
                for t in as_bytes(batch.column(names.index("text")))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(names.index("node")),
                    batch.column(names.index("places")),
                    pa.array(sets, pa.binary()),
                ],
                names=["node", "places", "shingles"],
            )

    place = "array<struct<component:bigint,first:int,second:int,block:int>>"
    sets = texts.mapInArrow(cut, f"node long, places {place}, shingles binary")
    rows = sets.select("node", "shingles", F.explode("places").alias("place")).select(
        "place.*", "node", "shingles"
    )
    link = _linking("component", _by_set(settings))
    return _dealt(rows, "component", ["node"]).mapInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: NearDuplicates = NearDuplicates()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    1. Every text becomes the set of its distinct shingles; equal sets are one node, named by the
       smallest doc_id, so groups of copies of any size shrink before anything is compared.
    2. The forest's regions (common prefixes) are compared by signature, deeper prefixes side by
       side; large regions in blocks. Only pairs that connect go on, not all pairs of a group.
    3. What is so connected forms clusters, in which full sets are compared; pairs of the asked
       similarity connect the components of the result.

    Null and empty texts have no shingles and stand alone. Rows of one doc_id are one document and
    are linked. A row without doc_id links nothing, has its set's component, if any, and is kept.
    Equal documents tie towards the smallest doc_id. Other columns are not read; an empty table
    gives no rows.
    """
    facts = cut_lineage(set_facts(docs, settings))
    nodes = cut_lineage(
        facts.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"))
    )
    clusters = components(candidate_pairs(nodes, settings))
    links = components(exact_pairs(docs, clusters, settings))
    named = nodes.select("hi", "lo", "node").join(links, "node", "left")
    named = named.select("hi", "lo", F.coalesce("component", "node").alias("component_id"))
    rows = facts.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    return rows.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.coalesce("component_id", "doc_id") == F.col("doc_id"))).alias(
            "kept"
        ),
    )

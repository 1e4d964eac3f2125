"""Damage to conversations, and their repair by the cheapest audit."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mergelens.llm.audits import EMPTY, KEPT, NEXT, NOTHING, best, extended, transfer

SPACE = " \t\n\x0b\x0c\r"
#: Rows of a conversation that are audited at a time; longer ones are put together from segments.
SEGMENT = 5_000
BATCH_ROWS = 2_000
ROLES = ("", "system", "user", "assistant")

_STATE = "blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long"
_SEGMENT = f"part int, seq long, {_STATE}, costs array<long>, scripts array<string>"
_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the rows after damage; nulls but those of ids and turns are one space.

    crc32(conv_id:turn) % 20 decides: 0 drops the row, 1 empties its text, 2 removes [.!?] from it,
    3 repeats the row, 4 makes its role user. In the key a null is one space as well.
    """
    fate = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = _spaced("text")
    return (
        df.select("conv_id", "turn", _spaced("role").alias("role"), text.alias("text"), fate.alias("fate"))
        .where(F.col("fate") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, F.lit(""))
            .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def _plain(df: DataFrame) -> DataFrame:
    """The four columns, with a digest of the text that stands for it in keys and orders."""
    text = _spaced("text")
    return df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _spaced("role").alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def _features(rows: DataFrame) -> DataFrame:
    """A row for each (conv_id, turn, role, text) with its number of copies and its first fault."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    same = (
        rows.select(
            "conv_id",
            "turn",
            "role",
            "digest",
            (end == "").alias("is_blank"),
            (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
        )
        .groupBy("conv_id", "role", "digest", "turn")
        .agg(F.max("is_blank").alias("is_blank"), F.max("is_cut").alias("is_cut"), F.count(F.lit(1)).alias("times"))
    )
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = (
        same.groupBy("conv_id", "role", "digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where(F.col("turns") > 1)
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    )
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    repeated = F.coalesce(F.col("first") < order, F.lit(False))
    return same.join(first, met, "left").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "is_blank", repeated.alias("is_repeat"), "is_cut", "times"
    )


def _in_order(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


class _Segment:
    """Rows of one conversation in order, with what their audit and its figures need."""

    def __init__(self, conv: object, part: int, seq: int, whole: bool):
        self.conv, self.part, self.seq, self.whole = conv, part, seq, whole
        self.rows: list[tuple[str, bool, bool, int]] = []
        self.size = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None

    def add(self, turn: int | None, role: str, blank: bool, repeat: bool, cut: bool, times: int) -> None:
        initial = role[:1]
        if blank:
            self.blank += times
        else:
            self.duplicate += times - (not repeat)
            self.truncated += cut and not repeat
        self.illegal += times - 1 + (self.tail is not None and not _legal(self.tail, initial))
        self.head = initial if self.head is None else self.head
        self.tail = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.rows.append((initial, blank or repeat, cut, times))
        self.size += 1

    def result(self) -> tuple:
        """The segment's row; transfers of other starts than NOTHING only if rows stand before it."""
        starts = [NOTHING] if self.whole else range(4)
        found = [transfer(self.rows, start) for start in starts]
        flat = [step for row in found for step in row] + [None] * (16 - 4 * len(found))
        figures = (self.blank, self.duplicate, self.truncated, self.illegal, self.head, self.tail, self.low, self.high, self.turns)
        costs, scripts = ([None if s is None else s[i] for s in flat] for i in (0, 1))
        return (self.conv, self.part, self.seq, *figures, costs, scripts)


def _legal(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, in small steps."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 1 + sum(len(x) for x in row if isinstance(x, str | bytes)) // 1_000
        if size >= BATCH_ROWS:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _schema(df: DataFrame, rest: str) -> StructType:
    return StructType([df.schema["conv_id"], *StructType.fromDDL(rest).fields])


def _segments(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Segments of every conversation, in ranges of (conversation, order); one at least for each id."""
    none = every.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), *(F.lit(False).alias(c) for c in ("is_blank", "is_repeat", "is_cut")),
        F.lit(0).cast("long").alias("times"),
    )
    order = _in_order("conv_id", "kind", "turn", "role", "digest")
    placed = (
        _features(rows)
        .unionByName(none.distinct())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", F.spark_partition_id().alias("part"), "kind", "turn", "role", "is_blank", "is_repeat", "is_cut", "times")
    )
    schema = _schema(every, _SEGMENT)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            held: _Segment | None = None
            for conv, part, kind, *row in _values(batches):
                if held is None or kind == 0 or conv != held.conv or held.size >= SEGMENT:
                    same = held is not None and kind and conv == held.conv
                    if held is not None:
                        yield held.result()
                    held = _Segment(conv, part, held.seq + 1 if same else 0, kind == 0)
                if kind:
                    held.add(*row)
            if held is not None:
                yield held.result()

        yield from _sent(segments(), arrow)

    return placed.mapInArrow(run, schema)


class _Audit:
    """Puts a conversation's segments together, then replays the audit on its rows in order."""

    def __init__(self, conv: object):
        self.conv = conv
        self.labels = [(0, EMPTY), None, None, None]
        self.sums = [0, 0, 0, 0]
        self.tail = self.low = self.high = None
        self.turns = self.place = 0
        self.state = NOTHING
        self.audit: str | None = None

    def add(self, figures: list, costs: list, scripts: list) -> None:
        *sums, head, tail, low, high, turns = figures
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        if head is not None:
            self.sums[3] += self.tail is not None and not _legal(self.tail, head)
            self.tail = tail
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        steps = [None if c is None else (c, s) for c, s in zip(costs, scripts, strict=True)]
        self.labels = extended(self.labels, [steps[i : i + 4] for i in range(0, 16, 4)])

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = best(self.labels)

    def _inserts(self) -> Iterator[tuple[bytes, bytes]]:
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            self.state = NEXT[self.state]
            yield ROLES[self.state].encode(), b""

    def replay(self, role: bytes, text: bytes) -> Iterator[tuple[bytes, bytes]]:
        """The repaired rows up to and with this one."""
        self.settle()
        yield from self._inserts()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "K":
            self.state = KEPT[role[:1].decode()]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ROLES[self.state].encode(), text

    def rest(self) -> Iterator[tuple[bytes, bytes]]:
        self.settle()
        yield from self._inserts()

    def figures(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.sums, self.cost, self.audit)


def _audited(df: DataFrame, every: DataFrame | None) -> DataFrame:
    """Segments, then rows, of each conversation in order; all of one conversation in one task."""
    rows = _plain(df)
    segments = _segments(rows, df.select("conv_id") if every is None else every.select("conv_id"))
    texts = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", F.col("text").cast("binary").alias("text")
    )
    both = segments.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    order = _in_order("conv_id", "kind", "part", "seq", "turn", "role", "digest")
    return both.repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "kind", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "turns",
        "costs", "scripts", F.col("role").cast("binary").alias("role"), "text",
    )


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Audit, bytes | None, bytes | None]]:
    """(audit, role, text) of each repaired row, and (audit, None, None) at the end of a conversation."""
    held: _Audit | None = None
    for conv, kind, *values in _values(batches):
        if held is None or conv != held.conv:
            if held is not None:
                yield from ((held, *row) for row in held.rest())
                yield held, None, None
            held = _Audit(conv)
        if kind == 0:
            held.add(values[:9], values[9], values[10])
        else:
            yield from ((held, *row) for row in held.replay(values[11], values[12]))
    if held is not None:
        yield from ((held, *row) for row in held.rest())
        yield held, None, None


def audits(df: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """A row for each conversation: gaps, faults, illegal neighbours, cost and audit, repaired_sha256.

    Rows stand in the order of turn (nulls first), then role, then the text's SHA-256. A row's first
    fault counts: blank (white space only), duplicate (role and text seen earlier), truncated (no
    [.!?] at the end). Edits: keep 0, change of role to user or assistant 2, delete 3, which blank
    and duplicate rows need, insert 2; a truncated row that stays adds 1. The cheapest edits that
    leave ``(system)? (user assistant)+`` or nothing are taken, the ASCII-least of equal ones.
    ``every`` gives ids that get a row even without rows. Null roles and texts are one space, a null
    conv_id is one conversation; empty and very long texts are read as they are. Rows that repeat
    are duplicates. An empty table gives no rows. Columns of other names are not read.

    Rows without their texts are audited in ranges of (conversation, order), in segments of SEGMENT
    rows that know the cheapest way from each state to each other, so a long conversation is spread
    over tasks. Texts move once, to the task that hashes their conversation; the hash needs them one
    after another, so that task reads them as a stream and holds only the audit.
    """
    schema = _schema(df, f"{_FIGURES}, repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            hashed, begun = sha256(), False
            for audit, role, text in _replayed(batches):
                if role is None:
                    yield (audit.conv, *audit.figures(), hashed.hexdigest())
                    hashed, begun = sha256(), False
                    continue
                hashed.update(b"\n" * begun + role + b":")
                hashed.update(text)
                begun = True

        yield from _sent(results(), arrow)

    return _audited(df, every).mapInArrow(run, schema)


def repaired(df: DataFrame) -> DataFrame:
    """conv_id, place, role and text of the repaired conversations; places count from 0. See ``audits``."""
    schema = _schema(df, "place long, role string, text string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            place = 0
            for audit, role, text in _replayed(batches):
                if role is None:
                    place = 0
                    continue
                yield audit.conv, place, role.decode(), text.decode()
                place += 1

        yield from _sent(results(), arrow)

    return _audited(df, None).mapInArrow(run, schema)

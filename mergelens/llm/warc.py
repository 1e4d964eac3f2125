"""WARC archives: one gzip member for each record, equal payloads written once, and a sequential reader.

Archives are written through Spark's text writer, so that they are committed with their tasks and may
lie in any store. They are read in splits: the gzip magic serves as the line separator, so a file of any
length is dealt over tasks and no task holds more than a record.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelens.session import cut_lineage

MAGIC = b"\x1f\x8b\x08"
#: Bytes that are decompressed, and bytes of finished rows that are handed on, at a time.
STEP = 1 << 20
BATCH = 8 << 20
#: Bytes a record's header lines may take.
HEADER = 1 << 20
#: Repeated payloads (or referred records) up to which the list is broadcast; about 100 bytes each.
BROADCAST_ROWS = 200_000
#: Fixed values of WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Warc:
    """Payloads from ``least_bytes`` on are written once; ``date`` stands in every record."""

    least_bytes: int = 100
    level: int = 6
    date: str = "1970-01-01T00:00:00Z"


# Writing


def record_name(key: object, digest: str) -> str:
    """The id of a page's record; rows of one key and payload share it."""
    return f"urn:page:{quote(str(key), safe='')}:{digest}" if key is not None else f"urn:page-none:{digest}"


def _field(text: str) -> bytes:
    """A header value without white space and control signs, which would end it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text).encode()


def member(lines: list[tuple[str, bytes]], block: list[bytes], level: int) -> bytes:
    """One record as a gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = [b"WARC/1.1\r\n", *(name.encode() + b": " + value + b"\r\n" for name, value in lines)]
    head += [b"Content-Length: %d\r\n\r\n" % sum(map(len, block)), *block, b"\r\n\r\n"]
    return b"".join([*map(packer.compress, head), packer.flush()])


def page_record(key: object, url: str | None, payload: bytes, digest: str, first: object, settings: Warc) -> bytes:
    """A response with the payload, or a revisit of the record of page ``first``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = [http] if first is not None else [http, payload]
    hashed = sha256()
    for part in block:
        hashed.update(part)
    lines = [
        ("WARC-Type", b"response" if first is None else b"revisit"),
        ("WARC-Record-ID", f"<{record_name(key, digest)}>".encode()),
        ("WARC-Date", settings.date.encode()),
        *([("WARC-Target-URI", _field(url))] if url is not None else []),
        ("Content-Type", b"application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha256:{hashed.hexdigest()}".encode()),
        ("WARC-Payload-Digest", f"sha256:{digest}".encode()),
    ]
    if first is not None:
        lines += [("WARC-Profile", PROFILE.encode()), ("WARC-Refers-To", f"<{record_name(first, digest)}>".encode())]
    return member(lines, block, settings.level)


def _info(settings: Warc) -> bytes:
    lines = [
        ("WARC-Type", b"warcinfo"),
        ("WARC-Record-ID", b"<urn:archive:info>"),
        ("WARC-Date", settings.date.encode()),
        ("Content-Type", b"application/warc-fields"),
    ]
    return member(lines, [b"format: WARC File Format 1.1\r\n"], settings.level)


def _lines_of(members: Iterator[bytes], last: bytes) -> Iterator[bytes]:
    """Members as lines that a NUL ends: the last byte of a member whose record is below 16 MiB is one.

    A longer member stays before the next one; ``last`` follows if there is none.
    """
    carried = b""
    for data in members:
        carried += data
        if carried.endswith(b"\0"):
            yield carried[:-1]
            carried = b""
    if carried:
        yield (carried + last)[:-1]


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches; ``size`` is the place of the value whose bytes count."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += 200 + len(row[size] or b"")
        if total >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _small(df: DataFrame) -> DataFrame:
    """``df``, with a broadcast hint if it has few rows; it must be written already."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", text: str = "html", settings: Warc = Warc()
) -> None:
    """A record for each row of ``pages`` below ``path``, which must not exist.

    The payload is the text in UTF-8, null counts as empty. Of equal payloads of ``least_bytes`` or
    more the rows of the smallest key are responses, all others revisit it; null keys come after all
    others, and if all are null each row is a response. Rows of one key and payload share a record
    id. A null url leaves the target out, white space in it is percent-encoded. Each task writes one
    file of gzip members, a warcinfo record first. An empty table writes none. Other columns are not
    read. Payloads are not moved to find equal ones: only digests are, added up in the tasks first.
    """
    payload = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("page"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    repeated = cut_lineage(
        rows.where(F.octet_length("payload") >= settings.least_bytes)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    chosen = rows.join(_small(repeated), "digest", "left").withColumn(
        "first", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    )
    schema = pa.schema([("line", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = _info(settings)

        def members() -> Iterator[bytes]:
            begun = False
            for batch in batches:
                columns = [batch.column(n) for n in ("page", "url", "payload", "digest", "first")]
                for i in range(batch.num_rows):
                    if not begun:
                        yield info
                        begun = True
                    yield page_record(*(c[i].as_py() for c in columns), settings)

        yield from _batched(((line,) for line in _lines_of(members(), info)), schema, 0)

    lines = chosen.select("page", "url", "payload", "digest", "first").mapInArrow(run, "line binary")
    lines.select(F.col("line").cast("string")).write.option("lineSep", "\0").text(path)


# Reading


class Frame:
    """Takes a member's bytes as they are decompressed; cuts records by their content length."""

    def __init__(self, payloads: bool):
        self.payloads = payloads
        self.records: list[dict] = []
        self._begin()

    def _begin(self) -> None:
        self.head, self.fields, self.left = bytearray(), None, 0

    def feed(self, data: bytes) -> None:
        view = memoryview(data)
        while len(view):
            if self.fields is None:
                view = self._header(view)
            elif self.left:
                part, view = view[: self.left], view[self.left :]
                self.left -= len(part)
                self._block(part)
            else:
                part, view = view[: 4 - len(self.tail)], view[4 - len(self.tail) :]
                self.tail += part
                if len(self.tail) == 4:
                    self._end()

    def _header(self, view: memoryview) -> memoryview:
        start = max(0, len(self.head) - 3)
        before = len(self.head)
        self.head += view
        end = self.head.find(b"\r\n\r\n", start)
        if end < 0:
            if len(self.head) > HEADER:
                raise ValueError("header")
            return view[len(view) :]
        lines = bytes(self.head[:end]).split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("header")
        pairs = (line.partition(b":") for line in lines[1:])
        self.fields = {n.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for n, _, v in pairs}
        length = self.fields.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", length):
            raise ValueError("header")
        self.left, self.tail = int(length), bytearray()
        self.block, self.payload = sha256(), sha256()
        self.http = bytearray() if self.fields.get("content-type", "").startswith("application/http") else None
        self.size, self.kept = 0, []
        return view[end + 4 - before :]

    def _block(self, part: memoryview) -> None:
        self.block.update(part)
        if self.http is not None:
            start = max(0, len(self.http) - 3)
            before = len(self.http)
            self.http += part
            end = self.http.find(b"\r\n\r\n", start)
            if end < 0:
                return
            part, self.http = part[end + 4 - before :], None
        self.payload.update(part)
        self.size += len(part)
        if self.payloads:
            self.kept.append(bytes(part))

    def _end(self) -> None:
        fields, kind = self.fields, self.fields.get("warc-type", "")
        digest = self.payload.hexdigest()
        said = fields.get("warc-payload-digest", "")
        wrong = self.tail != b"\r\n\r\n" and "frame"
        wrong = wrong or (_differs(fields.get("warc-block-digest", ""), self.block.hexdigest()) and "digest")
        wrong = wrong or (kind != "revisit" and _differs(said, digest) and "digest")
        whole = kind != "revisit"
        self.records.append(
            {
                "record_type": kind,
                "record_id": fields.get("warc-record-id", "").strip("<>"),
                "target_uri": fields.get("warc-target-uri"),
                "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                "payload_bytes": self.size if whole else None,
                "payload_digest": digest if whole else said.partition(":")[2],
                "fault": wrong or None,
                "payload": b"".join(self.kept) if self.payloads and whole else None,
            }
        )
        if wrong == "frame":
            raise ValueError("frame")
        self._begin()

    def finish(self) -> None:
        """The member has ended; so must its record."""
        if self.fields is not None or self.head:
            raise ValueError("frame")


def _differs(said: str, digest: str) -> bool:
    """Whether a header names another SHA-256; other kinds of digests are not compared."""
    name, _, value = said.partition(":")
    return name.lower() == "sha256" and value.lower() != digest


@dataclass
class Reader:
    """Reads pieces of one file in order; a piece begins where the gzip magic stands.

    The magic can also stand inside a member, so a member may go on over several pieces. If one
    cannot be decompressed its first piece is ``loose``, and those after it are tried again.
    """

    payloads: bool = False
    held: list[bytes] = field(default_factory=list)
    unpack: object = None
    frame: Frame | None = None

    def feed(self, piece: bytes) -> Iterator[tuple[str, object]]:
        """("record", …), ("damaged", reason) and ("loose", piece), as they come."""
        waiting = deque([piece])
        while waiting:
            data = waiting.popleft()
            if not self.held:
                self._start()
            self.held.append(data)
            try:
                yield from self._decode(data)
            except (zlib.error, ValueError) as wrong:
                records, pieces = self.frame.records, self.held
                self.held = []
                yield from (("record", r) for r in records)
                if not isinstance(wrong, ValueError):
                    yield ("damaged", "gzip") if records else ("loose", pieces[0])
                elif not records or records[-1]["fault"] != "frame":
                    yield "damaged", str(wrong)
                # What follows a failed member's first piece may be members of their own.
                waiting.extendleft(reversed(pieces[1:]))

    def _start(self) -> None:
        self.unpack, self.frame = zlib.decompressobj(31), Frame(self.payloads)

    def _decode(self, data: bytes) -> Iterator[tuple[str, object]]:
        while data:
            self.frame.feed(self.unpack.decompress(data, STEP))
            data = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.frame.finish()
                records, data = self.frame.records, self.unpack.unused_data.lstrip(b"\0")
                yield from (("record", r) for r in records)
                self.held = []
                if data:
                    self._start()
                    self.held = [data]

    def rest(self) -> bytes:
        """The bytes of a member that has not ended."""
        return b"".join(self.held)


RECORD = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("fault", pa.string()),
        ("payload", pa.binary()),
    ]
)
PARSED = pa.schema([*RECORD, ("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("piece", pa.binary())])
RECORD_DDL = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, "
    "payload_digest string, fault string, payload binary"
)
PARSED_DDL = f"{RECORD_DDL}, file string, block long, seq long, piece binary"


def _row(found: tuple[str, object]) -> tuple:
    kind, what = found
    if kind == "record":
        return tuple(what[name] for name in RECORD.names)
    return ("damaged", None, None, None, None, None, what if kind == "damaged" else "gzip", None)


def read_archives(spark: SparkSession, path: str, payloads: bool = False, whole_files: bool = False) -> DataFrame:
    """The records below ``path``: type, id, target, reference, payload size and digest, fault, payload.

    Sizes and digests are those of the bytes read; a revisit has none of its own, its digest is the
    stated one. ``fault`` is null for records whose framing and digests hold, "digest" if a stated
    SHA-256 differs, "frame" or "header" if the content length or the header lines do not fit, and
    "gzip" for a member that cannot be read. Reading goes on at the next member. warcinfo records are
    left out. Payloads are returned on request. A file is cut into splits at the gzip magic; a member
    that goes over the end of a split meets the pieces after it in one task, so only members that hold
    the magic themselves move. Archives whose payloads hold whole gzip members, stored and not deflated,
    are read with ``whole_files``, since a split inside such a payload would take them for records. Names ending in .gz make Spark decompress the file, so such archives
    are read with ``whole_files``, a file as one row. An empty folder gives no rows.
    """
    if whole_files:
        raw = spark.read.format("binaryFile").load(path)
        pieces = raw.select(F.col("path").alias("file"), F.lit(0).cast("long").alias("block"), F.col("content").alias("piece"))
    else:
        raw = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
        pieces = raw.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("piece"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at, reader, begun, seq = None, Reader(payloads), True, 0
            for batch in batches:
                columns = [batch.column(n) for n in ("file", "block", "piece")]
                for i in range(batch.num_rows):
                    file, block, piece = (c[i].as_py() for c in columns)
                    if (file, block) != at:
                        if reader.held:
                            yield (*[None] * len(RECORD), *at, seq, reader.rest())
                        at, reader, begun, seq = (file, block), Reader(payloads), False, 0
                        if block == 0 and not whole_files:
                            # What stands before the first magic.
                            begun = True
                            if piece:
                                yield (*_row(("loose", piece)), None, None, None, None)
                            continue
                        begun = block == 0
                    for found in reader.feed(piece if whole_files else MAGIC + piece):
                        seq += 1
                        if found[0] == "loose" and not begun:
                            yield (*[None] * len(RECORD), *at, seq, found[1])
                            continue
                        begun = True
                        yield (*_row(found), None, None, None, None)
            if reader.held:
                yield (*[None] * len(RECORD), *at, seq + 1, reader.rest())

        yield from _batched(rows(), PARSED, len(PARSED) - 1 if not payloads else RECORD.names.index("payload"))

    parsed = cut_lineage(pieces.mapInArrow(run, PARSED_DDL))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        reader, out = Reader(payloads), []
        for piece in group.sort_values(["block", "seq"])["piece"]:
            out += [_row(found) for found in reader.feed(bytes(piece))]
        if reader.held:
            out.append(_row(("damaged", "gzip")))
        return pd.DataFrame(out, columns=RECORD.names).astype({"payload_bytes": "Int64"})

    joined = parsed.where(F.col("piece").isNotNull()).groupBy("file").applyInPandas(join, RECORD_DDL)
    records = parsed.where(F.col("piece").isNull()).select(*RECORD.names).unionByName(joined)
    return records.where(F.col("record_type") != "warcinfo")


def page_of(record_id: Column) -> Column:
    """The key in a record's id as text; null if it was null."""
    return F.when(record_id.startswith("urn:page:"), F.url_decode(F.split_part(record_id, F.lit(":"), F.lit(3))))


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with the sizes of the records that revisits refer to, and ``verified``.

    A record is verified if it has no fault and, for a revisit, if the response it names was read
    with the stated digest; without that response its size stays null. Only the records referred to
    are looked up, and are broadcast up to BROADCAST_ROWS of them.
    """
    names = cut_lineage(records.where(F.col("refers_to").isNotNull()).select("refers_to").distinct())
    targets = cut_lineage(
        records.where((F.col("record_type") == "response") & F.col("fault").isNull())
        .join(_small(names.withColumnRenamed("refers_to", "record_id")), "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.min("payload_bytes").alias("_bytes"), F.min("payload_digest").alias("_digest"))
    )
    is_revisit = F.col("record_type") == "revisit"
    held = ~is_revisit | F.coalesce(F.col("_digest") == F.col("payload_digest"), F.lit(False))
    return (
        records.join(_small(targets), "refers_to", "left")
        .withColumn("payload_bytes", F.when(is_revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")))
        .withColumn("verified", F.col("fault").isNull() & held)
        .drop("_bytes", "_digest")
    )

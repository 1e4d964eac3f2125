from __future__ import annotations

import glob
import gzip
import os
import random
import zlib
from hashlib import sha256

import pytest

from mergelens.llm.warc import MAGIC, Frame, Reader, Warc, _lines_of, member, page_of, page_record, read_archives
from mergelens.llm.warc import resolved, write_archives

PAGES = "page_id long, url string, html string, digest string, first long, payload string, record_type int"


def archive(spark, tmp_path, rows, **settings):
    path = str(tmp_path / f"archive-{random.random()}")
    df = spark.createDataFrame([(*r, "a", 1, "b", 2) for r in rows], PAGES).repartition(3)
    write_archives(df, path, settings=Warc(**settings))
    return path


def found(spark, path, **options):
    from pyspark.sql import functions as F

    records = resolved(read_archives(spark, path, **options))
    columns = [page_of(F.col("record_id")).cast("long").alias("page"), "payload_bytes", "payload_digest", "record_type"]
    refers = page_of(F.col("refers_to")).cast("long").alias("refers")
    got = records.select(*columns, refers, "verified").collect()
    assert all(r.verified for r in got)
    return sorted((tuple(r)[:-1] for r in got), key=repr)


def brute(rows, least=100):
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        ids = [k for k, _, h in rows if (h or "").encode() == payload and k is not None]
        first = min(ids) if ids and len(payload) >= least else None
        revisit = first is not None and key != first
        kind = "revisit" if revisit else "response"
        out.append((key, len(payload), sha256(payload).hexdigest(), kind, first if revisit else None))
    return sorted(out, key=repr)


def odd_pages():
    draw = random.Random(5)
    noise = "".join(chr(draw.randrange(32, 0x2FFF)) for _ in range(30_000))
    return [
        (5, "http://a.org/x y\r\nWARC-Type: z", "<p>" + "word " * 40),
        (2, None, "<p>" + "word " * 40),
        (9, "", "<p>" + "word " * 40),
        (9, "http://a", "<p>" + "word " * 40),
        (2, None, "<p>" + "word " * 40),
        (None, "u", "<p>" + "word " * 40),
        (None, "u", "n" * 150),
        (None, "u", "n" * 150),
        (11, "u", "e" * 99),
        (12, "u", "e" * 99),
        (13, "u", "é" * 50),
        (14, "u", "é" * 50),
        (20, "u", None),
        (21, "u", ""),
        (22, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\0\x01" * 9),
        (23, "u", noise),
        (24, "u", noise * 3),
        *((100 + i, "u", f"page {i % 7} " * 30) for i in range(200)),
    ]


def test_round_trip_equals_brute_force(spark, tmp_path):
    rows = odd_pages()
    path = archive(spark, tmp_path, rows)
    assert found(spark, path) == brute(rows)
    # Other readers: every file is a row of gzip members, a record each.
    members = 0
    for name in glob.glob(f"{path}/part-*"):
        data = open(name, "rb").read()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        while data:
            unpack = zlib.decompressobj(31)
            record, data = unpack.decompress(data), unpack.unused_data
            assert record.endswith(b"\r\n\r\n") and unpack.eof
            members += b"WARC-Type: warcinfo" not in record
    assert members == len(rows)


@pytest.mark.parametrize("split", [700, 5_000])
def test_any_split_gives_the_same(spark, tmp_path, split):
    """Payloads full of the magic, stored without compression, so that pieces and splits cut members."""
    draw = random.Random(split)
    magic = MAGIC.decode("latin-1")
    rows = [(i, "u", "".join(draw.choice([magic[0], "\x08", "b", str(i)]) for _ in range(draw.randrange(2_000)))) for i in range(60)]
    path = str(tmp_path / "magic")
    folder = tmp_path / "magic"
    folder.mkdir()
    expected = []
    for part in range(3):
        members = []
        for i in range(20):
            payload = b"".join(draw.choice([MAGIC, MAGIC + b"\0", b"xy", bytes([i])]) for _ in range(draw.randrange(900)))
            digest = sha256(payload).hexdigest()
            members.append(page_record(20 * part + i, "u", payload, digest, None, Warc(level=draw.choice([0, 0, 6]))))
            expected.append((20 * part + i, len(payload), digest, "response", None))
        (folder / f"part-{part}").write_bytes(b"".join(members))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert found(spark, path) == sorted(expected, key=repr)
        other = archive(spark, tmp_path, rows)
        assert found(spark, other) == brute(rows)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found(spark, path, whole_files=True) == sorted(expected, key=repr)


def test_damage_is_reported_and_reading_goes_on(spark, tmp_path):
    records = [page_record(i, "u", b"payload %d" % i * 30, sha256(b"payload %d" % i * 30).hexdigest(), None, Warc()) for i in range(8)]
    lines = [("WARC-Type", b"response"), ("WARC-Record-ID", b"<urn:page:50:x>"), ("WARC-Payload-Digest", b"sha256:00")]
    wrong = member(lines, [b"other"], 6)
    short = zlib.compressobj(6, zlib.DEFLATED, 31)
    short = short.compress(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nabc\r\n\r\n") + short.flush()
    flipped = bytearray(records[3])
    flipped[len(flipped) // 2] ^= 255
    folder = tmp_path / "damaged"
    folder.mkdir()
    stream = [records[0], wrong, records[1], records[2][:40], bytes(flipped), records[4], b"junk", records[5], short, records[6]]
    (folder / "part-0").write_bytes(b"".join(stream))
    (folder / "part-1").write_bytes(b"no archive at all")
    (folder / "part-2").write_bytes(records[7][:-9])
    got = read_archives(spark, str(folder)).collect()
    good = sorted(int(r.record_id.split(":")[2]) for r in got if r.fault is None)
    assert good == [0, 1, 4, 5, 6]
    assert sorted(r.fault for r in got if r.fault) == ["digest", "frame"] + ["gzip"] * (len(got) - 7)
    assert sum(r.fault == "gzip" for r in got) >= 4


def test_missing_response_is_not_verified(spark, tmp_path):
    folder = tmp_path / "alone"
    folder.mkdir()
    (folder / "part-0").write_bytes(page_record(7, None, b"x" * 200, sha256(b"x" * 200).hexdigest(), 3, Warc()))
    row = resolved(read_archives(spark, str(folder))).first()
    assert (row.record_type, row.payload_bytes, row.verified) == ("revisit", None, False)


def test_payloads_come_back(spark, tmp_path):
    rows = odd_pages()[:20]
    path = archive(spark, tmp_path, rows, least_bytes=10**9)
    got = sorted(bytes(r.payload) for r in read_archives(spark, path, payloads=True).collect())
    assert got == sorted((h or "").encode() for _, _, h in rows)


def test_no_rows(spark, tmp_path):
    assert found(spark, archive(spark, tmp_path, [])) == []


def test_lines_end_in_nul_at_any_record_length():
    last = member([], [b"end"], 6)
    members = [member([], [b"x" * n], 0) for n in (5, (1 << 24) + 5, 9, (1 << 24) + 1)]
    lines = list(_lines_of(iter(members), last))
    assert b"".join(line + b"\0" for line in lines) == b"".join(members) + last


def test_frame_takes_any_cut():
    data = gzip.decompress(page_record(1, "u", b"a\r\n\r\nb" * 20, "d" * 64, None, Warc()))
    data = data.replace(b"d" * 64, sha256(b"a\r\n\r\nb" * 20).hexdigest().encode())
    for size in (1, 2, 3, 7, 1_000):
        frame = Frame(True)
        for i in range(0, 2 * len(data), size):
            frame.feed((data + data)[i : i + size])
        frame.finish()
        assert [(r["payload"], r["fault"]) for r in frame.records] == [(b"a\r\n\r\nb" * 20, None)] * 2


def test_reader_keeps_no_more_than_a_record(spark):
    reader = Reader()
    record = page_record(1, "u", os.urandom(50_000), "d" * 64, None, Warc())
    for _ in range(5):
        assert [kind for kind, _ in reader.feed(record)] == ["record"]
        assert reader.rest() == b""

from __future__ import annotations

import zlib

import numpy as np

from mergelens.llm.shards import deal, jump
from tests.llm.fixtures import documents, odd_texts


def published(key: int, buckets: int) -> int:
    """The loop of the paper, one key at a time."""
    shard, ahead = -1, 0
    while ahead < buckets:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


def test_jump_equals_the_paper_and_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 62, 5000)
    for buckets in (1, 2, 40, 41):
        assert jump(keys, buckets).tolist() == [published(int(k), buckets) for k in keys]
    old, new = jump(keys, 40), jump(keys, 41)
    assert set(new[old != new].tolist()) == {40}
    assert 0.01 < (old != new).mean() < 0.04


def test_whole_table(spark):
    texts = odd_texts() * 30
    ids = [None, None, *range(len(texts) - 2)]
    got = deal(documents(spark, texts, ids, clashing=True), "doc_id", "text", 7).collect()
    assert len(got) == len(texts)
    expected = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r.text_crc32) for r in got) == expected
    for shard in range(7):
        rows = sorted((r.slot, r.doc_id if r.doc_id is not None else -1) for r in got if r.shard == shard)
        assert [s for s, _ in rows] == list(range(len(rows)))
        assert [i for _, i in rows] == sorted(i for _, i in rows)
    assert all(r.grown_shard in (r.shard, 7) for r in got)


def test_empty_and_one_row(spark):
    assert deal(documents(spark, []), "doc_id", "text", 7).count() == 0
    assert [r.slot for r in deal(documents(spark, ["a"]), "doc_id", "text", 7).collect()] == [0]

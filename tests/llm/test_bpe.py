from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mergelens.llm.bpe import SCAN, Coder, Signs, Vocabulary, encode_texts
from mergelens.llm.queries import vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.fixtures import documents, odd_texts

ODD = [
    "a<|endoftext|>b <|startoftext|>", "ΑΣΣ Σ ΟΔΟΣ", "İstanbul ﬁ Å", "x" * 300, "ab" * 400,
    "日本語テキスト 한국어", "it's we'll I'D THEY'RE don''t 's", "12345 ½ ²", "😀😀 é é", "\x00\x01 \x85",
]


@pytest.fixture(scope="module")
def coder():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return Coder(Vocabulary(file.read()))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))


def test_equals_the_library(spark, library):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += ODD + odd_texts()
    df = documents(spark, texts, clashing=True)
    got = {r.doc_id: r for r in encode_texts(df, vocabulary_path(), ["doc_id"], True, True).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        row = got[3 * i]
        assert (row.ids, row.n_tokens, row.decoded) == (ids, len(ids), decoded)
        assert row.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(decoded.encode()).hexdigest()


def _differing(coder, library, texts):
    found = coder.encode(texts)
    wanted = library.encode_batch(texts, add_special_tokens=False)
    return [
        text
        for text, pieces, right in zip(texts, found, wanted, strict=True)
        if [int(i) for piece in pieces for i in piece[0].split()] != right.ids
    ]


def test_every_sign_equals_the_library(coder, library):
    signs = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(signs), 4000):
        texts = [f"a{sign}b {sign}" for sign in signs[start : start + 4000]]
        assert _differing(coder, library, texts) == []


def test_runs_of_signs_that_tables_know_otherwise_equal_the_library(coder, library):
    draw = random.Random(7)
    odd = sorted(Signs.of_library().odd)
    plain = [chr(c) for c in [*range(0x3000), *range(0x300, 0x370), *range(0x1AB0, 0x1B00)]]
    for signs in (odd + plain, sorted(set(plain) - set(odd))):
        texts = ["".join(draw.choices(signs, k=draw.randrange(1, 12))) for _ in range(3000)]
        assert _differing(coder, library, texts) == []


def test_scan_and_heap_agree(coder):
    draw = random.Random(2)
    words = ["".join(draw.choices("aeinorst", k=draw.randrange(1, SCAN + 1))) for _ in range(300)]
    for word, ids in zip(words, coder.vocabulary.merge(words), strict=True):
        assert ids == coder.vocabulary._merge_long(word)


def test_round_trip(coder, library):
    for text in ("hello world, it's 42!", "", "Straße"):
        ids = [int(i) for f in coder.encode([text])[0] for i in f[0].split()]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert encode_texts(documents(spark, []), vocabulary_path(), ["doc_id"]).count() == 0

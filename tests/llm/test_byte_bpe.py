from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from vigilog.llm.byte_bpe import VOCABULARY, Decoder, decoded, encoded, encoder, round_trip

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_of_random_texts(reference):
    rnd, own = random.Random(3), encoder(PATH, public_tokenizers.PATTERN)
    letters = [*"abcdeetaoin  \n\t\r'sSéßñ漢字1²½Ⅷ\x1c\x85 　🎉_-.!<|", "'ll", "  "]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(5000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert Decoder(own.bpe).decode(ids) == text.encode() if len(text) < 5 else True


def test_ids_of_random_bytes(reference):
    rnd, bpe = random.Random(4), encoder(PATH, public_tokenizers.PATTERN).bpe
    for _ in range(3000):
        piece = bytes(rnd.choice(b"abcde \xc3\xa9\xff\x00") for _ in range(rnd.randint(1, 24)))
        assert bpe.encode(piece) == reference._encode_single_piece(piece)
    long = bytes(rnd.choice(b"aab") for _ in range(50_000))
    assert bpe.encode(long) == reference._encode_single_piece(long)


def test_tables_that_start_anew_change_nothing(reference, documents, monkeypatch):
    own = encoder(PATH, public_tokenizers.PATTERN)
    monkeypatch.setattr(own.words, "most", 10)
    monkeypatch.setattr("vigilog.llm.byte_bpe.MOST_PIECES", 5)
    for r in documents.limit(20).collect():
        assert own.encode([r.text])[0].tolist() == reference.encode_ordinary(r.text)


def test_digests(reference, documents, awkward):
    for docs in (documents, awkward):
        want = sorted(
            (str(r.doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
            for r in docs.collect()
            for ids in [reference.encode_ordinary(r.text or "")]
        )
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs).collect()) == want


def test_empty_table_and_null_ids(spark, empty):
    assert round_trip(empty).count() == 0 and encoded(empty).count() == 0
    rows = decoded(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).collect()
    assert {r.doc_id: r.decoded for r in rows} == {1: None, 2: b""}

from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vigilog.llm import token_files as tf
from vigilog.llm.rans import Table, scaled


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tf.VOCABULARY))
    tokenizer.encode_special_tokens = True
    return tokenizer


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60_000), min_size=1, max_size=5000))
def test_a_block_comes_back(ids):
    ids = np.array(ids)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    frequencies = scaled(counts[symbols])
    assert frequencies.min() >= 1 and frequencies.sum() == 1 << 20
    table = Table(symbols, frequencies)
    assert np.array_equal(table.decode(len(ids), *table.encode(ids)), ids)


def test_skewed_ids_take_few_bits():
    ids = np.where(np.random.default_rng(1).random(600_000) < 0.99, 7, 9)
    data = tf.file_bytes(ids, np.array([len(ids)]), np.array([1]), np.array([False]))
    assert len(data) < 0.2 * len(ids)


def test_blocks_are_independent_and_checked(monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 1000)
    ids = np.random.default_rng(2).integers(0, 50, 5500)
    data = tf.file_bytes(ids, np.array([10, 5490]), np.array([3, 4]), np.array([False, False]))
    file = tf.TokenFile(io.BytesIO(data))
    assert [file.block(i).tolist() for i in (5, 2)] == [ids[5000:].tolist(), ids[2000:3000].tolist()]
    assert [d.tolist() for d in file.documents()] == [ids[:10].tolist(), ids[10:].tolist()]
    damaged = bytearray(data)
    damaged[file.start + int(file.blocks[5][0]) + 2] ^= 8  # a high bit of the slot
    with pytest.raises(ValueError):
        tf.TokenFile(io.BytesIO(bytes(damaged))).block(5)
    with pytest.raises(ValueError):
        tf.TokenFile(io.BytesIO(data[:30] + b"x" + data[31:]))


def test_ids_of_words_are_those_of_the_text(reference):
    odd = ["don't they're Å H̱ İstanbul ΣΑΣ ﬁ x\u0301y", "a\x1cb\x85c d　e\x0bf", "<|endoftext|> ok<|startoftext|>", "…. ..… it's's ''ll 12a3 ½² Ⅷ", "漢字 かな 한글 🎉🎉! é́!"]
    own = tf.WordEncoder(public_tokenizers.path(tf.VOCABULARY))
    ids, sizes = own.encode([x.encode() for x in odd])
    for x, part in zip(odd, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == [*reference.encode(x, add_special_tokens=False).ids, tf.END_ID]


def test_digests(spark, reference, documents, awkward, monkeypatch):
    monkeypatch.setattr(tf, "FILE_BYTES", 40_000)
    for docs in (documents, awkward):
        start, want = 0, []
        for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
            ids = [*reference.encode(r.text or "", add_special_tokens=False).ids, tf.END_ID]
            want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        found = [tuple(r) for r in tf.token_digests(docs).collect()]
        assert sorted(found, key=lambda r: r[1]) == want


def test_empty_table(empty):
    assert tf.token_digests(empty).count() == 0


LITERALS = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b c", "x\n<|startoftext|>y<|endoftext|> é<|endoftext|>\u0301 don't!", "<|ENDOFTEXT|> <|endoftext |>", "plain, words", "", "漢" * 300 + " end<|endoftext|>"]


def test_literals_of_added_tokens_are_those_tokens():
    """As the library does it, without a switch."""
    path = public_tokenizers.path(tf.VOCABULARY)
    library = Tokenizer.from_file(path)
    ids, sizes = tf.WordEncoder(path, added_tokens=True).encode([x.encode() for x in LITERALS] + [None])
    for x, part in zip([*LITERALS, ""], np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == [*library.encode(x, add_special_tokens=False).ids, tf.END_ID]


def test_digests_of_texts_with_literals(spark):
    library, start, want = Tokenizer.from_file(public_tokenizers.path(tf.VOCABULARY)), 0, []
    for i, text in enumerate(LITERALS):
        ids = [*library.encode(text, add_special_tokens=False).ids, tf.END_ID]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame([*enumerate(LITERALS)], "doc_id long, text string")
    assert sorted(tuple(r) for r in tf.token_digests(docs).collect()) == want

"""Byte-level BPE in linear time by backtracking over longest matches, and decoding.

Two adjacent tokens are compatible if merging by rank would leave both as they are. A sequence of tokens in which every
neighbour pair is compatible is the one that merging gives, so the encoder takes the longest token at a position,
shortens it until it is compatible with the last token and leads to a position not yet given up, and steps back where no
token is left. Every position is given up once at most. All matches of a piece come from one Aho-Corasick scan of its
bytes as Latin-1 characters; compatibility of a pair is remembered.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from vigilog.llm.token_tables import TokenTable, spans
from vigilog.llm.words import pieces

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MOST_PAIRS = 300_000
MOST_PIECES = 100_000


class ByteBpe:
    """The merges of a rank file: token bytes to rank, with all 256 single bytes among them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.size = max(self.bytes_of) + 1
        self.length = [len(self.bytes_of.get(i, b"")) for i in range(self.size)]
        self.found = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.found.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.found.make_automaton()
        self.shorter = [self._prefix(self.bytes_of.get(i, b"")) for i in range(self.size)]
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(self.size)]
        self.merges: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.bytes_of):
            self._split(rank)
        self.pairs.clear()

    def _prefix(self, token: bytes) -> int:
        """The longest token that is a proper prefix, or -1."""
        for n in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:n])) is not None:
                return rank
        return -1

    def _split(self, rank: int) -> None:
        """Finds the two tokens whose merge makes this one, by what lower ranks have already told."""
        token, left = self.bytes_of[rank], self.shorter[rank]
        while left >= 0:
            right = self.ranks.get(token[self.length[left] :])
            if right is not None and left < rank and right < rank and self._stays_apart(left, right):
                self.halves[rank], self.merges[left, right] = (left, right), rank
                return
            left = self.shorter[left]

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether merging by rank would never cross the border between two tokens.

        The merges that made the two are undone from the latest on. A merge across the border that ranks below the one
        undone last would have come before it.
        """
        below = self.size
        while True:
            across = self.merges.get((left, right))
            if across is not None and across < below:
                return False
            splits_left, splits_right = self.halves[left][0] != left, self.halves[right][0] != right
            if splits_left and (left > right or not splits_right):
                below, left = left, self.halves[left][1]
            elif splits_right:
                below, right = right + 1, self.halves[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """Remembers the answer; the memory starts anew at ``MOST_PAIRS``."""
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[left, right] = self._stays_apart(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """The ids that merging the piece by rank gives."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, length, shorter, pairs = len(piece), self.length, self.shorter, self.pairs
        longest = [-1] * (n + 1)
        for end, (back, rank) in self.found.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # a later end is a longer match
        ids: list[int] = []
        given_up = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not given_up[end]:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at, last, token = end, token, longest[end]
            else:  # step back and try what is shorter than the last token
                given_up[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
                last = ids[-1] if ids else -1
        return ids


class TextEncoder:
    """Ids of whole texts: pieces by the pattern, each piece on its own.

    A text without white space beside a space is cut at its spaces first: the pattern puts a space in front of the next
    letters, digits or marks and so never crosses such a cut. The ids of ``" " + word`` are remembered.
    """

    def __init__(self, path: str, pattern: str):
        ranks = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        self.bpe = ByteBpe({base64.b64decode(a): int(b) for a, b in ranks})
        self.pattern = regex.compile(pattern)
        self.beside = regex.compile(r"\s[ ]|[ ]\s")
        self.pieces: dict[str, list[int]] = {}
        self.words = TokenTable(lambda words: map(self._word, words))

    def _piece(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is None:
            found = self.bpe.encode(piece.encode())
            if len(piece) <= 40:
                if len(self.pieces) >= MOST_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found

    def _ids(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self._piece(piece)]

    def _word(self, word: str) -> list[int]:
        return self.bpe.encode(b" " + word.encode()) if word.isalpha() else self._ids(" " + word)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        heads, words, counts = [], [], []
        for text in texts:
            if text[:1] in " " or text[-1] == " " or self.beside.search(text):
                heads.append(self._ids(text))
                counts.append(0)
            else:
                first, *rest = text.split(" ")
                heads.append(self._ids(first))
                words += rest
                counts.append(len(rest))
        ids, sizes = self.words.tokens(words)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
        return [
            np.concatenate([np.array(head, dtype=np.int32), ids[a:b]])
            for head, a, b in zip(heads, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]


class Decoder:
    """Bytes of ids."""

    def __init__(self, bpe: ByteBpe):
        tokens = [bpe.bytes_of.get(i, b"") for i in range(bpe.size)]
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        return spans(self.data, self.starts[ids], self.sizes[ids])[0].tobytes()


@lru_cache(2)
def encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


@lru_cache(2)
def decoder(path: str, pattern: str) -> Decoder:
    return Decoder(encoder(path, pattern).bpe)


def _listed(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in ids])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))


def _encoding(path: str, pattern: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in pieces(batches, "text", most=1 << 21):
            ids = own.encode([x or "" for x in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id"), _listed(ids)], names=["doc_id", "ids"])

    return encode


def _texts_of(own: Decoder, ids: pa.Array) -> pa.Array:
    return pa.array([own.decode(np.asarray(x.values)) if x.is_valid else None for x in ids], pa.large_binary())


def _decoding(path: str, pattern: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = _texts_of(own, part.column("ids"))
                yield pa.record_batch([part.column("doc_id"), part.column("ids"), texts], names=["doc_id", "ids", "decoded"])

    return decode


def _both(path: str, pattern: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Encoding and decoding in one worker, so that a task has one of them."""

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoding(path, pattern)(_encoding(path, pattern)(batches))

    return both


def encoded(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs`` (doc_id, text; others are ignored).

    A null or empty text has no ids. Repeated rows and null doc_ids are encoded row by row. An empty table stays empty.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encoding(path, pattern), "doc_id long, ids array<int>"
    )


def decoded(ids: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the bytes of the ids; null ids give null."""
    path = path or public_tokenizers.path(VOCABULARY)
    return ids.select("doc_id", "ids").mapInArrow(_decoding(path, pattern), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the ids of every row, encoded and decoded again."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = rows.mapInArrow(_both(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN), "doc_id long, ids array<int>, decoded binary")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

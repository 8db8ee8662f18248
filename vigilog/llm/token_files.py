"""Token ids of documents in binary files coded by rANS, written and read back in parallel.

A file holds a range of documents in ascending order of doc_id:

    magic, bytes of the header, CRC-32 of the header
    header: a compressed NumPy archive
        symbols, frequencies    the table that all blocks of the file share
        doc_ids, no_id, sizes   the documents, those without an id, and their numbers of ids with the end id
        blocks                  a checkpoint for each block: offset, ids, words, CRC-32 of its ids
    blocks: final states (64 bit) and words (32 bit), little-endian

A block can be decoded by itself from its checkpoint and is checked against its checksum. Which files count is told by
the manifest, a table with a row for each file; what a lost attempt has left is not in it.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vigilog.llm.rans import LANES, Table, scaled
from vigilog.llm.shared import stored, work_folder
from vigilog.llm.token_tables import HashedTable
from vigilog.llm.words import SPACES, as_bytes, pieces, word_stretches

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 256 * LANES
FILE_BYTES = 10 << 20  # of text, on average
MOST_CORES = 50_000
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks without the apostrophe, which can begin a token with letters
MAGIC = b"vgl-rans"
_SPACES = [bytes([c]) for c in SPACES]
_GAP = re.compile(b"[" + SPACES + b"]")
MANIFEST = "part int, file string, n_docs long, n_ids long, bytes long"


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space: no token crosses it, so every word is encoded by itself.

    With ``added_tokens``, as the library does it, the literal of an added token (``<|endoftext|>``) is that token: words
    that hold one go to the tokenizer whole. Without, it is text like any other.

    Words are told apart by 64-bit hashes, and marks behind a letter count as a word of their own, which the tokenizer
    cuts off as well. Ids are below 2**16.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.literal = re.compile(b"|".join(map(re.escape, added)))
        self.added = added
        self.tokenizer.encode_special_tokens = not added_tokens
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words = HashedTable(self._words, most=1_000_000)
        self.cores: dict[str, list[int]] = {}

    def _letters(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts of letters alone, encoded as one text: each ends with the only token of it that closes a word."""
        ids = self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(parts) and ends[-1] == len(ids):
            ends = ends.tolist()
            return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _core(self, text: str) -> list[int]:
        ids = self.cores.get(text)
        if ids is None:
            if len(self.cores) >= MOST_CORES:
                self.cores.clear()
            ids = self.cores[text] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return ids

    def _word(self, text: str) -> list[int]:
        """Ids of a word, cut before the marks it ends with if they follow a letter, as the tokenizer cuts it."""
        core = text.rstrip(MARKS)
        if core and core[-1].isalpha() and len(core) < len(text):
            return self._core(core) + self._core(text[len(core) :])
        return self._core(text)

    def _words(self, words: list[bytes]) -> list[list[int]]:
        texts = [w.decode() for w in words]
        out: list = [None] * len(texts)
        letters = [i for i, t in enumerate(texts) if t.isalpha()]
        for at in range(0, len(letters), 4000):
            part = letters[at : at + 4000]
            for i, ids in zip(part, self._letters([texts[i] for i in part]), strict=True):
                out[i] = ids
        return [self._word(t) if ids is None else ids for t, ids in zip(texts, out, strict=True)]

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, each with the end id, and how many each has."""
        if not any(x and any(a in x for a in self.added) for x in texts):
            ids, counts = self._plain(texts)
        else:
            parts, whole, of = [], [], []  # stretches without a literal, and the words that hold one
            for i, x in enumerate(texts):
                at = 0
                while m := self.literal.search(x or b"", at):
                    start = max(at, 1 + max(x.rfind(c, at, m.start()) for c in _SPACES))
                    end = gap.start() if (gap := _GAP.search(x, m.end())) else len(x)
                    parts += [x[at:start], b""]
                    whole += [None, x[start:end]]
                    of += [i, i]
                    at = end
                parts.append((x or b"")[at:])
                whole.append(None)
                of.append(i)
            ids, sizes = self._plain(parts)
            found = np.split(ids, np.cumsum(sizes)[:-1])
            for k, word in enumerate(whole):
                if word is not None:
                    found[k] = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, dtype=ids.dtype)
            ids = np.concatenate(found)
            counts = np.bincount(of, [len(x) for x in found], len(texts)).astype(np.int64)
        return np.insert(ids, np.cumsum(counts), END_ID), counts + 1

    def _plain(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        counts, found = np.zeros(len(texts), dtype=np.int64), []
        for first, data, hashes, starts, ends, bounds in word_stretches(texts, exact=True):
            ids, sizes = self.words.tokens(hashes, lambda i, d=data, a=starts, b=ends: d[a[i] : b[i]].tobytes())
            counts[first : first + len(bounds) - 1] += np.diff(np.concatenate([[0], np.cumsum(sizes)])[bounds])
            found.append(ids)
        return np.concatenate(found) if found else np.empty(0, np.uint16), counts


@lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path, added_tokens=True)


def file_bytes(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, no_id: np.ndarray) -> bytes:
    """A file of documents in the format above."""
    counts = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    symbols = np.flatnonzero(counts)
    table = Table(symbols, scaled(counts[symbols])) if len(symbols) else None
    blocks, data, at = [], [], 0
    for first in range(0, len(ids), BLOCK_IDS):
        block = ids[first : first + BLOCK_IDS]
        states, words = table.encode(block)
        blocks.append((at, len(block), len(words), zlib.crc32(block.astype("<u4").tobytes())))
        data += [states.astype("<u8").tobytes(), words.astype("<u4").tobytes()]
        at += 8 * LANES + 4 * len(words)
    header = io.BytesIO()
    np.savez_compressed(
        header,
        symbols=symbols,
        frequencies=table.frequencies if table else symbols,
        doc_ids=doc_ids,
        no_id=no_id,
        sizes=sizes,
        blocks=np.array(blocks, dtype=np.int64).reshape(-1, 4),
    )
    head = header.getvalue()
    return b"".join([MAGIC, struct.pack("<QI", len(head), zlib.crc32(head)), head, *data])


class TokenFile:
    """A file of the format; blocks are read and decoded one by one."""

    def __init__(self, file):
        self.file = file
        file.seek(0)
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        size, check = struct.unpack("<QI", file.read(12))
        head = file.read(size)
        if zlib.crc32(head) != check:
            raise ValueError("the header is damaged")
        parts = np.load(io.BytesIO(head))
        self.doc_ids, self.no_id, self.sizes, self.blocks = (parts[k] for k in ("doc_ids", "no_id", "sizes", "blocks"))
        self.start = len(MAGIC) + 12 + size
        self.table = Table(parts["symbols"], parts["frequencies"]) if len(parts["symbols"]) else None

    def block(self, i: int) -> np.ndarray:
        offset, n, n_words, check = (int(x) for x in self.blocks[i])
        self.file.seek(self.start + offset)
        states = np.frombuffer(self.file.read(8 * LANES), dtype="<u8")
        words = np.frombuffer(self.file.read(4 * n_words), dtype="<u4")
        ids = self.table.decode(n, states, words).astype("<u4")
        if zlib.crc32(ids.tobytes()) != check:
            raise ValueError(f"block {i} is damaged")
        return ids

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document in order; at most one document and one block are held."""
        held, block = np.empty(0, "<u4"), 0
        for size in self.sizes.tolist():
            parts, n = [held], len(held)
            while n < size:
                parts.append(self.block(block))
                n, block = n + len(parts[-1]), block + 1
            ids = np.concatenate(parts)
            held = ids[size:]
            yield ids[:size]


def write_files(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Writes the ids of every row of ``docs`` (doc_id, text) below ``folder`` and returns the manifest.

    Files follow each other in ascending doc_id, rows without an id first, rows with one id by text. A null or empty text
    has the end id alone. A partition is one file of about ``FILE_BYTES`` of text; the task holds its ids (2 bytes per byte of text at most).
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found, sizes, doc_ids = _encoder(path), [], [], []
        for batch in pieces(batches, "text", most=1 << 21):
            ids, counts = own.encode(as_bytes(batch.column("text")))
            found.append(ids)
            sizes.append(counts)
            doc_ids += batch.column("doc_id").to_pylist()
        if not doc_ids:
            return
        ids = np.concatenate(found)
        data = file_bytes(ids, np.concatenate(sizes), np.array([x or 0 for x in doc_ids]), np.array([x is None for x in doc_ids]))
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.rans"
        store, place = fs.FileSystem.from_uri(folder)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{name}") as out:
            out.write(data)
        yield pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([name]), *(pa.array([x], pa.int64()) for x in (len(doc_ids), len(ids), len(data)))],
            names=["part", "file", "n_docs", "n_ids", "bytes"],
        )

    ordered = rows.repartitionByRange(1 + int(size // FILE_BYTES), "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, MANIFEST), folder, "manifest")


def read_files(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, unless left out, ``ids`` of every document in the files.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the CRC-32 of the ids as unsigned 32-bit integers. A
    task reads a file at a time and holds a document, a block and a batch of a million ids.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            ends = np.cumsum([0] + [r[2] for r in rows]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[4] for r in rows]).astype(np.int32))))
            names.append("ids")
        return pa.record_batch(columns, names=names)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                rows, n = [], 0
                with store.open_input_file(f"{place}/{name}") as file:
                    own = TokenFile(file)
                    for i, ids in enumerate(own.documents()):
                        doc_id = None if own.no_id[i] else int(own.doc_ids[i])
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), *([ids] if with_ids else [])))
                        start, n = start + len(ids), n + len(ids)
                        if n > 1 << 20:
                            yield batch_of(rows)
                            rows, n = [], 0
                if rows:
                    yield batch_of(rows)

    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("part", "file", F.coalesce(before, F.lit(0)).alias("before"))
    files = files.repartition(max(1, manifest.count()), "part").select("file", "before")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def token_digests(docs: DataFrame) -> DataFrame:
    """Writes the ids of all rows to files, reads them back and returns each document's place, size and checksum.

    An empty table gives no file and no rows. Other columns are ignored.
    """
    folder = work_folder(docs.sparkSession, "token-files")
    return read_files(write_files(docs, folder), folder, with_ids=False)

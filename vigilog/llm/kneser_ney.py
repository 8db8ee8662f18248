"""An interpolated modified Kneser-Ney model of any order from 2, counted in Spark and stored as sorted hash arrays.

Counting is rounds of the same kind: a task hashes its texts, sums equal keys, and hands each shard its sorted keys
as one binary row; the task that gets a shard merges them and writes arrays sorted by key. A shard is given by the top
bits of the key, so a reader knows the file of a key without any list of files. Keys are 64-bit hashes.

* words: word hash -> count
* grams of each order: hash of (context, word) -> count (highest order) or number of different words before (lower ones),
  beside contexts: context hash -> total and numbers of words seen once, twice, more; a context that was followed once is
  not written, since the gram of the order below that is its words tells that it was seen
* continuations: word hash -> number of different contexts

Grams of every order are sharded by the last word of their context, so a shard knows the whole of a context and all words
before a gram: the lower orders are counted where the highest one is merged. A last word with more than 1 in ``HOT`` of
all tokens is spread over all shards by the word that follows; the sums of its contexts are dealt once more, by context.
The shards are counted in ``PARTS`` runs over the texts, and the shuffle of a run is let go before the next one.
A shard's file holds keys in 5 or 6 bytes, those counted once without a value and the values of the others in a byte each.
Workers map it into memory and look up the sorted keys of a slice of texts at once. Before a text stand as many
begin tokens as a context has words; a gram that begins with one of them counts, like all others, once for each
different token before it, so at the lower orders once, however many texts begin with it.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import md5
from itertools import pairwise
from mmap import ACCESS_READ, mmap

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from vigilog.llm.shared import release, stored, work_folder
from vigilog.llm.words import as_bytes, mixed, pieces, word_runs

SHARD_BYTES = 16 << 20  # of training text for each shard, on average
HELD_TOKENS = 2_000_000  # counted at once by a task
SLICE = 1 << 20  # of them hashed at once
SCORED_BYTES = 1 << 22  # of text scored at once
LOOKED_UP = 1 << 15  # keys looked up at once, of one shard or several
PARTS = 2  # runs over the texts that count the grams, a power of 2
HOT = 1000
END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
_MAPPED = {"trackfd": False} if sys.version_info >= (3, 13) else {}
_PAIR = np.uint64(0x9E3779B97F4A7C15)

_COUNTED = "shard int, blob binary"
_MERGED = "kind string, shard int, blob binary, total long, n0 long, n1 long, n2 long, n3 long, n4 long"

Array = np.ndarray


def held_out(doc_id: Column) -> Column:
    """True for the rows nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(True))


def token_runs(texts: list[bytes | None]) -> Iterator[tuple[int, Array, Array]]:
    """Runs of texts as (first text, token hashes, bounds): the words of each text and then the end."""
    for first, hashes, bounds in word_runs(texts):
        yield first, np.insert(hashes, bounds[1:], END), bounds + np.arange(len(bounds))


def contexts_of(tokens: Array, starts: Array, order: int, begin: int = BEGIN) -> list[Array]:
    """The ``order`` - 1 tokens before each token, the nearest first; ``starts`` are the places where texts start."""
    out = [tokens]
    for _ in range(order - 1):
        before = np.empty_like(tokens)
        before[1:] = out[-1][:-1]
        before[starts] = begin
        out.append(before)
    return out[1:]


def summed(keys: Array, weights: Array | None = None) -> tuple[Array, Array, Array]:
    """Different keys in order, the sum of the weights of each (its count without), and a place where it stands."""
    order = np.argsort(keys)
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    sums = np.diff(np.append(firsts, len(keys))) if weights is None else np.add.reduceat(weights[order], firsts) if len(keys) else np.empty(0, np.int64)
    return keys[firsts], sums.astype(np.int64), order[firsts]


def coded(tokens: Array) -> tuple[Array, Array]:
    """Different tokens in order, and the place of each token among them: one pass over the tokens, only the different ones are sorted."""
    found = pa.array(tokens).dictionary_encode()
    words = found.dictionary.to_numpy()
    order = np.argsort(words)
    places = np.empty(len(words), "<u4")
    places[order] = np.arange(len(words), dtype="<u4")
    return words[order], places[found.indices.to_numpy()]


def _context_hashes(context: list[Array]) -> Array:
    out = context[0]
    for x in context[1:]:
        out = mixed(out * _PAIR + x)
    return out


def gram_keys(context: list[Array], words: Array, bits: int, spread: Array) -> Array:
    """The key of each gram: top bits of the last word of the context, or of its pair with the word if it is spread, then bits of all."""
    keys = mixed(_context_hashes(context) * _PAIR + words)
    if not bits:
        return keys
    top = np.uint64(64 - bits)
    return (_owners(context[0], words, spread) >> top << top) | (keys >> np.uint64(bits))


def _owners(last: Array, words: Array, spread: Array) -> Array:
    """Hashes whose top bits are the shards of grams, from the last words of their contexts."""
    return np.where(spread, mixed(last * _PAIR + words), last)


def context_keys(context: list[Array], bits: int, spread: Array) -> Array:
    """The key of each context, in the shard of its last word unless that is spread."""
    keys = mixed(_context_hashes(context))
    if not bits:
        return keys
    top = np.uint64(64 - bits)
    return np.where(spread, keys, (context[0] >> top << top) | (keys >> np.uint64(bits)))


def found_in(sorted_keys: Array, keys: Array) -> tuple[Array, Array]:
    """Places of keys in sorted keys, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    places = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return places, sorted_keys[places] == keys


def _by_shard(keys: Array, bits: int) -> Iterator[tuple[int, slice]]:
    """The shards of sorted keys and their spans."""
    shards = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
        if b > a:
            yield int(shards[a]), slice(a, b)


def _planes(values: Array) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: bytes that are mostly 0 compress to next to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _packed(*arrays: Array) -> bytes:
    """Arrays of 4 or 8 bytes a number; those of 8 as differences, since keys are sorted."""
    parts = [_planes(np.diff(x, prepend=np.zeros(1, x.dtype)) if x.itemsize == 8 else x) for x in arrays]
    data = np.array([len(arrays), *map(len, parts)], dtype="<u8").tobytes() + b"".join(parts)
    return pa.compress(data, codec="zstd", asbytes=True) + len(data).to_bytes(8, "little")


def _unpacked(blob: bytes, kinds: str) -> list[Array]:
    data = pa.decompress(blob[:-8], int.from_bytes(blob[-8:], "little"), codec="zstd", asbytes=True)
    sizes, at, out = np.frombuffer(data, "<u8", len(kinds) + 1)[1:], 8 * (len(kinds) + 1), []
    for kind, size in zip(kinds, sizes.tolist(), strict=True):
        width = {"k": 8, "n": 4}[kind]
        planes = np.frombuffer(data, np.uint8, size, at).reshape(width, -1)
        values = np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1)
        out.append(np.cumsum(values, dtype="<u8") if kind == "k" else values)
        at += size
    return out


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.large_binary())], names=["shard", "blob"])


def _token_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Array, Array]]:
    """Tokens of the texts, some ``HELD_TOKENS`` at a time, and the places where texts start."""
    held, starts, n = [], [], 0
    for batch in pieces(batches, "text", most=1 << 22):
        for _, tokens, bounds in token_runs(as_bytes(batch.column("text"))):
            held.append(tokens)
            starts.append(bounds[:-1] + n)
            n += len(tokens)
            if n >= HELD_TOKENS:
                yield np.concatenate(held), np.concatenate(starts)
                held, starts, n = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(starts)


def _count_words(bits: int) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _token_blocks(batches):
            keys, codes = coded(tokens)
            counts = np.bincount(codes, minlength=len(keys))
            yield _rows([(s, _packed(keys[at], counts[at].astype("<u4"))) for s, at in _by_shard(keys, bits)])

    return count


def _in_part(tokens: Array, last: Array, spread: Array, part: int, parts: int) -> Array:
    """Places of the grams in one of ``parts`` equal spans of the shards; only those after words that are spread are hashed to know."""
    top = np.uint64(65 - parts.bit_length())
    mine = last >> top == part
    pairs = np.flatnonzero(spread)
    mine[pairs] = _owners(last[pairs], tokens[pairs], np.True_) >> top == part
    return np.flatnonzero(mine)


def _count_grams(order: int, bits: int, hot: Array, part: int = 0, parts: int = 1) -> Callable:
    """Counts the grams of one of ``parts`` equal spans of the shards."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, starts in _token_blocks(batches):
            columns = [tokens, *contexts_of(tokens, starts, order)]
            slices = [slice(a, a + SLICE) for a in range(0, len(tokens), SLICE)]
            spread = np.concatenate([found_in(hot, columns[1][x])[1] for x in slices])
            if parts > 1:
                mine = np.concatenate([_in_part(tokens[x], columns[1][x], spread[x], part, parts) + x.start for x in slices])
                columns, spread = [x[mine] for x in columns], spread[mine]
            tokens = None
            keys = np.concatenate([gram_keys([c[x] for c in columns[1:]], columns[0][x], bits, spread[x]) for x in slices])
            keys, counts, at = summed(keys)
            columns, rows = [x[at] for x in columns], []
            for shard, span in _by_shard(keys, bits):
                known, places = np.unique(np.concatenate([x[span] for x in columns]), return_inverse=True)  # a word is written once
                places = places.reshape(order, -1).astype("<u4")
                by_pair = np.argsort((places[1].astype(np.uint64) << np.uint64(32)) | places[0])  # equal words side by side
                places = np.diff(places[:, by_pair], axis=1, prepend=np.zeros((order, 1), "<u4"))
                rows.append((shard, _packed(known, places.reshape(-1), counts[span][by_pair].astype("<u4"))))
            yield _rows(rows)

    return count


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist(), strict=True)


def _key_table(keys: Array, bits: int) -> tuple[Array, ...]:
    """Sorted keys of a shard in 5 or 6 bytes each: where the keys of each bucket, given by the bits after the shard's, begin, then
    the lower 4 bytes of every key and the rest. A bucket has 2 to 4 keys if there are enough; shard and bucket give the bits above,
    24 if they are as many, else 16.
    """
    fine = int(len(keys)).bit_length() - 2
    width = 1 if fine > 0 and fine + bits >= 24 else 2
    own = max(1, 8 * (4 - width) - bits, fine)
    buckets = (keys << np.uint64(bits)) >> np.uint64(64 - own)
    begins = np.searchsorted(buckets, np.arange((1 << own) + 1, dtype=np.uint64))
    return begins.astype("<u4"), keys.astype("<u4"), (keys >> np.uint64(32)).astype(f"<u{width}")


def _usual(columns: int) -> Array:
    """The values of a key that was counted once: most keys have them, and are stored without."""
    return np.array([1, 1, 0, 0][:columns], np.int64)


def _are_usual(values: tuple[Array, ...]) -> Array:
    return np.all([v == x for v, x in zip(values, _usual(len(values)), strict=True)], axis=0)


def _save_contexts(folder: str, name: str, bits: int, keys: Array, *sums: Array) -> None:
    """Writes the contexts but those with the usual sums: a reader knows from the grams below which contexts were seen."""
    more = ~_are_usual(sums)
    _save(folder, name, bits, keys[more], *(x[more] for x in sums))


def _save(folder: str, name: str, bits: int, keys: Array, *values: Array) -> None:
    """Writes a shard's arrays under a name of its own, then moves them in place, so that a repeated task does no harm.

    First the keys with the usual values, then the others, whose values take a byte each; larger ones follow with their places.
    """
    usual = _are_usual(values)
    rest = [v[~usual].astype("<u8") for v in values]
    arrays = [*_key_table(keys[usual], bits), *_key_table(keys[~usual], bits)]
    for v in rest:
        large = np.flatnonzero(v >= 255)
        arrays += [np.minimum(v, 255).astype(np.uint8), large.astype("<u8"), v[large]]
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    own = f"{place}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(np.array([bits, arrays[2].itemsize, arrays[5].itemsize, *map(len, arrays)], "<u8").tobytes())
        for x in arrays:
            out.write(x.tobytes() + bytes(-x.nbytes % 8))  # every array begins at a multiple of 8
    store.move(own, f"{place}/{name}")


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _MERGED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.large_binary(), *[pa.int64()] * 6]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _stats(counts: Array) -> tuple[int, ...]:
    """Sum, number, and how many are 1, 2, 3 and 4."""
    return (int(counts.sum()), len(counts), *(int((counts == i).sum()) for i in (1, 2, 3, 4)))


def _sums(merged: DataFrame) -> dict[str, list[int]]:
    """The sums of the statistics of each kind."""
    return {r[0]: list(r[1:]) for r in merged.groupBy("kind").agg(*[F.sum(x) for x in ("total", "n0", "n1", "n2", "n3", "n4")]).collect()}


def _merge_words(folder: str, name: str, bits: int) -> Callable:
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(blob, "kn") for _, blob in _blobs(batches)]
        if not parts:
            return
        keys, counts, _ = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64))
        rows = []
        for shard, at in _by_shard(keys, bits):
            _save(folder, f"{name}-{shard:07d}", bits, keys[at], counts[at])
            many = np.flatnonzero(counts[at] * HOT > counts[at].sum())
            rows.append(("shard", shard, _packed(keys[at][many], counts[at][many].astype("<u4")), *_stats(counts[at])))
        yield _merged(rows)

    return merge


def _merge_grams(folder: str, order: int, bits: int, hot: Array) -> Callable:
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = defaultdict(list)
        for shard, blob in _blobs(batches):
            packed[shard].append(blob)
        for shard in sorted(packed):  # a task may get several; one of them is unpacked at a time
            columns, counts = [[] for _ in range(order)], []
            for blob in packed.pop(shard):
                known, places, n = _unpacked(blob, "knn")
                for column, x in zip(columns, np.cumsum(places.reshape(order, -1), axis=1, dtype="<u4"), strict=True):
                    column.append(known[x])
                counts.append(n.astype(np.int64))
            words, *context = [np.concatenate(x) for x in columns]
            counts, columns = np.concatenate(counts), None
            spread = found_in(hot, context[0])[1]
            for level in range(order, 1, -1):
                keys, counts, at = summed(gram_keys(context, words, bits, spread), counts)
                words, context, spread = words[at], [x[at] for x in context], spread[at]
                yield _level(folder, level, bits, shard, keys, context, spread, counts)
                counts, context = None, context[:-1]  # a gram counts once for the one without its first word
            own, times, _ = summed(words)
            yield _merged([("word", s, _packed(own[i], times[i].astype("<u4")), *[0] * 6) for s, i in _by_shard(own, bits)])

    return merge


def _level(folder: str, level: int, bits: int, shard: int, keys: Array, context: list[Array], spread: Array, counts: Array) -> pa.RecordBatch:
    """Writes the grams of an order in a shard and their contexts; the sums of contexts that are spread become rows."""
    _save(folder, f"grams{level}-{shard:07d}", bits, keys, counts)
    rows = [(f"shard{level}", shard, b"", *_stats(counts))]
    for mine in (~spread, spread):
        own, place = np.unique(context_keys([x[mine] for x in context], bits, spread[mine]), return_inverse=True)
        n = counts[mine]
        sums = [np.bincount(place, x, len(own)).astype("<u8") for x in (n, n == 1, n == 2, n > 2)]
        if mine is spread:
            rows += [("context", s, _packed(np.array([level], "<u4"), own[i], *(x[i] for x in sums)), *[0] * 6) for s, i in _by_shard(own, bits)]
        else:
            _save_contexts(folder, f"contexts{level}-{shard:07d}", bits, own, *sums)
    return _merged(rows)


def _merge_spread(folder: str, bits: int) -> Callable:
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(blob, "nkkkkk") for _, blob in _blobs(batches)]
        for level in sorted({int(p[0][0]) for p in parts}):
            keys, *sums = (np.concatenate([p[i] for p in parts if p[0][0] == level]) for i in range(1, 6))
            own, place = np.unique(keys, return_inverse=True)
            sums = [np.bincount(place, x, len(own)).astype("<u8") for x in sums]
            for shard, at in _by_shard(own, bits):
                _save_contexts(folder, f"spread{level}-{shard:07d}", bits, own[at], *(x[at] for x in sums))
                yield _rows([(shard, b"")])

    return merge


@dataclass(frozen=True)
class Counts:
    """Sum and number of the counts of an order, and the three discounts."""

    total: int
    different: int
    discounts: tuple[float, float, float]

    @staticmethod
    def of(merged: DataFrame) -> Counts:
        return Counts.from_sums(_sums(merged).get("shard", [0] * 6))

    @staticmethod
    def from_sums(sums: Sequence[int]) -> Counts:
        total, *n = sums
        if min(n[1:]) == 0:  # too few counts to estimate from
            return Counts(total, n[0], (0.5, 0.75, 0.9))
        y = n[1] / (n[1] + 2 * n[2])
        return Counts(total, n[0], tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3)))

    def left(self, counts: Array) -> Array:
        """The counts after the discount."""
        return counts - np.concatenate([[0.0], self.discounts])[np.minimum(counts, 3)]


class Shard:
    """A shard's file, mapped into memory."""

    def __init__(self, path: str, columns: int):
        with open(path, "rb") as file:  # not np.memmap, which holds on to a descriptor for each of many files
            data = np.frombuffer(mmap(file.fileno(), 0, access=ACCESS_READ, **_MAPPED), np.uint8)
        n = 6 + 3 * columns
        self.bits, usual, rest, *sizes = data[: 8 * (3 + n)].view("<u8").tolist()
        kinds = ["<u4", "<u4", f"<u{usual}", "<u4", "<u4", f"<u{rest}", *["u1", "<u8", "<u8"] * columns]
        at, arrays = 8 * (3 + n), []
        for kind, n in zip(kinds, sizes, strict=True):
            size = n * np.dtype(kind).itemsize
            arrays.append(data[at : at + size].view(kind))
            at += size + -size % 8
        self.usual, self.rest, self.values = arrays[:3], arrays[3:6], [arrays[i : i + 3] for i in range(6, len(arrays), 3)]


def _found(tables: list[tuple[list[Array], slice]], bits: int, keys: Array) -> tuple[Array, Array, list[slice]]:
    """Which of the sorted keys are in the key tables, their places there, and the span of each table in these; a table is asked for its span of the keys.

    What can be done for the keys of all tables at once is: with many shards, few keys of a slice of texts go to each.
    """
    at, end, within = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), keys << np.uint64(bits)
    for (begins, _, _), span in tables:
        buckets = (within[span] >> np.uint64(65 - (len(begins) - 1).bit_length())).astype(np.int64)
        at[span], end[span] = begins[buckets], begins[buckets + 1]
    sizes = end - at
    of = np.repeat(np.arange(len(keys)), sizes)  # what a key's bucket holds is compared with it
    near = np.arange(len(of)) + np.repeat(end - np.cumsum(sizes), sizes)
    starts = [span.start for _, span in tables]
    spans = _spans(of, starts)
    low = np.concatenate([table[1][near[span]] for (table, _), span in zip(tables, spans, strict=True)])
    same = np.flatnonzero(low == np.repeat(keys.astype("<u4"), sizes))
    of, near = of[same], near[same]
    high, spans = keys[of] >> np.uint64(32), _spans(of, starts)
    same = np.flatnonzero(np.concatenate([table[2][near[span]] == high[span].astype(table[2].dtype) for (table, _), span in zip(tables, spans, strict=True)]))
    of, near = of[same], near[same]
    return of, near, _spans(of, starts)


def _spans(places: Array, starts: list[int]) -> list[slice]:
    """The spans of the sorted places from each start to the next; there are none before the first."""
    return [slice(a, b) for a, b in pairwise([*np.searchsorted(places, starts).tolist(), len(places)])]


def look_up(shards: list[tuple[Shard, slice]], keys: Array, out: Array) -> None:
    """Puts the values of sorted keys, a span of them for each shard, into the columns of ``out``; a key that isn't there leaves them."""
    bits = shards[0][0].bits
    of, places, spans = _found([(shard.rest, span) for shard, span in shards], bits, keys)
    for i, row in enumerate(out):
        values = np.concatenate([shard.values[i][0][places[span]] for (shard, _), span in zip(shards, spans, strict=True)]).astype(np.int64)
        for (shard, _), span in zip(shards, spans, strict=True):
            _, large, full = shard.values[i]
            if len(large):
                more = np.flatnonzero(values[span] == 255) + span.start
                values[more] = full[np.searchsorted(large, places[more])]
        row[of] = values
    left = np.ones(len(keys), bool)
    left[of] = False
    left = np.flatnonzero(left)
    usual = [(shard.usual, span) for shard, span in shards if len(shard.usual[1])]
    if usual:
        cuts = np.searchsorted(left, [(span.start, span.stop) for _, span in usual]).tolist()
        of, _, _ = _found([(table, slice(*cut)) for (table, _), cut in zip(usual, cuts, strict=True)], bits, keys[left])
        out[:, left[of]] = _usual(len(out))[:, None]


@lru_cache(1 << 15)  # a worker goes through all shards again and again
def _mapped(folder: str, name: str, columns: int) -> Shard | None:
    """A shard; None if there is no such one. Of a store that isn't local the workers of a host share one copy."""
    store, place = fs.FileSystem.from_uri(folder)
    path = f"{place}/{name}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if not isinstance(store, fs.LocalFileSystem):
        own = os.path.join(tempfile.gettempdir(), f"model-{md5(folder.encode()).hexdigest()}")
        os.makedirs(own, exist_ok=True)
        path, part = os.path.join(own, name), os.path.join(own, f".{name}-{uuid.uuid4().hex}")
        if not os.path.exists(path):
            fs.copy_files(f"{place}/{name}", part, source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
            os.replace(part, path)
    return Shard(path, columns)


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int
    words: Counts
    grams: tuple[Counts, ...]  # of order 2, 3 and so on
    continuations: Counts
    hot: Array  # sorted
    spare: float  # what the discounts leave to the uniform distribution

    def look_up(self, name: str, keys: Array) -> Array:
        """The values of sorted keys; 0 for a key that isn't there."""
        return self._look_up(name, keys, np.zeros((1, len(keys)), np.int64))[0]

    def context_sums(self, name: str, keys: Array) -> Array:
        """The sums of sorted keys of contexts that were seen, a row for each; those that aren't there have the usual ones."""
        return self._look_up(name, keys, np.repeat(_usual(4)[:, None], len(keys), axis=1))

    def _look_up(self, name: str, keys: Array, out: Array) -> Array:
        asked = []
        for shard, at in _by_shard(keys, self.bits):
            known = _mapped(self.folder, f"{name}-{shard:07d}", len(out))
            if known is not None:
                asked += [(known, slice(a, min(a + LOOKED_UP, at.stop))) for a in range(at.start, at.stop, LOOKED_UP)]
        first = 0
        for i, (_, at) in enumerate(asked, 1):
            start = asked[first][1].start
            if i == len(asked) or asked[i][1].stop - start > LOOKED_UP:
                look_up([(shard, slice(x.start - start, x.stop - start)) for shard, x in asked[first:i]], keys[start : at.stop], out[:, start : at.stop])
                first = i
        return out

    @property
    def order(self) -> int:
        return len(self.grams) + 1

    def scores(self, tokens: Array, starts: Array) -> tuple[Array, Array, Array]:
        """Log10 probability of each token by the base and by the model, and its training count; ``starts`` are the places where texts start."""
        context = contexts_of(tokens, starts, self.order)
        words, at = coded(tokens)
        count, kinds = self.look_up("words", words), self.words.different + 1
        base = np.log10((count + 0.5) / (self.words.total + 0.5 * kinds))
        p = self._lower(self.look_up("continuations", words), kinds)[at]
        spread, n = np.concatenate([[False], found_in(self.hot, words)[1][at[:-1]]]), count[at]
        spread[starts] = True  # the begin token is hot
        for level, grams in enumerate(self.grams, 2):
            own, below = context[: level - 1], n > 0
            seen = np.concatenate([[False], below[:-1]])  # a context was seen if the gram of the order below that ends before the word was
            seen[starts] = self.words.total > 0
            n, known = np.zeros(len(tokens), np.int64), np.flatnonzero(seen & below)
            keys, place = np.unique(gram_keys([x[known] for x in own], tokens[known], self.bits, spread[known]), return_inverse=True)
            n[known] = self.look_up(f"grams{level}", keys)[place]
            total, share = np.ones(len(tokens)), np.ones(len(tokens))
            for name, mine in (("contexts", np.flatnonzero(seen & ~spread)), ("spread", np.flatnonzero(seen & spread))):
                keys, place = np.unique(context_keys([x[mine] for x in own], self.bits, spread[mine]), return_inverse=True)
                sums = self.context_sums(f"{name}{level}", keys)
                total[mine] = sums[0][place]
                share[mine] = (np.asarray(grams.discounts) @ sums[1:] / sums[0])[place]
            p = np.where(n > 0, grams.left(n), 0.0) / total + share * p
        return base[at], np.log10(p), count[at]

    def _lower(self, contexts: Array, kinds: int) -> Array:
        own = self.continuations
        if not own.total:
            return np.full(len(contexts), 1 / kinds)
        left = np.where(contexts > 0, own.left(contexts), 0.0)
        return left / own.total + self.spare / kinds


def train(texts: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, order: int = 2) -> Model:
    """The model of the rows of ``texts`` (text), its arrays below ``folder``."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, size / shard_bytes)))))
    shards = 1 << bits
    dealt = lambda rows: rows.repartition(shards, "shard")

    words = stored(dealt(texts.mapInArrow(_count_words(bits), _COUNTED)).mapInArrow(_merge_words(folder, "words", bits), _MERGED), folder, "word-stats")
    known = Counts.of(words)
    release(texts.sparkSession)
    candidates = [_unpacked(bytes(r[0]), "kn") for r in words.where("kind = 'shard'").select("blob").toLocalIterator()]
    hot = np.sort(np.concatenate([[BEGIN], *(k[n.astype(np.int64) * HOT > known.total] for k, n in candidates)]).astype(np.uint64))

    counted, sums, parts = [], [], min(PARTS, shards)
    for part in range(parts):
        counting, merging = _count_grams(order, bits, hot, part, parts), _merge_grams(folder, order, bits, hot)
        counted.append(stored(dealt(texts.mapInArrow(counting, _COUNTED)).mapInArrow(merging, _MERGED), folder, f"gram-stats-{part}"))
        sums.append(_sums(counted[-1]))  # a shuffle can be let go only once another query has run
        release(texts.sparkSession)
    grams = reduce(DataFrame.unionAll, counted)
    stored(dealt(grams.where("kind = 'context'").select("shard", "blob")).mapInArrow(_merge_spread(folder, bits), _COUNTED), folder, "spread-stats")

    release(texts.sparkSession)
    following = dealt(grams.where("kind = 'word'").select("shard", "blob"))
    following = stored(following.mapInArrow(_merge_words(folder, "continuations", bits), _MERGED), folder, "continuation-stats")
    lower = Counts.of(following)
    r = following.where("kind = 'shard'").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1", "n2")]).first()
    spare = lower.discounts[0] * r["n1"] + lower.discounts[1] * r["n2"] + lower.discounts[2] * (r["n0"] - r["n1"] - r["n2"])
    release(texts.sparkSession)
    return Model(folder, bits, known, tuple(Counts.from_sums(np.sum([x.get(f"shard{i}", [0] * 6) for x in sums], axis=0).tolist()) for i in range(2, order + 1)), lower, hot, spare / lower.total if lower.total else 1.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out`` and the scores of every row of ``docs`` (doc_id, text, held_out)."""
    out = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", most=SCORED_BYTES):
            runs = list(token_runs(as_bytes(batch.column("text"))))  # every text has its end, so its tokens are never none
            tokens, sizes = np.concatenate([r[1] for r in runs]), np.concatenate([np.diff(r[2]) for r in runs])
            starts = np.cumsum(sizes) - sizes
            base, own, count = model.scores(tokens, starts)
            n, n_known, base, own = [sizes, *(np.add.reduceat(x, starts) for x in (count > 0, base, own))]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(n.astype(np.int64)), pa.array(n_known.astype(np.int64)), pa.array([model.words.total] * batch.num_rows, pa.int64()), pa.array(base), pa.array(own)], names=out
            )

    return docs.select("doc_id", "text", "held_out").mapInArrow(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def language_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """Trains a model of the order on the rows of ``docs`` (doc_id, text) outside the held-out fold and scores all rows.

    A null or empty text is the end token alone. Rows that repeat a doc_id count and are scored each by itself; a null
    doc_id is held out. Without training rows every token has the probability 1 / (V + 1) with V = 0. An empty table
    gives no rows; other columns are ignored.
    """
    folder = work_folder(docs.sparkSession, "kneser-ney")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    return scored(rows, train(rows.where("not held_out").select("text"), folder, order=order))

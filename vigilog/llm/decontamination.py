"""Benchmark decontamination: size-partitioned MinHash containment search, confirmed by exact shingle containment.

Items are partitioned by the size of their shingle set into classes (bound / 2, bound]. For each class a document is cut
into windows of twice the bound, a new one at every bound, so that an item's passage lies inside a window that is at most
four times its size: a short item and a long document become sets of similar size, and the Jaccard similarity of an item
contained to 75 % with such a window is 0.17 or more. Both get ``COORDINATES`` minima. A document is a candidate for an item
if they agree in one coordinate (64 coordinates miss a similarity of 0.17 with a chance of about 6e-6); the minima of the windows of a
class are those of the next smaller class taken together. Items of ``FEW`` shingles or less are too small for a window of
the least bound: they are looked up by their rarest shingles, of which a document that holds 75 % of an item has one at
least, so none is missed. Candidates are confirmed where they are found, on the whole
shingle sets of item and document.

The items of one pass over the documents are broadcast, ``MOST_BYTES`` at most; more items take more passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilog.llm.words import as_bytes, mixed, pieces, shingle_run, shingle_sets, word_runs

WIDTH = 5
CONTAINED = 75  # percent
COORDINATES = 64
LEAST_BOUND = 16
FEW = LEAST_BOUND // 2
MOST_BYTES = 64 << 20
ITEM_COLUMNS = "item_id long, grams binary"

_random = np.random.Generator(np.random.PCG64(19))
_XOR = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2)
_FACTOR = _random.integers(0, 2**62, COORDINATES, dtype=np.uint64) * np.uint64(4) + np.uint64(1)


def item_sets(benchmark: DataFrame) -> DataFrame:
    """``item_id`` and the sorted shingle set of each different item that has a word."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            grams = [x.tobytes() for x in shingle_sets(as_bytes(batch.column("text")), WIDTH)]
            yield pa.record_batch([batch.column("item_id"), pa.array(grams, pa.large_binary())], names=["item_id", "grams"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    return items.mapInArrow(sets, ITEM_COLUMNS).where(F.length("grams") > 0).distinct()


@dataclass
class SizeClass:
    """The items of one class: for every coordinate the sorted minima and whose they are."""

    bound: int
    minima: np.ndarray  # coordinate x item, sorted by row
    owners: np.ndarray


class ItemIndex:
    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in rows]
        self.sets = [np.frombuffer(x, dtype=np.uint64) for _, x in rows]
        sizes = np.array([len(x) for x in self.sets])
        bounds = np.maximum(LEAST_BOUND, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        self.classes = []
        self._look_up_few(np.flatnonzero(sizes <= FEW), sizes)
        for bound in sorted({*bounds[sizes > FEW].tolist()}):
            own = np.flatnonzero((bounds == bound) & (sizes > FEW))
            minima = np.array([[((self.sets[i] ^ x) * f).min() for i in own] for x, f in zip(_XOR, _FACTOR, strict=True)])
            order = np.argsort(minima, axis=1, kind="stable")
            self.classes.append(SizeClass(bound, np.take_along_axis(minima, order, axis=1), own[order]))

    def _look_up_few(self, few: np.ndarray, sizes: np.ndarray) -> None:
        """Of each small item, one shingle more than it may lack, those that the fewest items have."""
        grams = np.concatenate([np.empty(0, np.uint64), *(self.sets[i] for i in few)])
        owners = np.repeat(few, sizes[few])
        _, back, counts = np.unique(grams, return_inverse=True, return_counts=True)
        order = np.lexsort((counts[back], owners))
        n = sizes[few]
        place = np.arange(len(grams)) - np.repeat(np.cumsum(n) - n, n)
        order = order[place < np.repeat(n + 1 - -(-CONTAINED * n // 100), n)]
        order = order[np.argsort(grams[order], kind="stable")]
        self.rare, self.rare_owners = grams[order], owners[order]

    def _pairs(self, keys: np.ndarray, owners: np.ndarray, values: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Pairs (text, item), each once, for the values found in the sorted keys."""
        low = np.searchsorted(keys, values, "left")
        hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == values)
        if not len(hit):
            return np.empty((0, 2), np.int64)
        many = np.searchsorted(keys, values[hit], "right") - low[hit]
        ends = np.cumsum(many)
        places = np.arange(ends[-1]) + np.repeat(low[hit] - (ends - many), many)
        return np.unique(np.stack([np.repeat(of[hit], many), owners[places]], axis=1), axis=0)

    def candidates(self, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Pairs (text, item) of a run of shingles that agree in a coordinate or share a rare shingle of a small item, each once."""
        counts = np.diff(bounds)
        texts = np.flatnonzero(counts)
        if not len(texts):
            return np.empty((0, 2), np.int64)
        found = [self._pairs(self.rare, self.rare_owners, grams, np.repeat(np.arange(len(counts)), counts))] if len(self.rare) else []
        for k in range(COORDINATES if self.classes else 0):
            values = (grams ^ _XOR[k]) * _FACTOR[k]
            step, sizes, starts = 1, counts[texts], bounds[texts]
            for c in self.classes:
                blocks = -(-sizes * step // c.bound) if step == 1 else -(-sizes // (c.bound // step))
                firsts = np.cumsum(blocks) - blocks
                within = np.arange(blocks.sum()) - np.repeat(firsts, blocks)
                values = np.minimum.reduceat(values, np.repeat(starts, blocks) + within * (c.bound // step))
                step, sizes, starts = c.bound, blocks, firsts
                windows = values.copy()
                joined = np.flatnonzero(within[1:] > 0)
                windows[joined] = np.minimum(values[joined], values[joined + 1])
                of = np.repeat(texts, blocks)
                found.append(self._pairs(c.minima[k], c.owners[k], windows, of))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def contained(self, texts: list[bytes | None]) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) for the texts that hold enough of an item."""
        for first, hashes, word_bounds in word_runs(texts):
            grams, bounds = shingle_run(hashes, word_bounds, WIDTH)
            pairs = self.candidates(grams, bounds)
            for text in np.unique(pairs[:, 0]):
                own = np.unique(grams[bounds[text] : bounds[text + 1]])
                for item in pairs[pairs[:, 0] == text, 1]:
                    wanted = self.sets[item]
                    places = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    shared = int((own[places] == wanted).sum())
                    if 100 * shared >= CONTAINED * len(wanted):
                        yield first + int(text), int(item), shared


def item_parts(benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The item sets in parts of about ``most_bytes``, each collected by itself. No items give no part."""
    items = item_sets(benchmark)
    size = items.agg(F.sum(F.length("grams") + 24 * COORDINATES)).first()[0] or 0
    parts = 0 if not size else 1 + size // max(1, most_bytes // 2)  # parts by hash are uneven; twice the mean is far off
    for i in range(parts):
        part = items.where(F.pmod(F.xxhash64("item_id", "grams"), F.lit(parts)) == i) if parts > 1 else items
        yield [(r[0], bytes(r[1])) for r in part.collect()]


def contained_items(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_item``: the items of which a document holds 75 % of the shingles or more.

    Shingles have five words; an item or document with fewer words is one shingle of them all, so a short item is found in
    equal word sequences only. Nulls, empty texts and null item_ids match nothing; a null doc_id is carried along. Equal
    item rows count once, items with one id and different texts each by itself, repeated documents each by itself. Empty
    tables give no rows. Other columns are ignored. Memory per task: the items of a pass and a slice of texts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    out = spark.createDataFrame([], schema)
    for rows in item_parts(benchmark, most_bytes):
        out = out.union(texts.mapInArrow(_matches(spark.sparkContext.broadcast(ItemIndex(rows))), schema))
    return out


def _matches(index) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def matches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for batch in pieces(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            found = [(ids[t], items.ids[i], n, len(items.sets[i])) for t, i, n in items.contained(as_bytes(batch.column("text")))]
            columns = [*zip(*found, strict=True)] or [[]] * 4
            names = ["doc_id", "item_id", "n_shared", "n_item"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    return matches


def decontaminated(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; nothing is shuffled."""

    def clean(index) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                free = np.ones(batch.num_rows, dtype=bool)
                free[[t for t, _, _ in index.value.contained(as_bytes(batch.column("text")))]] = False
                yield batch.filter(pa.array(free))

        return keep

    for rows in item_parts(benchmark, most_bytes):
        docs = docs.mapInArrow(clean(docs.sparkSession.sparkContext.broadcast(ItemIndex(rows))), docs.schema)
    return docs

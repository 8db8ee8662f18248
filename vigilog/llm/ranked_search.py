"""Ranked lexical search by pipelined term partitioning.

The index is blocks of about ``BLOCK_BYTES`` of text, and of each block the posting list of every term. Terms are owned by
stages, the rarest by the first. A bundle is some items and, for one block, the sparse accumulators of each: it visits
the stages in turn, and where it meets the owner's postings of its block (a cogroup), the owner adds the integer
contributions of its terms and passes the bundle on. So a term that stands in a third of all documents is as many posting lists
as there are blocks, and no task holds more than a block.

An accumulator that can no longer come among the best of its own block is not carried further: what the later owners
can add is known from the largest frequency of each term. Scores are whole numbers, so the order of stages changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vigilog.llm.runs import separators, text_runs
from vigilog.llm.shared import stored, work_folder
from vigilog.llm.words import as_bytes, pieces

# All but ASCII letters, digits and what is not ASCII parts two terms.
BREAKS = separators([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
KEPT = 20
BLOCK_BYTES = 8 << 20
BUNDLE_ITEMS = 256
STAGE_SHARES = (0.002, 0.02, 0.1)  # of the documents: terms in more of them belong to the next stage
MOST_TERMS = 2_000_000  # of the items, 16 MB: beyond it the index holds all terms of the documents
SENT_BYTES = 16 << 20  # of the items' terms: beyond it bundles are joined with the blocks by shuffle
LEAST_NORM = 75

_INDEX = "block long, term long, first binary, second binary, third binary, df long, most long, words long"
_BUNDLE = "block long, bundle int, item long, terms array<long>, gains array<long>, tops array<long>, stages array<int>, places binary, scores binary"
_FOUND = "item long, doc_id long, score long"


def _counted(texts: list[bytes | None], vocabulary: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text (its number, the term, its occurrences), sorted by term and text, and the length of every text."""
    lengths = np.zeros(len(texts), np.int64)
    docs, terms = [], []
    for first, _, hashes, _, _, bounds in text_runs(texts, BREAKS):
        n = np.diff(bounds)
        lengths[first : first + len(n)] = n
        owner, hashes = np.repeat(np.arange(first, first + len(n)), n), hashes.view(np.int64)
        if vocabulary is not None:
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1) if len(vocabulary) else np.zeros(len(hashes), np.int64)
            held = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
            owner, hashes = owner[held], hashes[held]
        docs.append(owner)
        terms.append(hashes)
    doc, term = np.concatenate([*docs, np.empty(0, np.int64)]), np.concatenate([*terms, np.empty(0, np.int64)])
    order = np.lexsort((doc, term))
    doc, term = doc[order], term[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])])) if len(doc) else np.empty(0, np.int64)
    return doc[new], term[new], np.diff(np.append(new, len(doc))), lengths


def _index_rows(vocabulary: np.ndarray | None) -> Callable:
    schema = pa.schema([("block", pa.int64()), ("term", pa.int64()), *[(n, pa.binary()) for n in ("first", "second", "third")], *[(n, pa.int64()) for n in ("df", "most", "words")]])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, "text", BLOCK_BYTES):
            doc, term, tf, lengths = _counted(as_bytes(batch.column("text")), vocabulary)
            worded = lengths > 0
            if not worded.any():
                continue
            place = np.cumsum(worded) - 1
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)[worded]
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[worded]
            kept = lengths[worded]
            out = [(block, None, numbers.tobytes(), kept.tobytes(), known.tobytes(), len(kept), None, int(kept.sum()))]
            cuts = [0, *(np.flatnonzero(np.diff(term)) + 1).tolist(), len(term)] if len(term) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                out.append((block, int(term[a]), place[doc[a:b]].astype(np.int32).tobytes(), tf[a:b].astype(np.int32).tobytes(), None, b - a, int(tf[a:b].max()), None))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
            block += 1

    return rows


def _item_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        doc, term, tf, _ = _counted(as_bytes(batch.column("text")), None)
        yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(doc)), pa.array(term), pa.array(tf.astype(np.int64))], ["item", "term", "qtf"])


def build_index(docs: DataFrame, folder: str, vocabulary: np.ndarray | None = None) -> DataFrame:
    """The stored index of ``docs``: of each block a directory row (``term`` null) and a row for each term.

    ``vocabulary`` (sorted) leaves other terms out. Documents without a term have no place in it.
    """
    doc_id = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long").alias("doc_id")
    texts = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    return stored(texts.mapInArrow(_index_rows(vocabulary), _INDEX), folder, "index")


def _visit(stage: int, last: int, n_docs: int, n_words: int, kept: int) -> Callable:
    """What the owner of a stage does with the bundle of a block and its own postings there."""
    found_schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def visit(key: tuple[pa.Scalar, ...], bundle: pa.Table, postings: pa.Table) -> pa.Table:
        rows = postings.to_pylist()
        here = {r["term"]: r for r in rows if r["term"] is not None}
        directory = next(r for r in rows if r["term"] is None)
        lengths = np.frombuffer(directory["second"], np.int64)
        norms = LEAST_NORM + 25 * lengths * n_docs // n_words
        parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def part(term: int) -> tuple[np.ndarray, np.ndarray]:
            if term not in parts:
                places, tf = (np.frombuffer(here[term][n], np.int32).astype(np.int64) for n in ("first", "second"))
                parts[term] = places, 1_000_000_000 * tf // (1000 * tf + 12 * norms[places])
            return parts[term]

        out_places, out_scores, found = [], [], []
        for r in bundle.select(["item", "terms", "gains", "tops", "stages", "places", "scores"]).to_pylist():
            sums = np.zeros(len(lengths), np.int64)
            sums[np.frombuffer(r["places"], np.int32)] = np.frombuffer(r["scores"], np.int64)
            rest = 0
            for term, gain, top, owner in zip(r["terms"], r["gains"], r["tops"], r["stages"], strict=True):
                rest += top if owner > stage else 0
                if owner == stage and term in here:
                    places, share = part(term)
                    sums[places] += gain * share
            live = np.flatnonzero(sums)
            if len(live) > kept:
                least = np.partition(sums[live], len(live) - kept)[len(live) - kept]
                live = live[sums[live] + rest >= least]
            if stage < last:
                out_places.append(live.astype(np.int32).tobytes())
                out_scores.append(sums[live].tobytes())
                continue
            ids, known = np.frombuffer(directory["first"], np.int64)[live], np.frombuffer(directory["third"], bool)[live]
            best = np.lexsort((ids, ~known, -sums[live]))[:kept]
            found.append(pa.table([pa.array(np.full(len(best), r["item"])), pa.array(ids[best], mask=~known[best]), pa.array(sums[live][best])], schema=found_schema))
        if stage == last:
            return pa.concat_tables(found) if found else found_schema.empty_table()
        carried = bundle.drop_columns(["places", "scores"])
        return carried.append_column("places", pa.array(out_places, pa.binary())).append_column("scores", pa.array(out_scores, pa.binary()))

    return visit


def ranked(docs: DataFrame, items: DataFrame, kept: int = KEPT) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: the ``kept`` best rows of ``docs`` for each row of ``items``.

    Scores are those of the contract: whole numbers, terms of the item with repeats. Equal scores go by ascending doc_id, null
    last. A null or empty text has no term: such a document is never found, such an item finds nothing. Rows that repeat
    an id are rows of their own, in ``docs`` and in ``items``. Empty tables give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "ranked-search")
    item_id = F.col("item_id") if "item_id" in items.columns else F.lit(None).cast("long").alias("item_id")
    asked = stored(items.select(item_id, F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("item")), folder, "items")
    terms = stored(asked.where("text is not null").select("item", "text").mapInArrow(_item_rows, "item long, term long, qtf long"), folder, "item-terms")
    n_terms = terms.select("term").distinct().count()
    vocabulary = None
    if n_terms <= MOST_TERMS:
        vocabulary = np.sort(np.array([r.term for r in terms.select("term").distinct().collect()], np.int64))
    index = build_index(docs, folder, vocabulary)

    whole = index.where("term is null").agg(F.sum("df"), F.sum("words")).first()
    n_docs, n_words = whole[0] or 0, whole[1] or 1
    owner = sum((F.col("df") > share * n_docs).cast("int") for share in STAGE_SHARES)
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df") + 1))).cast("long")
    counts = index.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))
    top = F.expr(f"(1000000000 * most) div (1000 * most + {12 * LEAST_NORM})")
    owned = stored(counts.select("term", weight.alias("weight"), top.alias("top"), owner.alias("stage")).where("weight > 0"), folder, "owners")

    bundles = -(-max(asked.count(), 1) // BUNDLE_ITEMS)
    gain = F.col("weight") * F.col("qtf")
    packed = terms.join(owned, "term").groupBy("item").agg(F.collect_list(F.struct("term", gain.alias("gain"), (gain * F.col("top")).alias("top"), "stage")).alias("t"))
    packed = packed.select(
        F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle"), "item",
        *[F.col(f"t.{a}").alias(b) for a, b in (("term", "terms"), ("gain", "gains"), ("top", "tops"), ("stage", "stages"))],
        F.lit(b"").alias("places"), F.lit(b"").alias("scores"),
    )
    packed = stored(packed, folder, "bundles")
    all_bundles = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    blocks = index.where("term is null").select("block", all_bundles)
    held = packed.agg(F.coalesce(F.sum(F.size("terms") * 28 + 64), F.lit(0))).first()[0]
    carried = blocks.join(F.broadcast(packed) if held <= SENT_BYTES else packed, "bundle")
    carried = carried.select("block", *[c for c in packed.columns])

    last = len(STAGE_SHARES)
    for stage in range(last + 1):
        lists = index.join(owned.where(F.col("stage") == stage).select("term"), "term", "left_semi").unionByName(index.where("term is null"))
        postings = lists.select(F.col("block").alias("block"), all_bundles, "term", "first", "second", "third")  # a column of its own
        visit = _visit(stage, last, n_docs, n_words, kept)
        pairs = carried.groupBy("block", "bundle").cogroup(postings.groupBy("block", "bundle"))
        carried = pairs.applyInArrow(visit, _BUNDLE if stage < last else _FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = carried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kept)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards, which are scanned in a cycle, all lengths of phrases at once. Words are counted from the first
shard on. A longer phrase becomes active when both phrases it extends (without its last and without its first word) have
reached the threshold, is counted from the next shard on, and is done after one full cycle: then its count is that of the whole
corpus. A phrase that never becomes active can't reach the threshold.

Phrases are told apart by 64-bit hashes over language and words. Tasks sum equal phrases and hand each owner its keys as one
row; the owner merges them into its sorted arrays in the shared folder, a new file for each step, so a task that
runs again finds what it found before. Which phrases have reached the threshold is sent as a table of ``SLOTS`` bytes for
each length, whatever the size of the corpus: the step at which the first phrase of the slot reached it. Phrases that
share a slot are counted too early or in vain, for a whole cycle all the same; that costs time and changes no count.
When counting is over, the texts of the phrases above the threshold are looked up, shard by shard, until all are found.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b
from math import log2

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilog.llm.runs import separators, text_runs
from vigilog.llm.shared import stored, work_folder
from vigilog.llm.words import as_bytes, mixed, pieces

# Marks and line ends part pieces, spaces and tabs part words.
ENDS = separators([(0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])
BREAKS = ENDS | separators([(0x09, 0x09), (0x20, 0x20)])
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
NO_LANG = "und"

LEAST = 10
LONGEST = 3
TOP = 2000
SHARDS = 4
OWNER_BYTES = 32 << 20  # of text for each owner, on average
MOST_OWNERS = 1 << 15
SLOTS = 1 << 23
TEXT_SLOTS = 1 << 26  # bits
NEVER = 255
HELD = 3_000_000  # phrases counted at once by a task
HELD_TEXT = 8 << 20  # bytes of texts held at once by a task, and keys of those it has sent
HELD_KEYS = 8_000_000
SALTS = 32
_JOIN = np.uint64(0xD6E8FEB86659FD93)

_COUNTED = "owner int, length int, keys binary, counts binary"
_TEXTS = "owner int, lang string, size long, texts binary"
_PHRASE = "key long, a long, lang string, phrase string, lefts array<long>, rights array<long>, inner array<long>"
_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"

Array = np.ndarray


def _packed(values: Array) -> bytes:
    """Whole numbers byte by byte, the first bytes of all before the second ones, compressed: small numbers take next to nothing."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> Array:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1).astype(np.int64)


def _packed_keys(keys: Array) -> bytes:
    """Sorted keys as differences."""
    return _packed(np.diff(keys, prepend=np.int64(0)))


def _unpacked_keys(blob: bytes) -> Array:
    return np.cumsum(_unpacked(blob))


def _save(folder: str, step: int, owner: int, state: list[Array]) -> None:
    """An owner's file of a step, written under a name of its own and then moved in place."""
    n = len(state) // 2
    parts = [_packed_keys(x) for x in state[:n]] + [_packed(x) for x in state[n:]]
    store, place = fs.FileSystem.from_uri(f"{folder}/step-{step}")
    store.create_dir(place, recursive=True)
    own = f"{place}/.{owner}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(np.array([len(x) for x in parts], "<u8").tobytes())
        for part in parts:
            out.write(part)
    store.move(own, f"{place}/{owner}")


def _load(folder: str, step: int, owner: int, longest: int) -> list[Array]:
    """Keys of every length, then their counts; empty before the first step."""
    if step < 0:
        return [np.empty(0, np.int64)] * (2 * longest)
    store, place = fs.FileSystem.from_uri(f"{folder}/step-{step}")
    with store.open_input_stream(f"{place}/{owner}") as file:
        sizes = np.frombuffer(file.read(16 * longest), "<u8").tolist()
        blobs = [file.read(size) for size in sizes]
    return [_unpacked_keys(x) for x in blobs[:longest]] + [_unpacked(x) for x in blobs[longest:]]


def _slots(keys: Array, owners: int, slots: int) -> Array:
    """The slot of each key; an owner's keys have adjoining slots."""
    own = slots // owners
    return (keys & (owners - 1)) * own + ((keys >> 20) & (own - 1))


def _summed(keys: Array, counts: Array | None = None) -> tuple[Array, Array]:
    """Different keys in order, and how often each occurs or the sum of its counts."""
    if counts is None:
        found, n = np.unique(keys, return_counts=True)
        return found, n.astype(np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[firsts], np.add.reduceat(counts[order], firsts) if len(keys) else np.empty(0, np.int64)


def _grams(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[tuple]:
    """For groups of whole texts: bytes, starts, ends, the text of each word, and per length keys and whether one piece holds all.

    The key of length k at a word is that of the k words from there on.
    """
    seeds: dict[str, int] = {}
    for batch in pieces(batches, "text"):
        langs = batch.column("lang").to_pylist()
        for lang in set(langs) - seeds.keys():
            seeds[lang] = int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")
        seed = np.array([seeds[x] for x in langs], np.uint64)
        for first, data, hashes, starts, ends, bounds in text_runs(as_bytes(batch.column("text")), BREAKS):
            text = np.repeat(np.arange(first, first + len(bounds) - 1), np.diff(bounds))
            words = mixed(hashes ^ seed[text])
            piece = np.searchsorted(np.flatnonzero(ENDS[data]), starts)
            keys, whole = [words], [np.ones(len(words), bool)]
            for k in range(1, longest):
                n = max(len(words) - k, 0)
                keys.append(mixed(keys[-1][:n] * _JOIN + words[k : k + n]))
                whole.append(piece[:n] == piece[k : k + n])
            yield data, starts, ends, text, langs, [x.view(np.int64) for x in keys], whole


def _count(step: int, shards: int, longest: int, owners: int, slots: int, sent) -> Callable:
    """Counts a shard's active phrases of every length; a row for each owner and length whenever enough are held."""

    def active(keys: list[Array], whole: list[Array], tables: list[Array]) -> Iterator[Array]:
        if step < shards:
            yield keys[0]
        else:
            yield keys[0][:0]
        for k in range(1, len(keys)):
            reached = tables[k - 1][_slots(keys[k - 1], owners, slots)].astype(np.int16)
            n = len(keys[k])
            start = np.maximum(reached[:n], reached[1 : n + 1]) + 1
            yield keys[k][whole[k] & (start <= step) & (step < start + shards)]

    def rows(held: list[list[Array]]) -> Iterator[pa.RecordBatch]:
        out = []
        for length, parts in enumerate(held, 1):
            keys, counts = _summed(np.concatenate([*parts, np.empty(0, np.int64)]))
            order = np.argsort(keys & (owners - 1), kind="stable")
            keys, counts = keys[order], counts[order]
            own = keys & (owners - 1)
            cuts = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if b > a:
                    out.append((int(own[a]), length, _packed_keys(keys[a:b]), _packed(counts[a:b])))
        if out:
            columns = list(zip(*out, strict=True))
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["owner", "length", "keys", "counts"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(np.frombuffer(zlib.decompress(sent.value), np.uint8).reshape(longest - 1, slots))
        held: list[list[Array]] = [[] for _ in range(longest)]
        size = 0
        for *_, keys, whole in _grams(batches, longest):
            for parts, found in zip(held, active(keys, whole, tables), strict=True):
                if len(found):
                    parts.append(found)
                    size += len(found)
            if size >= HELD:
                yield from rows(held)
                held, size = [[] for _ in range(longest)], 0
        yield from rows(held)

    return count


def _merge(folder: str, step: int, longest: int, owners: int, slots: int, least: int) -> Callable:
    """What an owner does with its rows of a step: new arrays, and the slots that have reached the threshold, a bit each."""
    own = slots // owners

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        owner = key[0].as_py()
        state = _load(folder, step - 1, owner, longest)
        new: list[list[tuple]] = [[] for _ in range(longest)]
        for r in rows.to_pylist():
            if r["length"]:
                new[r["length"] - 1].append((_unpacked_keys(r["keys"]), _unpacked(r["counts"])))
        bits = []
        for k in range(longest):
            if new[k]:
                keys = np.concatenate([state[k], *[x[0] for x in new[k]]])
                counts = np.concatenate([state[longest + k], *[x[1] for x in new[k]]])
                state[k], state[longest + k] = _summed(keys, counts)
            if k < longest - 1:
                reached = np.zeros(own, bool)
                reached[_slots(state[k][state[longest + k] >= least], owners, slots) - owner * own] = True
                bits.append(np.packbits(reached).tobytes())
        _save(folder, step, owner, state)
        return pa.table({"owner": pa.array([owner], pa.int32()), "bits": pa.array([b"".join(bits)], pa.binary())})

    return merge


def _frequent(folder: str, step: int, longest: int, least: int) -> Callable:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner in batch.column(0).to_pylist():
                state = _load(folder, step, owner, longest)
                for k in range(longest):
                    often = state[longest + k] >= least
                    keys = state[k][often]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), k + 1, np.int32)), pa.array(state[longest + k][often])], ["key", "length", "n"])

    return rows


def _texts(longest: int, owners: int, slots: int, sent) -> Callable:
    """The phrases of two words and more whose slot is wanted: for each owner and language their sorted texts, each once."""
    schema = pa.schema([("owner", pa.int32()), ("lang", pa.string()), ("size", pa.int64()), ("texts", pa.binary())])
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

    def blobs(held: dict[tuple[int, str], list[bytes]]) -> Iterator[pa.RecordBatch]:
        rows = [(*key, b"\n".join(sorted(phrases))) for key, phrases in held.items()]
        if rows:
            owner, lang, texts = zip(*rows, strict=True)
            packed = [pa.compress(x, codec="zstd", asbytes=True) for x in texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((owner, lang, map(len, texts), packed), schema.types, strict=True)], schema=schema)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(zlib.decompress(sent.value), np.uint8), bitorder="little").view(bool)
        seen, held, size = np.empty(0, np.int64), {}, 0
        for data, starts, ends, text, langs, keys, whole in _grams(batches, longest):
            raw, mine = data.tobytes().translate(lower), [seen]
            for k in range(1, longest):
                places = np.flatnonzero(whole[k] & wanted[_slots(keys[k], owners, slots)])
                found, first = np.unique(keys[k][places], return_index=True)
                new = ~np.isin(found, seen, assume_unique=True)
                found, at = found[new], places[first[new]]
                mine.append(found)
                spans = [zip(starts[at + i].tolist(), ends[at + i].tolist(), strict=True) for i in range(k + 1)]
                own = (found & (owners - 1)).tolist()
                for owner, i, words in zip(own, text[at].tolist(), zip(*spans, strict=True), strict=True):
                    phrase = b" ".join([raw[a:b] for a, b in words])
                    held.setdefault((owner, langs[i]), []).append(phrase)
                    size += len(phrase)
            seen = np.sort(np.concatenate(mine))
            if size >= HELD_TEXT:
                yield from blobs(held)
                held, size = {}, 0
            if len(seen) > HELD_KEYS:  # a phrase may be sent twice by a task
                seen = np.empty(0, np.int64)
        yield from blobs(held)

    return rows


def _parts_of(counts: Callable[[int], list[Array]], longest: int, least: int) -> Callable:
    """An owner's different texts with the keys of each and of its parts, and its count; those below the threshold go.

    ``counts`` loads an owner's arrays.
    """
    lists = pa.list_(pa.int64())
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("lefts", lists), ("rights", lists), ("inner", lists)])

    def rows(key: tuple[pa.Scalar, ...], blobs: pa.Table) -> pa.Table:
        lang, state = key[1].as_py(), counts(key[0].as_py())
        sent = zip(blobs.column("size").to_pylist(), blobs.column("texts"), strict=True)
        texts = [pa.array(pa.decompress(x.as_py(), n, codec="zstd", asbytes=True).split(b"\n"), pa.binary()) for n, x in sent]
        phrases = pa.chunked_array(texts).unique().to_pylist()
        batch = pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary())], ["lang", "text"])
        out, at = [], 0
        for _, _, _, text, _, keys, _ in _grams([batch], longest):
            n = np.bincount(text - text[0])  # no phrase is without a word
            starts, own = np.cumsum(n) - n, phrases[at : at + len(n)]
            at += len(n)
            for k in range(1, longest):
                of = np.flatnonzero(n == k + 1)
                found = keys[k][starts[of]]
                at_key = np.minimum(np.searchsorted(state[k], found), max(len(state[k]) - 1, 0))
                often = (state[k][at_key] == found) & (state[longest + k][at_key] >= least) if len(state[k]) else np.zeros(len(of), bool)
                of, a = of[often], state[longest + k][at_key[often]]
                place = starts[of]
                lefts = np.stack([keys[c][place] for c in range(k)], 1)
                rights = np.stack([keys[k - 1 - c][place + c + 1] for c in range(k)], 1)
                inner = [keys[m][place + i] for m in range(1, k) for i in range(k + 1 - m)]
                inner = np.stack(inner, 1) if inner else np.empty((len(of), 0), np.int64)
                arrays = []
                for part in (lefts, rights, inner):
                    offsets = pa.array(np.arange(len(of) + 1, dtype=np.int32) * part.shape[1])
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(part.ravel())))
                names = pa.array([own[i].decode() for i in of.tolist()], pa.string())
                out.append(pa.Table.from_arrays([pa.array(keys[k][place]), pa.array(a), pa.array([lang] * len(of), pa.string()), names, *arrays], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return rows


def count_phrases(shards: DataFrame, folder: str, n_shards: int, owners: int, longest: int, least: int, slots: int = SLOTS) -> tuple[DataFrame, Callable[[int], list[Array]]]:
    """``key``, ``length`` and ``n`` of all phrases of up to ``longest`` words with ``n`` >= ``least``, and what loads an owner's counts."""
    spark = shards.sparkSession
    states = f"{folder}/owners"
    tables = np.full((longest - 1, slots), NEVER, np.uint8)
    none = spark.range(owners, numPartitions=1).selectExpr("cast(id as int) owner", "0 length", "cast(null as binary) keys", "cast(null as binary) counts")
    step, own, last = 0, slots // owners, n_shards - 1
    while step <= last:
        sent = spark.sparkContext.broadcast(zlib.compress(tables.tobytes(), 1))
        shard = shards.where(F.col("shard") == step % n_shards).select("lang", "text")
        counted = shard.mapInArrow(_count(step, n_shards, longest, owners, slots, sent), _COUNTED).union(none)
        merged = counted.groupBy("owner").applyInArrow(_merge(states, step, longest, owners, slots, least), "owner int, bits binary")
        for row in merged.collect():  # SLOTS bits for each length
            reached = np.unpackbits(np.frombuffer(row.bits, np.uint8)).reshape(longest - 1, own).astype(bool)
            part = tables[:, row.owner * own : (row.owner + 1) * own]
            part[reached & (part == NEVER)] = step
        sent.destroy()
        if step:
            store, place = fs.FileSystem.from_uri(f"{states}/step-{step - 1}")
            store.delete_dir(place)
        if (tables != NEVER).any():
            last = max(last, int(tables[tables != NEVER].max()) + n_shards)
        step += 1
    final = spark.range(owners, numPartitions=max(1, min(owners, 1000))).mapInArrow(_frequent(states, step - 1, longest, least), "key long, length int, n long")
    last_step = step - 1
    return stored(final, folder, "frequent"), lambda owner: _load(states, last_step, owner, longest)


def _marked(keys: DataFrame, owners: int, slots: int) -> Array:
    """The slots of keys as bits; what reaches the driver are bitmaps of ``slots`` bits together."""
    own = slots // owners
    slot = F.col("key").bitwiseAND(owners - 1) * own + F.shiftright("key", 20).bitwiseAND(own - 1) + 1  # bitmaps count from 1
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    out = np.zeros(max(slots, 1 << 15) // 8, np.uint8)
    for row in keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(bitmap).collect():
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def find_texts(shards: DataFrame, frequent: DataFrame, folder: str, counts: Callable, n_shards: int, owners: int, longest: int, least: int, slots: int = TEXT_SLOTS) -> DataFrame:
    """The ``frequent`` phrases of two words and more with language, text and parts; shards are read until all are found."""
    spark = shards.sparkSession
    missing, found = frequent.where("length > 1").select("key"), None
    for i in range(n_shards):
        bits = _marked(missing, owners, slots)
        if not bits.any():
            break
        sent = spark.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1))
        texts = shards.where(F.col("shard") == i).select("lang", "text").mapInArrow(_texts(longest, owners, slots, sent), _TEXTS)
        part = texts.groupBy("owner", "lang").applyInArrow(_parts_of(counts, longest, least), _PHRASE)
        if i:  # a phrase of an earlier shard can share its slot with one that is still missing
            part = part.join(missing, "key", "left_semi")
        part = stored(part, folder, f"texts-{i}")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
        missing = stored(missing.join(part.select("key"), "key", "left_anti"), folder, f"missing-{i}")
    return found if found is not None else spark.createDataFrame([], _PHRASE)


def scored(found: DataFrame, frequent: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, those left out that a longer one holds half the time."""
    parts = frequent.select("key", "n")
    cuts = found.select("key", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    sides = cuts.select("key", "a", "k", F.col("cut.lefts").alias("left"), F.col("cut.rights").alias("right"))
    sides = sides.join(parts.withColumnsRenamed({"key": "left", "n": "l"}), "left").join(parts.withColumnsRenamed({"key": "right", "n": "r"}), "right")
    whole = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")}
    score = F.expr("(cast(1000000 as decimal(38,0)) * wa * wa) div (wl * wr)")
    sides = sides.withColumns({f"w{c}": w for c, w in whole.items()}).withColumn("score", score)
    lowest = sides.groupBy("key").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("key", "cut.score", "cut.l", "cut.r")
    covered = found.select(F.explode("inner").alias("key"), "a").groupBy("key").agg(F.max("a").alias("longer"))
    kept = found.select("key", "lang", "phrase", "a").join(covered, "key", "left").where("longer is null or 100 * longer < 50 * a")
    rows = kept.join(lowest, "key").join(totals.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"))
    # A language is cut in parts first, so that not the best of every task meet in one.
    rows = rows.withColumn("salt", F.pmod("key", F.lit(SALTS)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    cut = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = cut.withColumn("rank", last.cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, n_shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase lies within a piece; ``a`` is how often, ``l`` and ``r`` how often the parts at its worst cut, ``n`` the words of
    the language. Only A-Z are lower-cased. A null text has no words, a null lang counts as ``und``. Repeated rows count
    each. Equal scores go by ``a`` and then by the phrase's bytes. An empty table gives no rows. A table without the
    column lang is ``und`` throughout; other columns are ignored.
    """
    if not 2 <= longest <= 8 or n_shards * longest >= NEVER:
        raise ValueError("phrases have 2 to 8 words, and so many shards that all steps fit into a byte")
    spark = docs.sparkSession
    folder = work_folder(spark, "phrases")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)) if "lang" in docs.columns else F.lit(NO_LANG)
    texts = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    texts = texts.select("*", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), F.octet_length("text").cast("long").alias("bytes"))
    dealt = texts.where("words > 0").withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(n_shards)).cast("int"))
    path = f"{folder}/shards"
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    shards = spark.read.schema(dealt.schema).parquet(path)
    size = shards.agg(F.sum("bytes")).first()[0]
    if not size:
        return spark.createDataFrame([], _RESULT)
    owners = 1 << min(int(log2(MOST_OWNERS)), max(3, round(log2(max(1, size / OWNER_BYTES)))))
    totals = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    frequent, counts = count_phrases(shards, folder, n_shards, owners, longest, least, slots)
    return scored(find_texts(shards, frequent, folder, counts, n_shards, owners, longest, least, 8 * slots), frequent, totals, top)

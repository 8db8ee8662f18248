from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from vigilog.llm import kd_shards as kd
from vigilog.llm.kd_shards import kd_shards, shard_digests


def check(docs, found, shards):
    rows = docs.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == want
    slots: dict[int, list] = {}
    for r in found:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = shard_digests(docs).collect()
    check(docs, found, 40)
    weights: dict[int, int] = {}
    for r in found:
        weights[r.shard] = weights.get(r.shard, 0) + r.size
    assert len(weights) == 40 and max(weights.values()) - min(weights.values()) <= max(r.size for r in found)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_any_number_of_shards(documents, shards):
    check(documents, kd_shards(documents, shards=shards).collect(), shards)


def test_target_bytes(documents):
    size = documents.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    assert kd_shards(documents, target_bytes=size // 6 + 1).select("shard").distinct().count() == 6


def test_ties_on_every_dimension(spark):
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"))
    found = kd_shards(docs, shards=8, dimensions=("lang",)).groupBy("shard").count().collect()
    assert len(found) == 8 and max(r["count"] for r in found) - min(r["count"] for r in found) <= 2


def test_awkward_rows(awkward, empty):
    check(awkward, shard_digests(awkward).collect(), 40)
    assert shard_digests(empty).count() == 0


def brute_tree(rows, dimensions, leaves, first=0):
    """The shard of every row (a dict of keys and size), cutting sorted lists at the weighted share nearest to the target."""
    if leaves == 1 or not rows:
        return {r["i"]: first for r in rows}
    extent = {d: max(r[d] >> 32 for r in rows) - min(r[d] >> 32 for r in rows) for d in dimensions}
    d = max(dimensions, key=lambda x: extent[x])
    half, total, below, n = leaves // 2, sum(r["size"] for r in rows), 0, 0
    ordered, target = sorted(rows, key=lambda r: r[d]), total * (leaves // 2) / leaves
    for r in ordered:
        if below + r["size"] >= target:
            n += target - below > below + r["size"] - target
            break
        below, n = below + r["size"], n + 1
    return brute_tree(ordered[:n], dimensions, half, first) | brute_tree(ordered[n:], dimensions, leaves - half, first + half)


@pytest.mark.parametrize("shards", [2, 5, 16, 40])
def test_the_tree_against_sorted_lists(documents, shards):
    dimensions = kd.DIMENSIONS
    rows = [r.asDict() for r in kd.metadata(documents, dimensions).collect()]
    for i, r in enumerate(rows):
        r["i"] = i
    for d in dimensions:
        low, high = (f(r[f"d_{d}"] for r in rows) for f in (min, max))
        scale = kd.GRID / (high - low) if high > low else 0.0
        for r in rows:
            r[f"k_{d}"] = (int((r[f"d_{d}"] - low) * scale) << kd.TIE_BITS) + r["tie"]
    want = brute_tree(rows, [f"k_{d}" for d in dimensions], shards)
    found = {r.doc_id: r.shard for r in kd_shards(documents, shards=shards).collect()}
    assert found == {r["doc_id"]: want[r["i"]] for r in rows} and len(found) == len(rows)

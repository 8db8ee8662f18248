"""K-d tree shards of near-equal bytes, by native aggregates alone.

Each metadata column becomes a grid of whole numbers, and a hash of the row breaks its ties, so any column can be cut at
any weight. On every level, a node is cut along its widest dimension where the weight below comes closest to its
share. The cut is found for all nodes of a level at once from histograms of summed bytes, refined until a bucket holds
next to nothing; what reaches the driver are bucket sums, as many as nodes times ``BUCKETS`` and independent of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilog.llm.shared import stored, work_folder

DIMENSIONS = ("n_chars", "doc_id", "lang", "source")
BUCKETS = 512
GRID = (1 << 30) - 1
TIE_BITS = 32
FINE = 1e-5  # of a leaf's bytes: a bucket below this is not refined
SLOT_ROWS = 50_000
ROW_BYTES = 16


@dataclass
class Node:
    """``leaves`` to be made; an inner node has the key below which rows go to ``low``."""

    leaves: int
    first: int
    dimension: str = ""
    cut: int = 0
    low: Node | None = None
    high: Node | None = None


def metadata(docs: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``tie`` and a number for every dimension; text is read in this pass alone."""
    numbers = []
    for name in dimensions:
        value = docs[name] if docs.schema[name].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") else F.crc32(docs[name].cast("string"))
        numbers.append(F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"d_{name}"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    crc = F.crc32(text)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        crc.alias("text_crc32"),
        F.xxhash64("doc_id", crc).bitwiseAND((1 << TIE_BITS) - 1).alias("tie"),
        *numbers,
    )


def _leaf_of(node: Node, value) -> Column:
    """The value of the leaf a row falls into, as nested conditions on its keys."""
    if node.low is None:
        return F.lit(value(node))
    return F.when(F.col(f"k_{node.dimension}") < node.cut, _leaf_of(node.low, value)).otherwise(_leaf_of(node.high, value))


def _open(node: Node) -> list[Node]:
    if node.low is None:
        return [node] if node.leaves > 1 else []
    return _open(node.low) + _open(node.high)


def _per_node(values: dict[int, int], leaves: int) -> Column:
    """The value of the row's node: an element of a constant array."""
    return F.get(F.array(*[F.lit(values.get(i, 0)).cast("long") for i in range(leaves)]), F.col("node"))


def kd_tree(rows: DataFrame, dimensions: tuple[str, ...], leaves: int) -> Node:
    """The tree over rows with ``size`` and a key ``k_`` for each dimension."""
    root = Node(leaves, 0)
    while nodes := _open(root):
        placed = rows.withColumn("node", _leaf_of(root, lambda n: n.first))
        extents = placed.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *[f(F.shiftright(f"k_{d}", TIE_BITS)).alias(f"{n}_{d}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max))],
        )
        extents = {r["node"]: r for r in extents.collect()}
        low, width, below, target, chosen = {}, {}, {}, {}, {}
        for n in nodes:
            e = extents.get(n.first)
            chosen[n.first] = max(dimensions, key=lambda d: (e[f"hi_{d}"] - e[f"lo_{d}"]) if e else 0)
            d = chosen[n.first]
            low[n.first] = (e[f"lo_{d}"] << TIE_BITS) if e else 0
            span = (((e[f"hi_{d}"] + 1) << TIE_BITS) - low[n.first]) if e else 1
            width[n.first] = max(1, ceil(span / BUCKETS))
            below[n.first], target[n.first] = 0, (e["bytes"] if e else 0) * (n.leaves // 2) / n.leaves
        todo = [n for n in nodes if n.first in extents]
        fine = FINE * (sum(e["bytes"] for e in extents.values()) / leaves)
        cuts = {n.first: 0 for n in nodes}
        while todo:
            at = _per_node({n.first: dimensions.index(chosen[n.first]) for n in todo}, leaves).cast("int")
            keyed = placed.where(_per_node({n.first: 1 for n in todo}, leaves) == 1).select(
                "node", "size", F.get(F.array(*[f"k_{d}" for d in dimensions]), at).alias("key"), _per_node(low, leaves).alias("lo"), _per_node(width, leaves).alias("width")
            )
            bucket = F.expr("(key - lo) div width")
            sums = keyed.where(f"key >= lo and (key - lo) div width < {BUCKETS}").groupBy("node", bucket.alias("bucket")).agg(F.sum("size").alias("w"))
            found: dict[int, list] = {}
            for r in sums.collect():
                found.setdefault(r["node"], []).append((r["bucket"], r["w"]))
            again = []
            for n in todo:
                i = n.first
                for bucket, w in sorted(found[i]):
                    start = low[i] + bucket * width[i]
                    if below[i] + w < target[i]:
                        below[i] += w
                        continue
                    if width[i] == 1 or w <= fine:
                        nearer = target[i] - below[i] > below[i] + w - target[i]
                        cuts[i] = start + width[i] if nearer else start
                    else:
                        low[i], width[i] = start, ceil(width[i] / BUCKETS)
                        again.append(n)
                    break
                else:
                    cuts[i] = low[i] + BUCKETS * width[i]
            todo = again
        for n in nodes:
            n.dimension, n.cut = chosen[n.first], cuts[n.first]
            half = n.leaves // 2
            n.low, n.high = Node(half, n.first), Node(n.leaves - half, n.first + half)
    return root


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in a shard) for every row of ``docs``.

    Leaves are cut until there are ``shards``, or until they hold ``target_bytes`` on average. Dimensions that the table
    lacks are left out; without any, the hash of the row alone is cut. A null text has no bytes and the checksum of
    the empty text; null or NaN metadata counts as 0; equal rows have equal keys and stay together, rows that differ in
    id or text can be parted. An empty table gives no rows. Other columns are ignored.
    """
    folder = work_folder(docs.sparkSession, "kd-shards")
    dimensions = tuple(d for d in dimensions if d in docs.columns)
    rows = stored(metadata(docs, dimensions), folder, "metadata")
    seen = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *[f(f"d_{d}").alias(f"{k}_{d}") for d in dimensions for k, f in (("lo", F.min), ("hi", F.max))]).first()
    leaves = shards or max(1, ceil((seen["bytes"] or 0) / target_bytes))
    grids = []
    for d in dimensions:
        lo, hi = seen[f"lo_{d}"] or 0.0, seen[f"hi_{d}"] or 0.0
        scale = GRID / (hi - lo) if hi > lo else 0.0
        grids.append((F.shiftleft(((F.col(f"d_{d}") - lo) * scale).cast("long"), TIE_BITS) + F.col("tie")).alias(f"k_{d}"))
    if not grids:
        grids, dimensions = [F.col("tie").alias("k_tie")], ("tie",)
    keyed = stored(rows.select("doc_id", "size", "text_crc32", "tie", *grids), folder, "keys")
    tree = kd_tree(keyed, dimensions, leaves) if seen["n"] else Node(1, 0)
    parts = 1 + seen["n"] // SLOT_ROWS
    placed = keyed.select("doc_id", "size", "text_crc32", "tie", _leaf_of(tree, lambda n: n.first).cast("int").alias("shard"), F.pmod("tie", F.lit(parts)).alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "part", F.coalesce(ahead, F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "part").orderBy("tie", "doc_id", "text_crc32")
    numbered = placed.withColumn("i", F.row_number().over(order)).join(offsets, ["shard", "part"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("i") - 1).alias("slot"))


def shard_digests(docs: DataFrame, shards: int = 40) -> DataFrame:
    placed = kd_shards(docs, shards=shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

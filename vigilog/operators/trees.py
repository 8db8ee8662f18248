"""Trees of any depth: rows are dealt by tree, and on large tables by the leaf of a first tree, and each group is grown to the end.

A bag is a weight for every row and tree, drawn from a hash, so it is the same whenever a task runs again. A table of up to
``LOCAL_ROWS`` rows makes one group for each tree. On a larger one every tree has a top, in whose leaves its bag has no more rows
than that: all tops grow at once, a level for each pass over the rows, from histograms of the columns the nodes draw. Rows are
dealt to groups in packed runs, equal ones summed. A group is grown node by node: the best threshold of a random choice of columns,
until nothing is left to part. What is done row by row is done by the tasks of ``Trees.java``; ``grown`` grows the same trees by
numpy, some ten times slower, and is what tests hold them against.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators.jvm import map_partitions, spec

LOCAL_ROWS = 200_000

#: Quantiles of a column over the whole table, between which tops part rows.
QUANTILES = 127

#: Bytes of histograms that a task holds; further nodes wait for a further pass.
HISTOGRAM_BYTES = 32 << 20

#: Most partitions that groups are dealt to.
MOST_PARTITIONS = 8192

_BITS = 52

#: Chances of being drawn 0 to 5 times in a bag as large as the table (Poisson), summed up.
_DRAWN = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120)])

GROUP_SCHEMA = "tree int, leaf bigint, nodes int, feature binary, threshold binary, child binary, value binary, shares binary"

TOP_SCHEMA = "tree int, feature binary, threshold binary, child binary"
_DEALT = "tree int, leaf bigint, blob binary"
_SPLIT = "tree int, node int, found boolean, column int, edge int, rows_left bigint, rows_right bigint"

Array = np.ndarray


def bag_draw(row: Column, tree: Column, seed: int) -> Column:
    """A number of ``_BITS`` bits for a row and a tree."""
    return F.xxhash64(row, tree, F.lit(seed)).bitwiseAND((1 << _BITS) - 1)


def bag_weight(row: Column, tree: Column, seed: int) -> Column:
    """How often a row is in the bag of a tree."""
    draw = bag_draw(row, tree, seed) / float(1 << _BITS)
    return sum((draw >= float(chance)).cast("int") for chance in _DRAWN[:-1])


def _by_node_and_code(node: Array, code: Array) -> tuple[Array, Array, Array]:
    """Nodes and codes in order, and the places where they stood: as one packed number where that has room."""
    bits = [int(a.max(initial=0)).bit_length() for a in (node, code)] + [len(node).bit_length()]
    if sum(bits) > 63:
        order = np.lexsort((code, node))
        return node[order], code[order], order
    packed = (((node.astype(np.int64) << bits[1]) | code) << bits[2]) | np.arange(len(node))
    packed.sort()
    order = packed & ((1 << bits[2]) - 1)
    packed >>= bits[2]
    return packed >> bits[1], packed & ((1 << bits[1]) - 1), order


def _starts(*keys: Array) -> Array:
    """Where runs of equal keys begin."""
    changed = np.zeros(max(0, len(keys[0]) - 1), bool)
    for key in keys:
        changed |= key[1:] != key[:-1]
    return np.flatnonzero(np.concatenate([[True], changed])) if len(keys[0]) else np.empty(0, np.int64)


def _splits(codes: Array, y: Array, w: Array, at: Array, node: Array, counts: Array, features: Array, at_least: int) -> tuple[Array, Array, Array, Array]:
    """For each node the column and the two codes next to each other that part its classes best, and whether there are any.

    ``codes`` holds the rank of each value by column and row; rows ``at`` lie in ``node``. Columns are tried in the node's own
    order: ``at_least`` of them, and more while none of them can be parted. The sums of the squared counts left and right of a row
    grow by a term that takes the weight of its own class before it alone.
    """
    nodes = len(counts)
    best, column = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
    low, high = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    weight, squares = counts.sum(1), (counts**2).sum(1)
    for slot in range(features.shape[1]):
        open_nodes = np.ones(nodes, bool) if slot < at_least else np.isinf(best)
        if not open_nodes.any():
            break
        rows, of = (at, node) if open_nodes.all() else (at[open_nodes[node]], node[open_nodes[node]])
        of, code, order = _by_node_and_code(of, codes[features[of, slot], rows])
        cls, own = y[rows[order]], w[rows[order]]
        by_class = np.argsort(cls, kind="stable")
        mine = own[by_class]
        sums = np.cumsum(mine) - mine
        firsts = _starts(cls[by_class], of[by_class])
        before = np.empty(len(own))
        before[by_class] = sums - np.repeat(sums[firsts], np.diff(np.append(firsts, len(own))))
        places = np.flatnonzero((of[1:] == of[:-1]) & (code[1:] > code[:-1]))
        if not len(places):
            continue
        firsts, at_node = _starts(of), of[places]
        left, left_squares, both = (
            np.cumsum(term)[places] - np.bincount(of[firsts], np.concatenate([[0.0], np.cumsum(term)[firsts[1:] - 1]]), nodes)[at_node]
            for term in (own, own * (2 * before + own), own * counts[of, cls])
        )
        score = left_squares / left + (squares[at_node] - 2 * both + left_squares) / (weight[at_node] - left)
        groups = _starts(at_node)
        most = np.maximum.reduceat(score, groups)
        winners = np.flatnonzero(score == np.repeat(most, np.diff(np.append(groups, len(score)))))
        winners = winners[_starts(at_node[winners])]
        found = at_node[winners]
        better = score[winners] > best[found]
        found, winners = found[better], winners[better]
        best[found], column[found] = score[winners], features[found, slot]
        low[found], high[found] = code[places[winners]], code[places[winners] + 1]
    return column, low, high, ~np.isinf(best)


class _Ranks:
    """The values of each column in order, and the rank of each row's."""

    def __init__(self, x: Array):
        values, codes = zip(*[np.unique(column, return_inverse=True) for column in x.T], strict=True)
        self.codes = np.stack([c.astype(np.int32) for c in codes])
        self.values, self.begins = np.concatenate(values), np.cumsum([0, *map(len, values)])[:-1]

    def cut(self, column: Array, low: Array, high: Array) -> Array:
        """The threshold halfway between two values of a column."""
        low, high = self.values[self.begins[column] + low], self.values[self.begins[column] + high]
        middle = low + (high - low) / 2
        return np.where(middle < high, middle, low)


def _best_splits(x: Array, y: Array, w: Array, node: Array, counts: Array, features: Array, at_least: int) -> tuple[Array, Array, Array]:
    """For each node the column and threshold that part its classes best, and whether there is one."""
    ranks = _Ranks(x)
    column, low, high, parted = _splits(ranks.codes, y, w, np.arange(len(y)), node, counts, features, at_least)
    return column, np.where(parted, ranks.cut(column, low, np.where(parted, high, low)), 0.0), parted


def _mixed(v: Array) -> Array:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def group_key(seed: int, tree: int, leaf: int) -> int:
    """The key of a group's first node."""
    key = np.zeros(1, np.uint64)
    for number in (seed, tree, leaf):
        key = _mixed(key + np.uint64(number))
    return int(key[0])


def grown(x: Array, y: Array, w: Array, classes: int, columns: int, rng: np.random.Generator | int) -> tuple[Array, Array, Array, Array, Array]:
    """A tree over all rows as arrays by node: column (-1 in a leaf), threshold, left child (the right one follows), value, and shares.

    The value of a leaf is its class; one whose rows can't be parted has the number of its row in ``shares``, as -1, -2 and so on. The
    order in which a node tries columns follows from its key, and the keys of all nodes from the first one's, ``rng`` or drawn from it.
    """
    feature, threshold, child, value, shares = ([] for _ in range(5))
    ranks, width = _Ranks(x), x.shape[1]
    y = y.astype(np.uint16)  # sorted by counting
    at, node, made = np.arange(len(y)), np.zeros(len(y), np.int64), 1
    keys = np.array([rng if isinstance(rng, int) else rng.integers(1 << 63)], np.uint64)
    steps = (np.arange(width, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    while open_nodes := len(keys):
        counts = np.bincount(node * classes + y[at], weights=w[at], minlength=open_nodes * classes).reshape(open_nodes, classes)
        own_feature, own_threshold, own_child = np.full(open_nodes, -1, np.int8), np.zeros(open_nodes), np.zeros(open_nodes, np.int32)
        own_value = counts.argmax(1).astype(np.int32)
        mixed = np.flatnonzero((counts > 0).sum(1) > 1)
        rank = np.full(open_nodes, -1)
        rank[mixed] = np.arange(len(mixed))
        held = np.flatnonzero(rank[node] >= 0)
        at, node = at[held], rank[node[held]]
        order = _mixed(keys[mixed][:, None] + steps).argsort(1, kind="stable")
        column, low, high, parted = _splits(ranks.codes, y, w, at, node, counts[mixed], order, columns)
        own_value[mixed[~parted]] = -1 - len(shares) - np.arange((~parted).sum())
        shares.extend(counts[mixed[~parted]] / counts[mixed[~parted]].sum(1, keepdims=True))
        parts = mixed[parted]
        own_feature[parts], own_threshold[parts] = column[parted], ranks.cut(column[parted], low[parted], high[parted])
        own_child[parts] = made + 2 * np.arange(len(parts))
        made += 2 * len(parts)
        for into, own in ((feature, own_feature), (threshold, own_threshold), (child, own_child), (value, own_value)):
            into.append(own)
        held = np.flatnonzero(parted[node])
        at, node = at[held], node[held]
        rank = np.cumsum(parted) - 1
        right = ranks.codes[column[node], at] > low[node]
        node = 2 * rank[node] + right
        keys = _mixed((2 * keys[parts][:, None] + np.array([1, 2], np.uint64)).ravel())
    joined = [np.concatenate(part) for part in (feature, threshold, child, value)]
    return *joined, np.array(shares, float).reshape(-1, classes)


def summed_rows(x: Array, y: Array) -> tuple[Array, Array]:
    """Places of different rows (features and label), and for each row which of them it equals."""
    mixed = y.astype(np.uint64)
    for column in np.ascontiguousarray(x.T + 0.0).view(np.uint64):  # -0.0 is 0.0
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, first, same = np.unique(mixed, return_index=True, return_inverse=True)
    if np.array_equal(x[first[same]], x) and np.array_equal(y[first[same]], y):
        return first, same
    return np.arange(len(y)), np.arange(len(y))  # two different rows have one hash


def packed(*arrays: Array) -> bytes:
    """Arrays with a number or a row of numbers for each row, as bytes."""
    data = np.array([len(arrays[0])], "<i8").tobytes() + b"".join(np.ascontiguousarray(a.T).tobytes() for a in arrays)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(blob: bytes, *kinds: tuple[str, int]) -> list[Array]:
    """The arrays of ``packed``, by type and numbers in a row; those with 0 are plain ones."""
    data = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n, at, out = int(np.frombuffer(data, "<i8", 1)[0]), 8, []
    for kind, width in kinds:
        values = np.frombuffer(data, kind, n * max(1, width), at)
        out.append(values.reshape(width, n).T if width else values)
        at += values.nbytes
    return out


@dataclass
class Top:
    """The top of a tree: by node the column (-1 in a leaf), threshold and left child; beside them what is open as it grows."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [0])
    open: dict[int, tuple[list[int], int]] = field(default_factory=dict)  # node -> order of its columns, place in it

    def leaves(self, x: Array) -> Array:
        """The node in which each row ends."""
        feature, threshold, child = np.array(self.feature), np.array(self.threshold), np.array(self.child)
        at, todo = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(todo):
            todo = todo[feature[at[todo]] >= 0]
            nodes = at[todo]
            at[todo] = child[nodes] + (x[todo, feature[nodes]] > threshold[nodes])
        return at

    def row(self, tree: int) -> tuple:
        return tree, np.array(self.feature, np.int8).tobytes(), np.array(self.threshold).tobytes(), np.array(self.child, np.int32).tobytes()

    @staticmethod
    def of(row) -> Top:
        parts = zip((row["feature"], row["threshold"], row["child"]), (np.int8, float, np.int32), strict=True)
        return Top(*[np.frombuffer(bytes(part), kind).tolist() for part, kind in parts])


def saved_tops(spark: SparkSession, folder: str) -> dict[int, Top]:
    """The tops of some trees; a node of one stands for some ``LOCAL_ROWS`` rows, so they are small."""
    return {r.tree: Top.of(r) for r in spark.read.schema(TOP_SCHEMA).parquet(folder).collect()}


def matrix(features: pa.Array) -> Array:
    """The rows of an array column as rows of a matrix."""
    return features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1) if len(features) else np.empty((0, 1))


def about_tops(tops: dict[int, Top]) -> list[Array]:
    """Tops as tasks take them: trees, where the nodes of each begin, and the nodes."""
    starts = np.cumsum([0, *[len(top.feature) for top in tops.values()]])
    nodes = [np.concatenate([[], *[getattr(top, part) for top in tops.values()]]) for part in ("feature", "child", "threshold")]
    return [np.array(list(tops)), starts, nodes[0].astype(int), nodes[1].astype(int), nodes[2].astype(float)]


def _about_bags(seed: int) -> list[Array]:
    return [_DRAWN[:-1], np.array([seed])]


def _featured(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Number, features and label of the rows, as tasks take them."""
    return rows.select("row", *features, "label")


def _histograms(rows: DataFrame, tops: dict[int, Top], some: dict[int, list[int]], edges: list[Array], classes: int, columns: int, seed: int) -> DataFrame:
    """For each tree and open node of ``some`` the weights by column of its own, bin and class, and the rows as one class more."""
    growing = {t: tops[t] for t in some}
    cuts = [0 if c < 0 else int(np.searchsorted(edges[c], v)) for top in growing.values() for c, v in zip(top.feature, top.threshold, strict=True)]
    rank = [np.full(len(top.feature), -1) for top in growing.values()]
    drawn = []
    for own, (tree, nodes) in zip(rank, some.items(), strict=True):
        own[nodes] = np.arange(len(nodes))
        for order, place in (tops[tree].open[n] for n in nodes):
            drawn.append((order + [-1] * columns)[place : place + columns])
    sizes = [len(edges), columns, 1 + max(map(len, edges)), classes]
    opened, begins = np.cumsum([0, *map(len, some.values())]), np.cumsum([0, *map(len, edges)])
    about = spec(sizes, *about_tops(growing), *_about_bags(seed), cuts, np.concatenate(rank), opened, np.concatenate(drawn), begins, np.concatenate(edges).astype(float))
    return map_partitions(rows, "Histograms", about, "tree int, blob binary")


def _choose(tops: dict[int, Top], some: dict[int, list[int]], bins: int, classes: int, columns: int) -> Callable:
    """The best split of every node of a tree by its histograms."""

    def choose(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        total, found = 0, []
        for blob in rows.column("blob").to_pylist():
            total = total + np.frombuffer(blob, "<i4").astype(float)
        for node, sums in zip(some[tree], total.reshape(-1, columns, bins, classes + 1), strict=True):
            order, place = tops[tree].open[node]
            left = np.cumsum(sums, axis=1)[:, :-1]
            right = left[:, -1:] + sums[:, -1:] - left
            sides = [side[..., :classes] for side in (left, right)]
            weights = [np.maximum(side.sum(-1), 1e-9) for side in sides]
            score = sum((side**2).sum(-1) / n for side, n in zip(sides, weights, strict=True))
            score[(left[..., classes] == 0) | (right[..., classes] == 0)] = -np.inf
            slot, edge = np.unravel_index(score.argmax(), score.shape)
            there = bool(np.isfinite(score[slot, edge])) and place + slot < len(order)
            found.append((tree, node, there, order[place + slot] if there else -1, int(edge), int(left[slot, edge, classes]), int(right[slot, edge, classes])))
        kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in _SPLIT.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*found, strict=True), kinds, strict=True)})

    return choose


def _edges(rows: DataFrame, features: Sequence[str]) -> list[Array]:
    """Values of each column that part rows: up to its quantiles, and below them."""
    asked = [i / (QUANTILES + 1) for i in range(1, QUANTILES + 1)]
    found = rows.agg(*[F.percentile_approx(f, asked, 10_000).alias(f) for f in features]).first()
    return [np.unique(np.concatenate([found[f], np.nextafter(found[f], -np.inf)])) for f in features]


def _grow_tops(rows: DataFrame, features: Sequence[str], classes: int, trees: range, seed: int) -> dict[int, Top]:
    """The tops of some trees. A node stays open while its bag has more than ``LOCAL_ROWS`` rows and a column that parts them."""
    columns, edges = max(1, int(len(features) ** 0.5)), _edges(rows, features)
    bins = 1 + max(map(len, edges))
    rngs, tops = {t: np.random.default_rng([seed, t]) for t in trees}, {t: Top() for t in trees}

    def drawn(tree: int) -> tuple[list[int], int]:
        return rngs[tree].permutation(len(features)).tolist(), 0

    for tree, top in tops.items():
        top.open[0] = drawn(tree)
    at_once = max(1, HISTOGRAM_BYTES // (4 * columns * bins * (classes + 1)))
    while some := [(t, n) for t, top in tops.items() for n in sorted(top.open)][:at_once]:
        by_tree = {t: [n for u, n in some if u == t] for t in dict.fromkeys(t for t, _ in some)}
        counted = _histograms(_featured(rows, features), tops, by_tree, edges, classes, columns, seed)
        best = counted.groupBy("tree").applyInArrow(_choose(tops, by_tree, bins, classes, columns), _SPLIT)
        for r in sorted(best.collect()):
            top = tops[r.tree]
            order, place = top.open.pop(r.node)
            if not r.found:
                if place + columns < len(order):
                    top.open[r.node] = (order, place + columns)
                continue
            top.feature[r.node], top.threshold[r.node], top.child[r.node] = r.column, float(edges[r.column][r.edge]), len(top.feature)
            for n in (r.rows_left, r.rows_right):
                if n > LOCAL_ROWS:
                    top.open[len(top.feature)] = drawn(r.tree)
                top.feature.append(-1), top.threshold.append(0.0), top.child.append(0)
    return tops


def partitions_for(groups: int) -> int:
    """Partitions that groups are dealt to: few of them meet in one where they are few, some four where they are many."""
    return max(1, min(MOST_PARTITIONS, 2 * groups, max(200, groups // 4)))


def fit_trees(rows: DataFrame, features: Sequence[str], classes: int, trees: range, seed: int, folder: str, first_trees: bool) -> DataFrame:
    """The groups of some trees as ``GROUP_SCHEMA``, over ``rows`` with ``row``, ``features`` and ``label``.

    With ``first_trees`` each of them has a top; those are written to ``folder/tops-…``.
    """
    columns, spark = max(1, int(len(features) ** 0.5)), rows.sparkSession
    tops = _grow_tops(rows, features, classes, trees, seed) if first_trees else {t: Top() for t in trees}
    if first_trees:
        table = spark.createDataFrame([top.row(t) for t, top in tops.items()], TOP_SCHEMA)
        table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/tops-{trees.start}")
    groups = sum(top.feature.count(-1) for top in tops.values())
    dealt = map_partitions(_featured(rows, features), "Deal", spec([len(features)], *about_tops(tops), *_about_bags(seed)), _DEALT)
    keys = ["tree", "leaf"]
    together = dealt.repartition(partitions_for(groups), *keys).sortWithinPartitions(*keys)
    return map_partitions(together, "Grow", spec([len(features), classes, columns, seed]), GROUP_SCHEMA)


def _unzipped(blob: bytes, kind: type) -> Array:
    """An array of a group, as its task has compressed it."""
    length = int(np.frombuffer(blob, "<i4", 1)[0])
    return np.frombuffer(pa.decompress(blob[4:], length, codec="zstd", asbytes=True) if length else b"", kind)


class Group:
    """A grown group that votes."""

    def __init__(self, row: dict, classes: int):
        parts = zip((row[p] for p in ("feature", "threshold", "child", "value", "shares")), (np.int8, float, np.int32, np.int32, float), strict=True)
        self.feature, self.threshold, self.child, self.value, shares = (_unzipped(blob, kind) for blob, kind in parts)
        self.shares = shares.reshape(-1, classes)

    def vote(self, x: Array, votes: Array) -> None:
        """Add the shares of the leaf that each row falls into."""
        at, todo = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            todo = todo[self.feature[at[todo]] >= 0]
            if not len(todo):
                break
            nodes = at[todo]
            at[todo] = self.child[nodes] + (x[todo, self.feature[nodes]] > self.threshold[nodes])
        values = self.value[at]
        pure = np.flatnonzero(values >= 0)
        votes[pure, values[pure]] += 1
        rest = np.flatnonzero(values < 0)
        votes[rest] += self.shares[-1 - values[rest]]

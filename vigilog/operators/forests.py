"""The two attack classifiers: Spark ML's forest on scaled vectors, and one of trees without a depth limit on category codes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators.features import LABEL
from vigilog.operators import trees as growing
from vigilog.operators.labels import label_table, look_up
from vigilog.operators.splitting import SEED
from vigilog.schema import EVENT, EventColumns
from vigilog.session import work_folder, written

TREES = 50

#: Classes a forest may have: every node holds a count for each.
MOST_CLASSES = 1000

PREDICTED = "Predicted_Attack"

#: Rows of all bags that are dealt at once; the trees of a batch.
BATCH_ROWS = 1_000_000_000

#: A forest is broadcast up to this size; beyond it rows and trees meet in a shuffle.
SENT_BYTES = 96 << 20

#: Rows of a leaf that are dealt to one task in that shuffle, and the cells of votes a task sums up at once.
PART_ROWS = 500_000
VOTE_CELLS = 1 << 19

_ASKED = "tree int, leaf bigint, part int, first bigint, blob binary"
_SHARES = "block bigint, tree int, blob binary"


def code_columns(cols: EventColumns = EVENT) -> list[str]:
    return [f"{c}_enc" for c in cols.categorical]


def fit_feature_forest(featured: DataFrame, trees: int = TREES, seed: int = SEED) -> RandomForestClassificationModel:
    """The forest on scaled one-hot features."""
    forest = RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=trees, seed=seed)
    return forest.fit(featured)


@dataclass(frozen=True)
class CodeForest:
    """A forest on shared storage: its label table, the names of its classes, and its trees in parts of (folder name, trees, bytes).

    ``first_trees`` says whether every tree has a top, whose leaves the groups hang from.
    """

    folder: str
    classes: list[str]
    parts: list[tuple[str, int, int]] = field(default_factory=list)
    first_trees: bool = False

    @property
    def trees(self) -> int:
        return sum(trees for _, trees, _ in self.parts)

    @property
    def size(self) -> int:
        return sum(size for _, _, size in self.parts)

    def labels(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/labels")

    def groups(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(growing.GROUP_SCHEMA).parquet(*[f"{self.folder}/{name}" for name, *_ in self.parts])

    def tops(self, spark: SparkSession) -> dict[int, growing.Top]:
        if not self.first_trees:
            return {t: growing.Top() for t in range(self.trees)}
        folders = [f"{self.folder}/{name.replace('trees', 'tops')}" for name, *_ in self.parts]
        return {t: top for folder in folders for t, top in growing.saved_tops(spark, folder).items()}


def load_forest(spark: SparkSession, folder: str) -> CodeForest:
    about = json.loads(spark.read.text(f"{folder}/about").first().value)
    return CodeForest(**about | {"folder": folder, "parts": [tuple(p) for p in about["parts"]]})


def fit_code_forest(
    filled: DataFrame, cols: EventColumns = EVENT, trees: int = TREES, seed: int = SEED, folder: str | None = None
) -> CodeForest:
    """The forest on numbers and alphabetical category codes, written to ``folder``; its trees grow until nothing is left to part.

    ``filled`` follows the fill policy. The codes enter as plain numbers, not as nominal categories. Trees grow in batches,
    as many at once as their bags have ``BATCH_ROWS`` rows together. A finished batch is a table in the folder; no tree is ever on the
    driver. How trees grow, and what bounds a task, is told in ``trees``.
    """
    spark = filled.sparkSession
    folder = folder or work_folder(spark, "code-forest")
    codes = code_columns(cols)
    label_table(filled, [*cols.categorical, cols.attack], by_frequency=False).write.mode("overwrite").parquet(f"{folder}/labels")
    labels = spark.read.parquet(f"{folder}/labels")
    named = labels.filter(F.col("column") == cols.attack).orderBy("idx").select("value").limit(MOST_CLASSES + 1)
    classes = [r.value for r in named.collect()]
    if len(classes) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes in {cols.attack}")

    coded = filled
    for column, code in zip([*cols.categorical, cols.attack], [*codes, LABEL]):
        coded = look_up(coded, labels, column, code)
    features = [f"f{i}" for i in range(len(cols.numeric) + len(codes))]
    numbers = [F.col(c).cast("double").alias(f) for f, c in zip(features, [*cols.numeric, *codes])]
    rows = written(coded.select(F.monotonically_increasing_id().alias("row"), *numbers, F.col(LABEL).cast("int").alias("label")), "coded")

    n = rows.count()
    first_trees, parts = n > growing.LOCAL_ROWS, []
    batch = max(1, min(trees, BATCH_ROWS // max(1, n)))
    for start in range(0, trees, batch):
        some = range(start, min(start + batch, trees))
        growing.fit_trees(rows, features, len(classes), some, seed, folder, first_trees).write.mode("overwrite").parquet(f"{folder}/trees-{start}")
        held = spark.read.parquet(f"{folder}/trees-{start}").agg(F.sum(F.col("nodes").cast("bigint") * 17)).first()[0] or 0
        parts.append((f"trees-{start}", len(some), held))
    forest = CodeForest(folder, classes, parts, first_trees)
    spark.createDataFrame([(json.dumps(asdict(forest)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/about")
    return forest


_SENT: dict[str, object] = {}


def _sent(forest: CodeForest, spark: SparkSession):
    """The forest's groups as a broadcast variable, made once for a session."""
    key = f"{spark.sparkContext.applicationId} {forest.folder}"
    if key not in _SENT:
        _SENT.clear()  # the last one used is kept
        _SENT[key] = spark.sparkContext.broadcast([row.asDict() for row in forest.groups(spark).collect()])
    return _SENT[key]


def _voting(sent, classes: int) -> Callable:
    @F.arrow_udf("array<double>")
    def votes(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        groups = [growing.Group(row, classes) for row in sent.value]
        for part in parts:
            x = growing.matrix(part)
            found = np.zeros((len(x), classes))
            for group in groups:
                group.vote(x, found)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * classes), pa.array(found.ravel()))

    return votes


def _sum_votes(classes: int, bits: int) -> Callable:
    """The votes of every row of a block, its shares summed in the order of the trees."""

    def summed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        cells = np.zeros(classes << bits)
        seen = np.zeros(1 << bits, bool)
        for blob in rows.sort_by("tree").column("blob"):
            blob = blob.as_py()
            pure, rest = np.frombuffer(blob, "<i4", 2).tolist()
            at = 8
            for n, shared in ((pure, False), (rest, True)):
                place, cls = np.frombuffer(blob, "<u4", n, at).astype(np.int64), np.frombuffer(blob, "<u2", n, at + 4 * n)
                at += 6 * n
                cells[place * classes + cls] += np.frombuffer(blob, "<f8", n, at) if shared else 1  # a row is there once with a class
                seen[place] = True
        there = np.flatnonzero(seen)
        votes = cells.reshape(-1, classes)[there]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(there) + 1, dtype=np.int32) * classes), pa.array(votes.ravel()))
        return pa.table({"vote_row": pa.array((key[0].as_py() << bits) | there, pa.int64()), "votes": lists})

    return summed


def add_votes(rows: DataFrame, forest: CodeForest) -> DataFrame:
    """The rows with ``votes``: for each class the sum over all trees of its share of the leaf that the array ``features`` falls into.

    A forest of up to ``SENT_BYTES`` without tops is broadcast. Of a larger one each row meets the group of every tree in a
    shuffle, in packed runs; a leaf that most rows fall into is dealt in parts, each of which meets a copy of its group. A stream
    can't do that, so such a forest scores micro-batches.
    """
    spark, classes = rows.sparkSession, len(forest.classes)
    if forest.size <= SENT_BYTES and not forest.first_trees:
        return rows.withColumn("votes", _voting(_sent(forest, spark), classes)("features"))
    if rows.isStreaming:
        raise ValueError("this forest is too large to score a stream row by row: score its micro-batches")
    kept = written(rows.withColumn("vote_row", F.monotonically_increasing_id()), "votes")
    first = kept.select(F.size("features")).first()
    if first is None:
        return kept.withColumn("votes", F.array().cast("array<double>")).drop("vote_row")
    tops, keys = forest.tops(spark), ["tree", "leaf", "part"]
    wide, about = [F.col("features")[i] for i in range(first[0])], growing.spec([first[0]], *growing.about_tops(tops))
    asking = kept.select("vote_row", *wide)
    counts = growing.map_partitions(asking, "Ask", about + growing.spec(np.empty(0, int)), "tree int, leaf bigint, n bigint").groupBy("tree", "leaf").agg(F.sum("n").alias("n"))
    held = [(r.tree, r.leaf, -(-r.n // PART_ROWS)) for r in counts.collect()]  # a leaf stands for as many rows as a task grows
    tasks, bits = growing.partitions_for(sum(parts for *_, parts in held)), max(0, (VOTE_CELLS // classes).bit_length() - 1)
    begins = dict(zip(tops, growing.about_tops(tops)[1].tolist()))
    parts = np.ones(sum(len(top.feature) for top in tops.values()), int)
    for tree, leaf, some in held:
        parts[begins[tree] + leaf] = some
    asked = growing.map_partitions(asking, "Ask", about + growing.spec(parts), _ASKED)
    copies = forest.groups(spark).join(F.broadcast(spark.createDataFrame(held, "tree int, leaf bigint, parts int")), ["tree", "leaf"])
    copies = copies.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    nodes = ["feature", "threshold", "child", "value", "shares"]
    asked = asked.select(*keys, F.lit(1).alias("kind"), "first", "blob", *[F.lit(None).cast("binary").alias(c) for c in nodes])
    copies = copies.select(*keys, F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("first"), F.lit(None).cast("binary").alias("blob"), *nodes)
    met = copies.unionByName(asked).repartition(tasks, *keys).sortWithinPartitions(*keys, "kind")
    shares = growing.map_partitions(met, "Vote", growing.spec([first[0], classes, bits]), _SHARES)
    summed = shares.groupBy("block").applyInArrow(_sum_votes(classes, bits), "vote_row bigint, votes array<double>")
    return kept.join(summed, "vote_row").drop("vote_row")

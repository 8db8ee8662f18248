"""Labels as a table: however many there are, none of them travels to the driver or into a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.operators.ranking import running_sums

#: A column's labels are broadcast up to this number and size; beyond it only the most frequent ones are.
SENT_LABELS = 100_000
SENT_BYTES = 8 << 20
HOT_LABELS = 10_000
HOT_BYTES = 256


def label_table(rows: DataFrame, columns: Sequence[str], by_frequency: bool) -> DataFrame:
    """``column``, ``value``, ``idx`` and ``cnt`` for every value of every column, NULL left out.

    ``idx`` counts from 0 in each column, by descending frequency with ties by value, or by value. One scan counts all
    columns; the order is one of range partitions, so the number of labels has no bound.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = rows.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("cnt"))
    order = [F.col("column"), *([-F.col("cnt")] if by_frequency else []), F.col("value")]
    ranked = running_sums(counts, order, {"rank": F.lit(1).cast("bigint")})
    first = ranked.groupBy("column").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "column").select("column", "value", (F.col("rank") - F.col("first")).alias("idx"), "cnt")


def look_up(rows: DataFrame, labels: DataFrame, column: str, output: str, value: Column | None = None) -> DataFrame:
    """The rows with ``output``: the index of ``value`` (else of the column) among the column's labels, NULL where it is none.

    A small label table is broadcast after a check of its size. Of a large one the most frequent labels are, so that a
    value of a third of all rows is no join key; the other rows meet the rest of the table in a shuffle.
    """
    key, label = f"{output}_key", f"{output}_label"
    mine = labels.filter(F.col("column") == column).select(F.col("value").alias(label), F.col("idx").alias(output), "cnt")
    number, size = mine.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(label)), F.lit(0))).first()
    keyed = rows.withColumn(key, (F.col(column) if value is None else value).cast("string"))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.drop("cnt"), F.col(key) == F.col(label), "left").drop(label)

    if number <= SENT_LABELS and size <= SENT_BYTES:
        return joined(keyed, F.broadcast(mine)).drop(key)
    hot = mine.filter(F.octet_length(label) <= HOT_BYTES).orderBy(F.desc("cnt"), label).limit(HOT_LABELS)
    near = joined(keyed, F.broadcast(hot))
    settled = F.col(output).isNotNull() | F.col(key).isNull()
    return near.filter(settled).unionByName(joined(near.filter(~settled).drop(output), mine)).drop(key)


def index_by_table(rows: DataFrame, labels: DataFrame, column: str, output: str) -> DataFrame:
    """The rows with the column's index as a double; unseen values and NULL share one extra index, as a fitted indexer gives it."""
    extra = labels.filter(F.col("column") == column).agg(F.count("*")).first()[0]
    found = look_up(rows, labels, column, output)
    return found.withColumn(output, F.coalesce(F.col(output), F.lit(extra)).cast("double"))


def first_label(labels: DataFrame, column: str) -> str | None:
    """The label with index 0; None where the column has no labels."""
    row = labels.filter((F.col("column") == column) & (F.col("idx") == 0)).select("value").first()
    return row.value if row else None


def names_of(rows: DataFrame, labels: DataFrame, column: str, code: str, output: str) -> DataFrame:
    """The rows with ``output``: the label that an index stands for, NULL where it stands for none.

    Broadcast or not by the rules of ``look_up``, which this turns round.
    """
    turned = labels.select("column", F.col("idx").cast("string").alias("value"), F.col("value").alias("idx"), "cnt")
    return look_up(rows, turned, column, output, F.col(code))

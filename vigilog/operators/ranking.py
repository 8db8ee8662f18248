"""Ordered heads of a frame. Sort and limit plan as one ordered take: every task keeps n rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.session import written


def top(frame: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of an order; give enough sort keys to leave no ties."""
    return frame.orderBy(*order).limit(n)


def top_values(frame: DataFrame, column: str, n: int = 10, name: str = "event_count") -> DataFrame:
    """The ``n`` most frequent values (NULL counts as one if the caller keeps it), ties by value."""
    counts = frame.groupBy(column).agg(F.count("*").alias(name))
    return top(counts, n, F.desc(name), F.asc(column))


def latest(frame: DataFrame, arrival: Sequence[str], n: int = 15) -> DataFrame:
    """The ``n`` rows that came last, by the arrival columns given, most significant first."""
    return top(frame, n, *[F.desc(c) for c in arrival])


def running_sums(frame: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """The frame with the sum of each expression over all rows before a row in an order over the whole frame; NULL counts as 0.

    ``F.lit(1)`` gives a rank from 0. Rows are dealt by range and summed within their part; what reaches one task is
    a row per part, so neither the sort nor the sums gather the frame. Rows that tie in the order get some order.
    """
    names = [f"sum_{i}" for i in range(len(sums))]
    values = [F.coalesce(value, F.lit(0)).alias(name) for name, value in zip(names, sums.values())]
    keys = [f"key_{i}" for i in range(len(order))]
    by = [key.asc_nulls_first() for key in map(F.col, keys)]
    keyed = frame.select(F.struct("*").alias("row"), *values, *[c.alias(k) for c, k in zip(order, keys)])
    dealt = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()  # the part above the place in it
    parts = written(dealt.withColumns({"part": F.shiftright(place, 33), "place": place}), "running")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("part").agg(*[F.sum(name).alias(name) for name in names])
    offsets = before.select("part", *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"ahead_{name}") for name in names])
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("row", "part", *[F.coalesce(F.sum(name).over(within), F.lit(0)).alias(name) for name in names])
    summed = local.join(F.broadcast(offsets), "part")  # a row for each part
    return summed.select("row.*", *[(F.col(f"ahead_{n}") + F.col(n)).alias(name) for n, name in zip(names, sums)])

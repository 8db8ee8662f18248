"""One scan for every grouped result: mergeable partial aggregates on a few grouping sets.

The categories go into one small cube, the source addresses into a set of their own. Reports and charts
are then summed from these rows. The same call works on a stream, where it is the only state kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(events: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """Row count, and sum and count of every measure without NULL and NaN, for each grouping set.

    ``set_no`` tells the rows of the sets apart; keys outside a row's set are NULL.
    """
    keys = list(dict.fromkeys(k for group in sets for k in group))
    bits = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in group): n for n, group in enumerate(sets)}
    set_no = F.lit(None).cast("int")
    for bit, number in bits.items():
        set_no = F.when(F.col("gid") == bit, number).otherwise(set_no)
    kinds = dict(events.dtypes)
    value = {m: F.nanvl(m, F.lit(None).cast("double")) if kinds[m] in ("float", "double") else F.col(m) for m in measures}
    partials = [column for m, v in value.items() for column in (F.sum(v).alias(f"{m}_sum"), F.count(v).alias(f"{m}_n"))]
    grouped = events.groupingSets([list(s) for s in sets], *keys).agg(
        F.grouping_id().alias("gid"), F.count("*").alias("events"), *partials
    )
    return grouped.select(set_no.alias("set_no"), *keys, "events", *[f"{m}_{p}" for m in measures for p in ("sum", "n")])


def only(rolled: DataFrame, set_no: int) -> DataFrame:
    """The rows of one grouping set."""
    return rolled.filter(F.col("set_no") == set_no)


def summed(name: str = "cnt") -> Column:
    """Rows, summed from rollup rows."""
    return F.sum("events").alias(name)


def mean(measure: str) -> Column:
    """The mean of a measure, from rollup rows; NULL where there is no value."""
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))

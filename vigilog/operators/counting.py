"""Grouped and global aggregates. Every one combines on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.operators.cleaning import present
from vigilog.schema import EVENT, EventColumns


def row_total(frame: DataFrame, name: str = "total") -> DataFrame:
    return frame.agg(F.count("*").alias(name))


def group_counts(frame: DataFrame, *keys: str | Column, name: str = "cnt", **more: Column) -> DataFrame:
    """Rows per group, NULL being a group of its own, with further aggregates by name."""
    extra = [column.alias(alias) for alias, column in more.items()]
    return frame.groupBy(*keys).agg(F.count("*").alias(name), *extra)


def value_counts(frame: DataFrame, column: str, name: str = "cnt") -> DataFrame:
    """Rows per value, NULL left out."""
    return group_counts(frame.filter(F.col(column).isNotNull()), column, name=name)


def category_share(frame: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows.

    The total is a scalar subquery over the same grouping, so both sides share one scan and one shuffle.
    """
    counts = group_counts(frame, column)
    total = counts.agg(F.sum("cnt").alias("n")).scalar()
    return counts.withColumn("share", F.col("cnt").cast("double") / total)


def hourly_counts(frame: DataFrame, ts: str, name: str = "events") -> DataFrame:
    """Rows per hour of the day, rows without a time left out."""
    timed = frame.filter(F.col(ts).isNotNull())
    return group_counts(timed, F.hour(ts).alias("hour"), name=name)


def _value(events: DataFrame, column: str) -> Column:
    """The column with NULL for NaN."""
    kind = dict(events.dtypes).get(column)
    return F.nanvl(column, F.lit(None).cast("double")) if kind in ("float", "double") else F.col(column)


def kpis(events: DataFrame, cols: EventColumns = EVENT, digits: int = 3) -> DataFrame:
    """One row of headline numbers; a column the frame lacks gives 0."""

    def metric(column: str, value: Column, zero: Column) -> Column:
        return value if column in events.columns else zero

    no_rows = F.lit(0).cast("bigint")
    return events.agg(
        F.count("*").alias("total_logs"),
        metric(cols.attack, F.count_distinct(cols.attack), no_rows).alias("attack_types"),
        metric(cols.severity, F.count_if(F.col(cols.severity) == "High"), no_rows).alias("high_severity"),
        metric(cols.anomaly, F.round(F.avg(_value(events, cols.anomaly)), digits), F.lit(0.0)).alias("avg_anomaly"),
    )


def quality_counts(events: DataFrame, ts: str, cols: EventColumns = EVENT) -> DataFrame:
    """How many rows are loaded, have a target, have a time, and are complete with a target: one pass."""
    needed = [*cols.numeric, *cols.categorical, cols.attack]
    complete = F.lit(True)
    kinds = dict(events.dtypes)
    for column in needed:
        complete = complete & present(column, kinds[column])
    return events.agg(
        F.count("*").alias("loaded"),
        F.count(cols.attack).alias("with_target"),
        F.count(ts).alias("with_ts"),
        F.count_if(complete).alias("complete_rows"),
    )


def histogram(frame: DataFrame, column: str, bins: int = 40, weight: str | None = None) -> DataFrame:
    """Rows in each of ``bins`` equal-width bins between the smallest and the largest value; the last bin is closed.

    The range comes from a scalar subquery over that one column. ``weight`` names a count column when the
    frame already holds one row per value. Empty bins have no row; NULL and NaN are left out.
    """
    values = frame.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    low = values.agg(F.min(column).alias("low")).scalar()
    high = values.agg(F.max(column).alias("high")).scalar()
    width = (high - low) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col(column) - low, width)), F.lit(0))
    rows = F.count("*") if weight is None else F.sum(weight)
    placed = values.withColumn("bin", F.least(F.lit(bins - 1), place).cast("int"))
    counts = placed.groupBy("bin").agg(rows.alias("cnt"))
    return counts.select("bin", (low + F.col("bin") * width).alias("bin_start"), "cnt")

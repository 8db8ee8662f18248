"""A histogram of bounded size that can be merged: whole cells of a grid whose width is a power of two.

The width is the smallest for which all values lie within ``CELLS`` cells; if a value falls outside, it doubles, and cells
are merged in pairs. So the grid of a union is the same whether it is made of all values at once or of the grids
of parts, in any order.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096

#: The finest width is 2 ** FINEST; a cell's number stays below 2 ** MOST_BITS.
FINEST = -20
MOST_BITS = 52

SCHEMA = "width int, cell bigint, cnt bigint"


def _width(low: float, high: float, cells: int, least: int = FINEST) -> int:
    """The exponent of the smallest width not below ``least`` with which the values from ``low`` to ``high`` fit."""
    width = least
    while True:
        first, last = (floor(v / 2.0**width) if width > -1000 else 0 for v in (low, high))
        if last - first < cells and max(abs(first), abs(last)) < 1 << MOST_BITS:
            return width
        width += 1


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def grid(frame: DataFrame, column: str, cells: int = CELLS) -> DataFrame:
    """``width`` (an exponent of two), ``cell`` and ``cnt`` for the column's values; NULL, NaN and infinities are left out."""
    values = frame.select(_finite(column).alias("value")).filter("value is not null")
    low, high = values.agg(F.min("value"), F.max("value")).first()
    width = FINEST if low is None else _width(low, high, cells)
    cell = F.floor(F.col("value") / F.lit(2.0**width)).cast("bigint").alias("cell")
    return values.groupBy(cell).agg(F.count("*").alias("cnt")).select(F.lit(width).alias("width"), "cell", "cnt")


def merged(grids: DataFrame, cells: int = CELLS) -> DataFrame:
    """One grid from the rows of several."""
    bounds = grids.groupBy("width").agg(F.min("cell").alias("low"), F.max("cell").alias("high")).collect()  # a row for each width
    if not bounds:
        return grids
    low, high = min(b.low * 2.0**b.width for b in bounds), max(b.high * 2.0**b.width for b in bounds)
    width = _width(low, high, cells, max(b.width for b in bounds))
    coarser = F.expr(f"floor(cell / power(2D, {width} - width))").cast("bigint").alias("cell")
    counts = grids.groupBy(coarser).agg(F.sum("cnt").alias("cnt"))
    return counts.select(F.lit(width).alias("width"), "cell", "cnt")


def grid_histogram(cells: DataFrame, bins: int = 40) -> DataFrame:
    """Rows in each of ``bins`` bins of equally many cells, from the first to the last cell that has rows.

    With fewer cells than bins some bins stay empty; empty bins have no row. ``bin_start`` is where the bin's first cell begins.
    """
    ends = cells.agg(F.min("cell").alias("low"), F.max("cell").alias("high"), F.max("width").alias("width"))
    low, high, width = (ends.select(c).scalar() for c in ("low", "high", "width"))
    span = high - low + 1
    place = F.floor((F.col("cell") - low) * bins / span).cast("int").alias("bin")
    counts = cells.groupBy(place).agg(F.sum("cnt").alias("cnt"))
    start = (low + F.ceil(F.col("bin") * span / bins)) * F.pow(F.lit(2.0), width)
    return counts.select("bin", start.alias("bin_start"), "cnt")

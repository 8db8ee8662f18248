"""Rendering of result rows as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_line(*cells: Column) -> Column:
    """The cells of one row joined by `` | ``, NULL spelled out."""
    return F.concat_ws(" | ", *[F.coalesce(cell.cast("string"), F.lit("NULL")) for cell in cells])

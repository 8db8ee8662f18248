"""Row and column cleaning: null policies, known-value fallback, schema-tolerant projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.casts import cast_columns, tolerant
from vigilog.schema import EVENT, EventColumns

UNKNOWN = "Unknown"


def number(column: str) -> Column:
    """The column as a double, NULL where it is malformed or not a number."""
    return F.nanvl(tolerant(column, "double"), F.lit(None).cast("double"))


def present(column: str, kind: str) -> Column:
    """Whether a cell holds a value: not NULL, and of a fraction not NaN."""
    value = F.nanvl(column, F.lit(None).cast("double")) if kind in ("float", "double") else F.col(column)
    return value.isNotNull()


def with_target(events: DataFrame, target: str) -> DataFrame:
    """The rows that have a target value."""
    return events.filter(F.col(target).isNotNull())


def report_rows(events: DataFrame, cols: EventColumns = EVENT) -> DataFrame:
    """The typed rows the grouped report runs on: measures cast, rows without a target gone."""
    typed = cast_columns(events, {cols.anomaly: "double", cols.packet_length: "bigint"})
    return with_target(typed, cols.attack)


def complete_cases(events: DataFrame, cols: EventColumns = EVENT) -> DataFrame:
    """The *drop* policy: numeric features as double, then only rows where no feature or target is NULL.

    The cast comes first, so a malformed number drops its row instead of failing later in the assembler; so
    does one that is not a number. Spark simplifies a plain condition per column better than one over all of them.
    """
    whole = {name for name, kind in events.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}
    typed = cast_columns(events, dict.fromkeys(cols.numeric, "double"))
    for column in [cols.attack, *cols.categorical, *cols.numeric]:
        may_be_nan = column in cols.numeric and column not in whole
        value = F.nanvl(column, F.lit(None).cast("double")) if may_be_nan else F.col(column)
        typed = typed.filter(value.isNotNull())
    return typed


def fill_missing(events: DataFrame, cols: EventColumns = EVENT) -> DataFrame:
    """The *fill* policy: malformed, missing or NaN numbers become 0, missing categories and targets ``Unknown``.

    Columns the frame lacks are passed over.
    """
    numbers = [c for c in cols.numeric if c in events.columns]
    texts = [c for c in [*cols.categorical, cols.attack] if c in events.columns]
    return events.withColumns(
        {c: F.coalesce(number(c), F.lit(0.0)) for c in numbers}
        | {c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in texts}
    )


def project_existing(frame: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return frame.select(*[c for c in wanted if c in frame.columns])

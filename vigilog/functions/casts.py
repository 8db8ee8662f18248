"""Casts that turn a malformed cell into NULL, whatever the session's ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cells a CSV reader with NA detection takes for missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_WHOLE = {"int", "bigint", "long"}


def tolerant(column: str, data_type: str) -> Column:
    """``column`` as ``data_type``; NULL where the cell is malformed.

    A whole-number target cuts off a fraction ("503.0" is 503), which a plain ``try_cast`` would refuse.
    """
    cell = F.col(column)
    if data_type not in _WHOLE:
        return cell.try_cast(data_type)
    return F.coalesce(cell.try_cast(data_type), cell.try_cast("decimal(38,6)").try_cast(data_type))


def tolerant_timestamp(frame: DataFrame, column: str) -> Column:
    """``column`` as a timestamp, parsed if it is text; NULL where the text is no time."""
    if isinstance(frame.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column)


def cast_columns(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace the named columns by their tolerant casts; a column that has its type already stays as it is."""
    have = dict(frame.dtypes)
    return frame.withColumns({name: tolerant(name, kind) for name, kind in types.items() if have[name] != kind})


def cast_to_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column the schema knows, leave the others."""
    return cast_columns(frame, {f.name: f.dataType.simpleString() for f in schema if f.name in frame.columns})


def blank_tokens(frame: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """NULL for every text cell that is one of ``tokens``."""
    tokens = list(tokens)
    text = [f.name for f in frame.schema if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({name: F.when(~F.col(name).isin(tokens), F.col(name)) for name in text})

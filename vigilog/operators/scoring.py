"""Scoring of events, in batch or in a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.operators.cleaning import UNKNOWN, number
from vigilog.operators.forests import PREDICTED, CodeForest, add_votes, code_columns
from vigilog.operators.labels import first_label, look_up
from vigilog.schema import EVENT, EventColumns

CONFIDENCE = "Confidence_Pct"


def confidence_pct(votes: Column, trees: int) -> Column:
    """The largest class share in percent, to one place, halves to even."""
    return F.bround(F.array_max(votes) / trees * 100, 1)


def scorable(events: DataFrame, cols: EventColumns = EVENT) -> bool:
    """Whether the frame has every feature column."""
    return set(cols.numeric + cols.categorical) <= set(events.columns)


def known_codes(events: DataFrame, labels: DataFrame, column: str, code: str) -> DataFrame:
    """The column as a stored dictionary knows it, and its code.

    A value that has no label (NULL counts as ``Unknown``) becomes the first one, with code 0; a column without
    labels keeps its values, all with code 0.
    """
    first = first_label(labels, column)
    if first is None:
        return events.withColumn(code, F.lit(0))
    value = F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
    found = look_up(events, labels, column, code, value)
    seen = F.when(F.col(code).isNotNull(), value).otherwise(F.lit(first))
    return found.withColumn(column, seen).withColumn(code, F.coalesce(F.col(code), F.lit(0)).cast("int"))


def coded_events(events: DataFrame, labels: DataFrame, cols: EventColumns = EVENT) -> DataFrame:
    """The events with the values a model sees, numbers with 0 for missing and known categories, beside the codes."""
    seen = events.withColumns({c: F.coalesce(number(c), F.lit(0.0)) for c in cols.numeric})
    for column, code in zip(cols.categorical, code_columns(cols)):
        seen = known_codes(seen, labels, column, code)
    return seen


def values_seen(events: DataFrame, scorer: CodeForest | None, cols: EventColumns = EVENT) -> DataFrame:
    """The events with the values a model sees; unchanged where nothing is scored."""
    if scorer is None or not scorable(events, cols):
        return events
    return coded_events(events, scorer.labels(events.sparkSession), cols).select(*events.columns)


def score_events(events: DataFrame, scorer: CodeForest | None, cols: EventColumns = EVENT) -> DataFrame:
    """Add the predicted attack and its confidence.

    Without a model the rows pass through. A frame that lacks a feature column gets ``Error`` and 0.0. The
    scored frame carries the values the model saw. A category for which the model has no labels gets code 0.
    """
    if scorer is None:
        return events
    if not scorable(events, cols):
        return events.withColumns({PREDICTED: F.lit("Error"), CONFIDENCE: F.lit(0.0)})
    codes = code_columns(cols)
    labels = scorer.labels(events.sparkSession)
    coded = coded_events(events, labels, cols)
    vector = F.array(*[F.col(c).cast("double") for c in [*cols.numeric, *codes]]).alias("features")
    voted = add_votes(coded.select(*events.columns, *codes, vector), scorer)
    winner = F.array_position("votes", F.array_max("votes"))
    predicted = F.get(F.array(*[F.lit(name) for name in scorer.classes]), (winner - 1).cast("int"))
    return voted.select(*events.columns, *codes, predicted.alias(PREDICTED), confidence_pct(F.col("votes"), scorer.trees).alias(CONFIDENCE))


def add_predictions(events: DataFrame, scorer: CodeForest | None, cols: EventColumns = EVENT) -> DataFrame:
    """As ``score_events``, but every column keeps its own value: what a store should hold."""
    if scorer is None:
        return events
    carried = events.withColumn("event_as_read", F.struct(*events.columns))
    return score_events(carried, scorer, cols).select("event_as_read.*", PREDICTED, CONFIDENCE)

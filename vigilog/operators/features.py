"""Feature pipelines.

The labels of all columns are counted in one scan, so fitting takes two passes over the data (labels, then
scale) instead of one per column and stage; the columns that come out are those of a stage per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.operators.labels import label_table
from vigilog.operators.ranking import top
from vigilog.schema import EVENT, EventColumns

LABEL = "label"

#: Labels of a column travel to every task inside the fitted model, so there may only be so many.
MOST_LABELS = 100_000


def label_lists(rows: DataFrame, columns: Sequence[str], by_frequency: bool, most: int = MOST_LABELS) -> list[list[str]]:
    """The values of every column, NULL left out, by descending frequency or by value; ties by value.

    For columns of up to ``most`` labels, which are counted before any of them reaches the driver; larger ones are
    indexed by their label table (``labels.index_by_table``).
    """
    table = label_table(rows, columns, by_frequency)
    sizes = {r.column: r.n for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    large = [c for c in columns if sizes.get(c, 0) > most]
    if large:
        raise ValueError(f"more than {most} values to index in {large}: use a label table")
    found = table.select("column", "idx", "value").collect()
    return [[r.value for r in sorted((r for r in found if r.column == c), key=lambda r: r.idx)] for c in columns]


def stored_indexer(labels: Sequence[Sequence[str]], columns: Sequence[str], outputs: Sequence[str]) -> PipelineModel:
    """Indexers made from label lists, one per column; unseen values and NULL share one extra index.

    The multi-column model cannot be built from lists of unequal length: PySpark pads them with NULL labels.
    """
    return PipelineModel(
        stages=[
            StringIndexerModel.from_labels(list(values), inputCol=column, outputCol=output, handleInvalid="keep")
            for values, column, output in zip(labels, columns, outputs)
        ]
    )


def indexer_labels(indexer: PipelineModel) -> dict[str, list[str]]:
    """The labels of every column an indexer was made for."""
    return {stage.getInputCol(): list(stage.labels) for stage in indexer.stages}


def frequency_indexer(rows: DataFrame, columns: Sequence[str], outputs: Sequence[str]) -> PipelineModel:
    """Index by descending frequency, ties by value."""
    return stored_indexer(label_lists(rows, columns, by_frequency=True), columns, outputs)


def unit_scaler(source: str, target: str) -> StandardScaler:
    """Divide every slot by its sample standard deviation, without centring; a constant slot becomes 0."""
    return StandardScaler(inputCol=source, outputCol=target, withMean=False, withStd=True)


def fit_features(rows: DataFrame, cols: EventColumns = EVENT) -> PipelineModel:
    """Index, one-hot encode, assemble and scale complete cases; the target becomes ``label``.

    The target index also keeps a place for unseen values, so a classifier sees one class more.
    """
    indexed = [f"{c}_indexed" for c in cols.categorical]
    encoded = [f"{c}_encoded" for c in cols.categorical]
    stages = [
        frequency_indexer(rows, [*cols.categorical, cols.attack], [*indexed, LABEL]),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*cols.numeric, *encoded], outputCol="raw_features", handleInvalid="error"),
        unit_scaler("raw_features", "features"),
    ]
    return Pipeline(stages=stages).fit(rows)


def feature_sample(rows: DataFrame, model: PipelineModel, n: int = 5, order: Sequence[Column | str] = ()) -> DataFrame:
    """A few transformed rows: the first of ``order``, or any without one."""
    return model.transform(top(rows, n, *order) if order else rows.limit(n))

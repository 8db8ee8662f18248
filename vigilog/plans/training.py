"""Training: clean, split, fit, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.cleaning import complete_cases, fill_missing
from vigilog.operators.evaluation import confusion
from vigilog.operators.features import LABEL, fit_features
from vigilog.operators.forests import PREDICTED, TREES, CodeForest, fit_code_forest, fit_feature_forest
from vigilog.operators.scoring import score_events
from vigilog.operators.splitting import exact_split, hash_split
from vigilog.schema import EVENT, EventColumns
from vigilog.session import written


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline or code forest, the forest if that is saved apart, the scored hold-out rows and their confusion table."""

    pipeline: PipelineModel | CodeForest
    forest: object | None
    scored: DataFrame
    confusion: DataFrame


def learning_columns(cols: EventColumns, key: str | None) -> list[str]:
    return [*([key] if key else []), *cols.numeric, *cols.categorical, cols.attack]


def split_rows(rows: DataFrame, cols: EventColumns, key: str | None) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows: by row key where there is one, else by a hash of the whole row.

    The columns that are needed go to a table first: fitting reads them a dozen times, and a split drawn
    from a table stays the same when a task is run again.
    """
    table = written(rows.select(*learning_columns(cols, key)), "learning")
    if key:
        return hash_split(table, key)
    whole = table.withColumn("row_hash", F.xxhash64(*table.columns).cast("string"))
    train, test = hash_split(whole, "row_hash")
    return train.drop("row_hash"), test.drop("row_hash")


def train_feature_forest(
    events: DataFrame,
    cols: EventColumns = EVENT,
    key: str | None = None,
    pipeline: PipelineModel | None = None,
    trees: int = TREES,
) -> Trained:
    """The forest on one-hot features, under the drop policy.

    Without a saved ``pipeline`` the features are fitted on the training rows only, so the hold-out rows
    influence neither indices nor scale.
    """
    train, test = split_rows(complete_cases(events, cols), cols, key)
    pipeline = pipeline or fit_features(train, cols)
    forest = fit_feature_forest(pipeline.transform(train).select(LABEL, "features"), trees)
    scored = forest.transform(pipeline.transform(test))
    return Trained(pipeline, forest, scored, confusion(scored, LABEL, "prediction"))


def train_code_forest(
    events: DataFrame,
    cols: EventColumns = EVENT,
    key: str | None = None,
    trees: int = TREES,
    folder: str | None = None,
) -> Trained:
    """The forest on category codes, under the fill policy: the model that scores live events.

    The hold-out rows are exactly a fifth, rounded up. The forest is written to ``folder``, else to the work folder.
    """
    train, test = exact_split(fill_missing(events, cols).select(*learning_columns(cols, key)), key)
    scorer = fit_code_forest(train, cols, trees, folder=folder)
    scored = written(score_events(test, scorer, cols), "scored")
    return Trained(scorer, None, scored, confusion(scored, cols.attack, PREDICTED))

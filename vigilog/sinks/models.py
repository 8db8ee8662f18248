"""Fitted models on shared storage, in versions.

A version is a folder of its own, and its marker is written last: whoever reads takes the newest version that has one, so a
model that is being written or was left half done is never seen, and a reader of an older version keeps its files.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from vigilog.sinks.files import delete, found, write_text

#: Whole versions that stay.
KEPT = 3

_MARKER = "_COMMITTED"


def _numbers(spark: SparkSession, path: str, whole: bool) -> list[int]:
    """The numbers of the versions below a path, the newest first."""
    places = [place for _, place in found(spark, f"{path}/version=*{'/' + _MARKER if whole else ''}")]
    folders = [place.rpartition("/")[0] if whole else place for place in places]
    return sorted((int(f.rpartition("=")[2]) for f in folders), reverse=True)


def new_version(spark: SparkSession, path: str) -> str:
    """A folder for the next version; it counts once it is committed. One writer at a time."""
    return f"{path}/version={max(_numbers(spark, path, whole=False), default=0) + 1}"


def commit_version(spark: SparkSession, folder: str, keep: int = KEPT) -> None:
    """Make a written version the current one, and delete all but the last ``keep`` whole ones."""
    write_text(spark, f"{folder}/{_MARKER}", "")
    path = folder.rpartition("/")[0]
    for number in _numbers(spark, path, whole=True)[keep:]:
        delete(spark, f"{path}/version={number}/{_MARKER}")  # first it stops counting, then it goes
        delete(spark, f"{path}/version={number}")


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest whole version; None before the first."""
    numbers = _numbers(spark, path, whole=True)
    return f"{path}/version={numbers[0]}" if numbers else None


def save_model(model, path: str) -> None:
    """Save a model as the next version below ``path``."""
    spark = SparkSession.active()
    folder = new_version(spark, path)
    model.write().overwrite().save(f"{folder}/model")
    commit_version(spark, folder)


def model_exists(spark: SparkSession, path: str) -> bool:
    return current_version(spark, path) is not None


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel | None:
    """The current version of a saved pipeline, or None when there is none."""
    folder = current_version(spark, path)
    return PipelineModel.load(f"{folder}/model") if folder else None

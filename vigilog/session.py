"""Sessions, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from vigilog.sinks.files import delete

_MADE: list[str] = []


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are tested under.

    Shuffle partitions and memory are left to the cluster; AQE coalesces small shuffles.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, the storage every executor can reach.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="vigilog-")
    folder = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(folder)
    return folder


def remove_work(spark: SparkSession) -> None:
    """Delete the work folders named since the last time: for a job that has written its results elsewhere."""
    while _MADE:
        delete(spark, _MADE.pop())


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the work folder: computed once, and safe from lost executors."""
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

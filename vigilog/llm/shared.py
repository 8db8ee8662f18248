"""Intermediate tables of the operators in this subpackage, in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; only a local session may leave that setting out."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='vigilog-llm-')}"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """The frame as a Parquet table of its own: computed once, and there again after executors are lost."""
    path = f"{folder}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets go of the shuffle files of tables that are stored: Spark deletes them once the driver has collected their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

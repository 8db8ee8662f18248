"""Small files on the storage that Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop's file classes, and the store a path lies in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a hidden name and then move it in place, so that nobody reads half of it."""
    hadoop, store = file_system(spark, path)
    folder, _, name = path.rpartition("/")
    own = hadoop.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = store.create(own)
    out.write(bytearray(text, "utf-8"))
    out.close()
    target = hadoop.Path(path)
    store.delete(target, False)
    if not store.rename(own, target):
        raise OSError(f"could not move a file to {path}")


def found(spark: SparkSession, pattern: str) -> list[tuple[int, str]]:
    """Modification time and path of everything a pattern matches."""
    hadoop, store = file_system(spark, pattern)
    return [(f.getModificationTime(), f.getPath().toString()) for f in store.globStatus(hadoop.Path(pattern)) or []]


def delete(spark: SparkSession, path: str) -> None:
    hadoop, store = file_system(spark, path)
    store.delete(hadoop.Path(path), True)

"""Lifetime totals of a stream over groups of a bounded number, kept as streaming state.

``totals`` keeps what has more groups, and what isn't a grouped sum, without state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

#: Snapshots that stay, so that readers of an older one can finish.
KEPT = 10


def committed_snapshots(spark: SparkSession, folder: str) -> list[str]:
    """The folders of whole snapshots, the last one first; one that is still being written has no marker yet.

    A stream started over with a new checkpoint counts its batches from 0 again under a new id, so the time of
    the commit decides, and the batch number among those of the same time.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    markers = hadoop.Path(f"{folder}/stream_id=*/snapshot=*/_SUCCESS")
    found = markers.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(markers) or []
    snapshots = [(f.getModificationTime(), f.getPath().getParent()) for f in found]
    snapshots.sort(key=lambda x: (x[0], int(x[1].getName().rpartition("=")[2])), reverse=True)
    return [path.toString() for _, path in snapshots]


def prune_snapshots(spark: SparkSession, folder: str, keep: int = KEPT) -> None:
    """Delete all but the last ``keep`` whole snapshots."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for old in committed_snapshots(spark, folder)[keep:]:
        path = hadoop.Path(old)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def start_snapshots(
    totals: DataFrame,
    folder: str,
    checkpoint: str,
    every: str | None = None,
    keep: int = KEPT,
) -> StreamingQuery:
    """Write the aggregate after every micro-batch as a snapshot of its own, and keep the last ``keep``.

    ``totals`` is a grouped stream, every group of which is written each time. Readers of an older snapshot are not disturbed,
    and a batch delivered again rewrites the same one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{folder}/stream_id={stream_id}/snapshot={batch_id}")
        prune_snapshots(spark, folder, keep)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_snapshot(spark: SparkSession, folder: str, totals: DataFrame) -> DataFrame:
    """The last whole snapshot, read alone; empty before the first."""
    written = committed_snapshots(spark, folder)
    if not written:
        return spark.createDataFrame([], totals.schema)
    return spark.read.schema(totals.schema).parquet(written[0])

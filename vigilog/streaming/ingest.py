"""Streaming ingestion into the event store."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilog.schema import EMITTED
from vigilog.sinks.files import write_text
from vigilog.sources.event_store import LEDGER

Prepare = Callable[[DataFrame], DataFrame]


def stamp_arrival(events: DataFrame) -> DataFrame:
    """``Emit_Timestamp`` where the producer has not set it: one time per micro-batch, kept on replay."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    given = [F.col(EMITTED)] if EMITTED in events.columns else []
    return events.withColumn(EMITTED, F.coalesce(*given, now))


def stream_id(batch: DataFrame) -> str:
    """The id of the stream a micro-batch belongs to: it stays the same as long as the checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_writer(store: str, prepare: Prepare | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch to a folder of its own, so a batch delivered again replaces itself.

    The stream's id is part of the folder: a stream started over with a new checkpoint counts its batches
    from 0 again and must not overwrite what the old one stored. Rows and first and last stamp are observed while the rows are
    written, and go to the ledger when they are: what the ledger names is whole.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id(batch)
        rows = batch if prepare is None else prepare(batch)
        stamp = F.col(EMITTED) if EMITTED in rows.columns else F.lit(None).cast("string")
        seen = Observation()
        observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(stamp).alias("first"), F.max(stamp).alias("last"))
        numbered = observed.withColumn("ingest_seq", F.monotonically_increasing_id())
        numbered.write.mode("overwrite").parquet(f"{store}/stream_id={stream}/batch_id={batch_id}")
        entry = {"stream_id": stream, "batch_id": batch_id} | seen.get
        write_text(spark, f"{store}/{LEDGER}/{stream}-{batch_id}.json", json.dumps(entry))

    return write


def start_ingest(
    events: DataFrame, store: str, checkpoint: str, every: str | None = None, prepare: Prepare | None = None
) -> StreamingQuery:
    """Append a stream of events to the store; without ``every``, take what is there now and stop.

    ``prepare`` is applied to each micro-batch: what needs a whole batch, as reading columns by name or scoring in passes.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = batch_writer(store, prepare)
    return events.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(**trigger).start()

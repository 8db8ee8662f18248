"""Lifetime results of a stream without streaming state: each micro-batch is summed and merged with what was before.

A batch's results go to a folder of their own, ``stream_id=…/batch=…``, whose marker is written last. Results of
bounded size (category counts, a histogram grid, the latest rows) are merged with those of the batch before, so a reader takes the
last whole batch and finds all of them as of the same moment. Counts by a key without a bound, such as an
address, are written for the batch's own rows alone; readers sum them, and they are compacted while being read.
A batch delivered again reads the same predecessor and replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigilog.sinks.files import delete, found, write_text
from vigilog.streaming.ingest import Prepare, stream_id

#: Whole batches whose merged results stay, so that readers of an older one can finish.
KEPT = 10

#: So many batches of unmerged rows are read as they are; with more of them, they are compacted first.
PENDING = 16

_MARKER = "_COMMITTED"


@dataclass(frozen=True)
class Total:
    """``of`` sums a micro-batch (its rows and number); ``merge`` sums the rows of several such sums.

    ``bounded`` results are merged batch by batch; the others by their readers.
    """

    of: Callable[[DataFrame, int], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    bounded: bool = True


def _number(path: str) -> int:
    return int(path.rpartition("=")[2])


def _whole(spark: SparkSession, folder: str, kind: str = "batch") -> list[str]:
    """The whole batches of one stream, the last one first."""
    markers = [path.rpartition("/")[0] for _, path in found(spark, f"{folder}/{kind}=*/{_MARKER}")]
    return sorted(markers, key=_number, reverse=True)


def newest_stream(spark: SparkSession, folder: str) -> str | None:
    """The folder of the stream that committed last: one started over counts its batches from 0 again under a new id."""
    markers = sorted(found(spark, f"{folder}/stream_id=*/batch=*/{_MARKER}"))
    return markers[-1][1].rpartition("/batch=")[0] if markers else None


def totals_writer(folder: str, totals: Mapping[str, Total], prepare: Prepare | None = None, keep: int = KEPT) -> Callable:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{folder}/stream_id={stream_id(batch)}"
        before = [path for path in _whole(spark, own) if _number(path) < batch_id]
        rows = (batch if prepare is None else prepare(batch)).persist()  # every total reads them
        try:
            for name, total in totals.items():
                summed = total.of(rows, batch_id)
                if total.bounded and before:
                    summed = total.merge(spark.read.schema(summed.schema).parquet(f"{before[0]}/{name}").unionByName(summed))
                summed.write.mode("overwrite").parquet(f"{own}/batch={batch_id}/{name}")
        finally:
            rows.unpersist()
        write_text(spark, f"{own}/batch={batch_id}/{_MARKER}", "")
        for old in before[keep:]:
            for name, total in totals.items():
                if total.bounded:
                    delete(spark, f"{old}/{name}")

    return write


def start_totals(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    totals: Mapping[str, Total],
    every: str | None = None,
    prepare: Prepare | None = None,
) -> StreamingQuery:
    """Keep the totals of a stream below ``folder``; without ``every``, take what is there now and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = totals_writer(folder, totals, prepare)
    return events.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def compact(spark: SparkSession, stream: str, name: str, total: Total) -> None:
    """Sum the rows of all whole batches but the last into a base, and delete what only older readers could need.

    The last batch may be delivered again, so it isn't part of a base. Readers of the base before keep their files.
    """
    whole = _whole(spark, stream)
    bases = _whole(spark, stream, f"base-{name}")
    if len(whole) < 2 or (bases and _number(bases[0]) >= _number(whole[1])):
        return
    target = f"{stream}/base-{name}={_number(whole[1])}"
    _summed(spark, whole[1:], bases[:1], name, total).write.mode("overwrite").parquet(f"{target}/{name}")
    write_text(spark, f"{target}/{_MARKER}", "")
    for path in whole:
        if bases and _number(path) <= _number(bases[0]):
            delete(spark, f"{path}/{name}")
    for old in bases[1:]:
        delete(spark, old)


def _summed(spark: SparkSession, batches: list[str], bases: list[str], name: str, total: Total) -> DataFrame:
    after = _number(bases[0]) if bases else -1
    parts = [f"{path}/{name}" for path in [*bases, *[b for b in batches if _number(b) > after]]]
    return total.merge(spark.read.parquet(*parts))


def total_so_far(spark: SparkSession, folder: str, name: str, total: Total) -> DataFrame | None:
    """A total as of the last whole batch; None before the first."""
    stream = newest_stream(spark, folder)
    if stream is None:
        return None
    whole = _whole(spark, stream)
    if total.bounded:
        return spark.read.parquet(f"{whole[0]}/{name}")
    bases = _whole(spark, stream, f"base-{name}")
    if sum(_number(b) > (_number(bases[0]) if bases else -1) for b in whole) > PENDING:
        compact(spark, stream, name, total)
        bases = _whole(spark, stream, f"base-{name}")
    return _summed(spark, whole, bases[:1], name, total)

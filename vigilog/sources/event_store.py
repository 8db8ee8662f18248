"""The Parquet event store: one folder per stream and micro-batch, and a ledger with an entry for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.operators.ranking import latest
from vigilog.schema import ARRIVAL_SCHEMA, EMITTED, EVENT_SCHEMA
from vigilog.sources.csv_events import or_empty

#: Arrival order, most significant column first.
ARRIVAL = [EMITTED, "batch_id", "ingest_seq"]

LEDGER = "_ledger"
LEDGER_SCHEMA = "stream_id string, batch_id bigint, rows bigint, first string, last string"


def read_event_store(spark: SparkSession, store: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The stored events with their arrival columns; empty when nothing has been stored."""
    stored = T.StructType([*schema, *ARRIVAL_SCHEMA])
    return or_empty(lambda: spark.read.schema(stored).parquet(store), spark, stored)


def batch_ledger(spark: SparkSession, store: str) -> DataFrame:
    """Rows, and first and last arrival stamp, of every whole micro-batch in the store; no event is read."""
    schema = T.StructType.fromDDL(LEDGER_SCHEMA)
    return or_empty(lambda: spark.read.schema(schema).json(f"{store}/{LEDGER}"), spark, schema)


def newest_batches(ledger: DataFrame, n: int) -> DataFrame:
    """The batches that can hold one of the ``n`` rows with the latest stamps.

    The latest first stamps of which the batches have ``n`` rows together bound the stamps of those rows from below:
    a batch whose last stamp lies before that bound has none of them. Every batch has a row, so ``n`` of them bound it.
    """
    held = ledger.filter("rows > 0").withColumn("first", F.coalesce("first", F.lit("")))
    bound, rows = "", 0
    for row in held.orderBy(F.desc("first")).limit(n).collect():
        rows += row.rows
        if rows >= n:
            bound = row["first"]
            break
    return held.filter(F.coalesce("last", F.lit("")) >= bound)


def latest_rows(spark: SparkSession, store: str, n: int, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The ``n`` rows of the store that came last, from the folders of the batches that can hold them alone."""
    stored = T.StructType([*schema, *ARRIVAL_SCHEMA])
    batches = newest_batches(batch_ledger(spark, store), n).select("stream_id", "batch_id").collect()
    if not batches:
        return spark.createDataFrame([], stored)
    folders = [f"{store}/stream_id={b.stream_id}/batch_id={b.batch_id}" for b in batches]
    rows = spark.read.schema(stored).option("basePath", store).parquet(*folders)
    return latest(rows, ARRIVAL, n)

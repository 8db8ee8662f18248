"""From documents to token ids: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilog.llm.byte_bpe import round_trip
from vigilog.llm.decontamination import decontaminated
from vigilog.llm.near_duplicates import near_duplicates
from vigilog.llm.quality_classifier import accepted
from vigilog.llm.quality_rules import cascade
from vigilog.llm.shared import stored, table, work_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier predicts to be good; learns from all labels outside the held-out fold."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that no rule of the cascade rejects."""
    return cascade(docs).where("rejected_by is null").select(docs.columns)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, the one with the smallest id, a null id being the largest.

    Groups are of rows, not of ids: a row is known by its id and text, so rows that share an id, or have none, stay unless their
    texts are near copies of one that stays. Of rows equal in both one stays.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), "text")
    keyed = docs.withColumn("row_key", key)
    found = near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    ids = keyed.select("row_key", "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")
    kept = found.join(ids, "row_key").groupBy("component_id").agg(first).select(F.col("first.row_key").alias("row_key"))
    return keyed.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of every document's token ids and of the bytes they decode to."""
    return round_trip(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_removal),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: A fitted classifier and signatures have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Every stage is written to the shared folder and read again by the next."""
    folder = work_folder(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)

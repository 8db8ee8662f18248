"""Classifier quality from one confusion table, so predictions are computed once for all metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) pair: at most classes² rows after the map-side combine."""
    return scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class that is actual or predicted; an empty denominator gives 0.

    Each confusion cell counts once for its actual and once for its predicted class, which replaces a join.
    """
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), hit.alias("tp")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("tp")),
    )
    totals = pairs.select(F.inline(sides)).groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "tp")])

    def ratio(above, below):
        return F.coalesce(F.try_divide(above.cast("double"), below.cast("double")), F.lit(0.0))

    tp, support, guessed = F.col("tp"), F.col("support"), F.col("guessed")
    return totals.select(
        "cls",
        ratio(tp, guessed).alias("precision_"),
        ratio(tp, support).alias("recall_"),
        ratio(2 * tp, support + guessed).alias("f1"),
        "support",
        "tp",
    )


def class_summary(report: DataFrame) -> DataFrame:
    """Accuracy, and macro and support-weighted averages of precision, recall and F1: one row."""
    rows = F.sum("support")

    def weighted(column: str):
        return F.sum(F.col(column) * F.col("support")) / rows

    return report.agg(
        (F.sum("tp") / rows).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c.rstrip('_')}") for c in ("precision_", "recall_", "f1")],
        *[weighted(c).alias(f"weighted_{c.rstrip('_')}") for c in ("precision_", "recall_", "f1")],
        rows.alias("support"),
    )


def printed_report(pairs: DataFrame) -> DataFrame:
    """The whole report as one frame: a row per class, then accuracy, macro and weighted averages."""
    classes = class_report(pairs)
    one, size = F.lit(1.0), F.col("support").cast("double")
    hit_rate = F.try_divide(F.col("tp").cast("double"), size)

    def line(kind, name, precision, recall, f1, weight):
        return F.struct(
            F.lit(kind).alias("kind"), name.cast("string").alias("name"), precision.alias("precision_"), recall.alias("recall_"),
            f1.alias("f1"), F.col("support"), weight.alias("weight"),
        )

    p, r, f = F.col("precision_"), F.col("recall_"), F.col("f1")
    lines = F.array(
        line("class", F.col("cls"), p, r, f, one),
        line("average", F.lit("accuracy"), hit_rate, hit_rate, hit_rate, size),
        line("average", F.lit("macro avg"), p, r, f, one),
        line("average", F.lit("weighted avg"), p, r, f, size),
    )

    def mean(column):
        return F.sum(F.col(column) * F.col("weight")) / F.sum(F.when(F.col(column).isNotNull(), F.col("weight")))

    return (
        classes.select(F.inline(lines))
        .groupBy("kind", "name")
        .agg(*[mean(c).alias(c) for c in ("precision_", "recall_", "f1")], F.sum("support").alias("support"))
    )

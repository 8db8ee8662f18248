"""A regularised quadratic discriminant over transformed statistics of the text.

Each class gets a mean and a covariance, summed over all labelled rows in one aggregate. The covariance is shrunk
towards the pooled one and then towards its diagonal. A score is the logistic of the difference of the two
log-densities plus the log prior odds; the Mahalanobis distances come from the inverse Cholesky factors, which are computed
once on the driver (they are as large as the number of statistics, not the data) and stand in the expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vigilog.llm import measures as m
from vigilog.llm.shared import stored, work_folder

TO_POOLED = 0.05
TO_DIAGONAL = 0.05
RIDGE = 1e-4
CUT = 0.5


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text with ``words`` and ``lines`` beside it, each transformed to be closer to normal."""
    n, chars = F.size("words"), F.length(text)
    share = lambda x, of: F.sqrt(x / F.greatest(of, F.lit(1)))
    upper = m.count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return {
        "length": F.log1p(n),
        "symbols": share(m.count_of(text, m.SYMBOLS), n),
        "exclamations": share(m.count_of(text, "!"), n),
        "capitals": share(upper, chars),
        "digits": share(m.count_of(text, "0123456789"), chars),
        "stops": share(m.count_of(text, ".,;:?"), n),
        "word_length": F.log1p(F.length(F.translate(text, m.GAPS, "")) / F.greatest(n, F.lit(1))),
        "variety": F.log1p(F.size(F.array_distinct("words"))) / F.log1p(F.greatest(n, F.lit(1))),
        "line_length": F.log1p(n / F.greatest(F.size("lines"), F.lit(1))),
    }


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and offset; ``prior`` is the score where a class could not be fitted."""

    names: tuple[str, ...]
    means: np.ndarray | None
    factors: np.ndarray | None
    offset: float
    prior: float

    def score(self) -> Column:
        if self.factors is None:
            return F.lit(self.prior)
        distances = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            centred = [F.col(n) - float(x) for n, x in zip(self.names, mean, strict=True)]
            rows = [sum((float(factor[i, j]) * centred[j] for j in range(i + 1)), F.lit(0.0)) for i in range(len(centred))]
            distances.append(sum((F.pow(r, 2) for r in rows), F.lit(0.0)))
        log_odds = (distances[0] - distances[1]) / 2 + self.offset
        return 1 / (1 + F.exp(-F.greatest(F.least(log_odds, F.lit(700.0)), F.lit(-700.0))))


def with_statistics(docs: DataFrame, *carried: Column) -> DataFrame:
    """The carried columns and the statistics of each whole text."""
    text, names = F.col("text"), [f"carried_{i}" for i in range(len(carried))]
    base = docs.select(*[c.alias(n) for c, n in zip(carried, names, strict=True)], m.text_of(text).alias("text"))
    base = base.select(*names, "text", m.words_of(text).alias("words"), m.lines_of(text).alias("lines"))
    return base.select(*names, *[c.cast("double").alias(n) for n, c in statistics(text).items()])


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text."""
    return with_statistics(docs, F.col("doc_id")).withColumnRenamed("carried_0", "doc_id")


def fit(rows: DataFrame, names: tuple[str, ...], label: str) -> Discriminant:
    """The discriminant of rows with the statistics and a label of 0 or 1; other labels are left out."""
    pairs = [(a, b) for a in range(len(names)) for b in range(a + 1)]
    sums = rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(x) for x in names]).alias("x"),
        F.array(*[F.sum(F.col(names[a]) * F.col(names[b])) for a, b in pairs]).alias("xx"),
    )
    found = {r[label]: r for r in sums.collect()}
    counts = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    prior = counts[1] / sum(counts) if sum(counts) else 0.5
    if min(counts) < 2:
        return Discriminant(names, None, None, 0.0, prior)
    means, covariances = [], []
    for k in (0, 1):
        mean = np.array(found[k]["x"]) / counts[k]
        second = np.zeros((len(names), len(names)))
        for (a, b), v in zip(pairs, found[k]["xx"], strict=True):
            second[a, b] = second[b, a] = v / counts[k]
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
    pooled = (counts[0] * covariances[0] + counts[1] * covariances[1]) / sum(counts)
    factors, log_dets = [], []
    for own in covariances:
        shrunk = (1 - TO_POOLED) * own + TO_POOLED * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + TO_DIAGONAL * np.diag(np.diag(shrunk)) + RIDGE * np.eye(len(names))
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    offset = (log_dets[0] - log_dets[1]) / 2 + np.log(counts[1] / counts[0])
    return Discriminant(names, np.array(means), np.array(factors), float(offset), prior)


def held_out(doc_id: Column) -> Column:
    """True for the rows no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs`` (doc_id, text).

    Learns from ``labels`` (doc_id, quality) outside the held-out fold, from all of them. A null or empty text is scored
    by its statistics, which are those of no words. A null doc_id is held out. A label that occurs twice counts twice; a
    null label is left out. With fewer than two labelled rows in a class every score is the share of label 1 (0.5 without
    labels). Other columns of either table are ignored.
    """
    folder = work_folder(docs.sparkSession, "quality-classifier")
    rows = stored(text_statistics(docs), folder, "statistics")
    names = tuple(rows.columns[1:])
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))
    model = fit(rows.join(known, "doc_id"), names, "label")
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text the classifier predicts to be of quality 1, with all their columns.

    Learns as ``quality_scores`` does. The rows are written once with their statistics, so that each text is measured
    once; learning reads the statistics alone, and no text is shuffled.
    """
    folder = work_folder(docs.sparkSession, "quality-classifier")
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))
    measured = with_statistics(docs, F.struct(*docs.columns)).withColumnRenamed("carried_0", "row")
    rows = stored(measured, folder, "measured")
    names = tuple(rows.columns[1:])
    model = fit(rows.select(F.col("row.doc_id").alias("doc_id"), *names).join(known, "doc_id"), names, "label")
    return rows.where(model.score() >= CUT).select("row.*")

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import words
from pyspark.sql import functions as F

from vigilog.llm import quality_classifier as qc
from vigilog.llm import quality_rules as qr


def base(text: str | None) -> tuple:
    text = text or ""
    w = words(text, lower=False)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_counts(documents, awkward):
    for docs in (documents, awkward):
        texts = sorted((str(r.doc_id), *base(r.text)) for r in docs.collect())
        found = qr.quality_verdicts(docs).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == texts
        for r in found:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_the_verdict_does_not_hang_on_the_order(documents):
    text = qr.Facts.of(qr.m.text_of(F.col("text")))
    forth = documents.select("doc_id", qr.first_failure(text, qr.RULES).isNull().alias("kept"))
    back = documents.select("doc_id", qr.first_failure(text, qr.RULES[::-1]).isNull().alias("kept"))
    want = sorted(map(tuple, forth.collect()))
    assert sorted(map(tuple, back.collect())) == want
    assert sorted((r.doc_id, r.rejected_by is None) for r in qr.cascade(documents).collect()) == want


def test_rules_come_by_rejection_per_cost(documents):
    order = qr.ordered(qr.RULES, documents)
    gains = [x["rejected"] / x["seconds"] for x in order]
    assert gains == sorted(gains, reverse=True) and {x["rule"].name for x in order} == {r.name for r in qr.RULES}


def test_good_labels_pass_the_rules(documents, labels):
    judged = qr.quality_verdicts(documents).join(labels, "doc_id").where("not base_failed")
    good = judged.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.99


def test_rules_on_empty_tables(empty):
    assert qr.quality_verdicts(empty).count() == 0 and qr.cascade(empty).count() == 0


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = qc.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    good, bad = ([r.score for r in held if r.quality == k] for k in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None, :]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_labels_of_the_held_out_fold_are_not_learnt(documents, labels):
    turned = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in qc.quality_scores(documents, x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_scores_equal_the_density_difference(spark):
    """The expression against densities computed with NumPy from the same moments."""
    random = np.random.default_rng(2)
    x = np.concatenate([random.normal(0, 1, (60, 2)), random.normal(2, 0.5, (140, 2))])
    rows = spark.createDataFrame([(float(a), float(b), int(i >= 60)) for i, (a, b) in enumerate(x)], "a double, b double, label int")
    model = qc.fit(rows, ("a", "b"), "label")
    logs = []
    for k in (0, 1):
        centred = (x - model.means[k]) @ model.factors[k].T
        logs.append(-0.5 * (centred**2).sum(1) + np.log(np.diag(model.factors[k])).sum() + np.log([60, 140][k]))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    found = [r[0] for r in rows.select(model.score()).collect()]
    assert np.allclose(sorted(found), sorted(want))


def test_classifier_on_awkward_rows(spark, awkward, empty, labels, no_labels):
    found = qc.quality_scores(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.held_out for r in found if r.doc_id is None} == {True}
    assert {r.score for r in qc.quality_scores(awkward, no_labels).collect()} == {0.5}
    assert qc.quality_scores(empty, labels).count() == 0
    assert qc.accepted(awkward, labels).columns == awkward.columns
    odd = spark.createDataFrame([(1, None), (6, 1), (6, 1), (None, 0), (8, 0)], "doc_id long, quality int")
    assert qc.quality_scores(awkward, odd).count() == awkward.count()

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vigilog.llm.source_mix import mixed_sizes, mixture, row_keys, targets


def filled(sizes: dict, weights=(5, 2, 1), budget=1.0, most=3) -> dict:
    """Targets by sharing again and again what is over."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()) * budget, set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else weight[s] * left / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (1 + i % 37), f"s{i % 7}" if i % 11 else None) for i in range(1200)]
    rows += [(i, "hot " * 9, "hot") for i in range(2000, 2900)] + [(9000, "tiny", "a"), (9001, None, "b"), (9002, " \n", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize(("weights", "budget", "most"), [((5, 2, 1), 1.0, 3), ((1,), 0.5, 1), ((9, 1), 2.5, 3)])
def test_targets_by_repeated_sharing(spark, docs, weights, budget, most):
    sizes: dict = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    frame = spark.createDataFrame([("" if s is None else f"={s}", n) for s, n in sizes.items()], "s string, source_size long")
    want = filled(sizes, weights, budget, most)
    for r in targets(frame, weights, budget, most).collect():
        assert r.target == pytest.approx(want[r.s[1:] if r.s else None], abs=1)


def test_every_source_comes_near_its_target(docs):
    found = mixed_sizes(docs).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    by: dict = {}
    for r in found:
        assert r.size == words(r.text) and r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert {r.source_size for r in rows} == {sum(r.size for r in rows)}
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)


def test_the_threshold_is_a_prefix_of_the_sorted_keys(docs):
    keys = {r.doc_id: r.key for r in docs.select("doc_id", *[c.alias(n) for n, c in row_keys(docs).items()]).collect()}
    by: dict = {}
    for r in mixed_sizes(docs).join(docs.select("doc_id", "source"), "doc_id").where("size > 0").collect():
        by.setdefault(r.source, []).append((keys[r.doc_id], r.taken // r.size))
    for rows in by.values():
        copies = [n for _, n in sorted(rows)]
        assert copies == sorted(copies, reverse=True)


def test_a_larger_budget_takes_a_superset(docs):
    small, large = ({r.doc_id: r.taken for r in mixed_sizes(docs, budget=b).collect()} for b in (0.4, 0.6))
    assert all(small[i] <= large[i] for i in small) and sum(small.values()) < sum(large.values())


def test_reruns_and_layouts_agree(docs):
    first = sorted(tuple(r) for r in mixed_sizes(docs).collect())
    assert first == sorted(tuple(r) for r in mixed_sizes(docs.repartition(7)).collect())


def test_equal_rows_are_cut_one_by_one(spark):
    docs = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("x").alias("source"))
    docs = docs.union(spark.createDataFrame([(1, "w " * 500, "y")], docs.schema))
    taken = mixed_sizes(docs).groupBy("source_size").agg(F.sum("taken"), F.first("target")).collect()
    assert all(abs(r[1] - r[2]) <= (3 if r.source_size == 1500 else 500) for r in taken)


def test_the_mixture_holds_the_rows(docs):
    named = docs.select("*", F.lit(1).alias("key"), F.lit("z").alias("size"), F.lit(2).alias("copies"))
    plan = mixed_sizes(docs).where("size > 0")
    want = {(r.doc_id, r.taken // r.size) for r in plan.collect() if r.taken}
    mixed = mixture(named)
    assert mixed.columns == named.columns
    found = {(r.doc_id, r["count"]) for r in mixed.where("text is not null and trim(text) not in ('', '\n')").groupBy("doc_id").count().collect()}
    assert found == want


def test_awkward_rows(awkward, empty):
    rows = mixed_sizes(awkward).collect()
    assert len(rows) == awkward.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(rows[0].target, abs=30_000)
    assert mixed_sizes(empty).count() == 0 and mixture(empty).count() == 0
    assert mixed_sizes(awkward.drop("source", "doc_id")).count() == awkward.count()

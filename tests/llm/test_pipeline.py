from __future__ import annotations

import corpus_pipeline
from llm_helpers import LLM_SMALL, shingles

from vigilog.llm import queries


def one_of_each(docs) -> list:
    """The (id, text) pairs that stay, by comparing all texts: the smallest id of each group of near copies."""
    pairs = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect()})
    sets, group = [shingles(t) for _, _, t in pairs], list(range(len(pairs)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [p for i, p in enumerate(pairs) if group[i] == i]


def test_repeated_and_missing_ids_lose_no_text(spark, documents):
    """Rows that share an id and have texts of their own stay; exact copies without an id go."""
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[1] + " more"), (None, texts[2]), (None, texts[2]), (None, texts[3]), (3, texts[4]), (None, texts[4]), (4, None), (5, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], documents.schema)
    out = corpus_pipeline.near_duplicate_removal(spark, docs, LLM_SMALL)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect())
    assert found == one_of_each(docs) == sorted([(False, 1, texts[0]), (False, 1, texts[1]), (True, 0, texts[2]), (True, 0, texts[3]), (False, 3, texts[4]), (False, 4, ""), (False, 5, ""), (True, 0, "")])


def test_stages_one_by_one(spark, documents, awkward):
    """Every stage returns rows of its input, unchanged; the groups keep one document each and no benchmark item is left."""
    items = [shingles(r.text) for r in spark.read.parquet(f"{LLM_SMALL}/benchmark.parquet").collect()]
    for docs in (documents, awkward):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, LLM_SMALL)
            assert out.columns == docs.columns
            rows, before = [tuple(r) for r in out.collect()], {tuple(r) for r in docs.collect()}
            assert set(rows) <= before
            if name == "near_duplicates":
                assert sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows) == one_of_each(docs)
            docs = spark.createDataFrame(rows, docs.schema)
        for text in (r.text for r in docs.collect()):
            assert not any(100 * len(s & shingles(text)) >= 75 * len(s) for s in items)


def test_the_whole_run(spark):
    found = corpus_pipeline.run(spark, LLM_SMALL).collect()
    assert 100 < len(found) < 200 and all(r.ids_sha256 and r.decoded_sha256 for r in found)


def test_a_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from llm_helpers import LLM_SMALL

from vigilog.llm import ranked_search
from vigilog.llm.ranked_search import ranked

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, kept=20):
    """(item_id, rank, doc_id, score), by the formula of the contract."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in items:
        asked, scores = Counter(terms(text)), []
        for doc_id, c, n in counts:
            m = 75 + (25 * n * n_docs) // n_words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(s for s in scores if s[0] < 0)[:kept], 1)]
    return sorted(out, key=str)


def pairs(frame, key):
    return [(r[key], r.text) for r in frame.select(key, "text").collect()]


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{LLM_SMALL}/benchmark.parquet")


def test_equal_to_the_formula(documents, items):
    assert found(ranked(documents, items)) == brute(pairs(documents, "doc_id"), pairs(items, "item_id"))


@pytest.mark.parametrize("setting", [{"BLOCK_BYTES": 4000}, {"MOST_TERMS": 0}, {"BUNDLE_ITEMS": 7}, {"SENT_BYTES": 0, "BUNDLE_ITEMS": 5}])
def test_the_other_ways_give_the_same(documents, items, monkeypatch, setting):
    """Many blocks, an index of all terms, many bundles, bundles joined by shuffle."""
    for name, value in setting.items():
        monkeypatch.setattr(ranked_search, name, value)
    assert found(ranked(documents, items, kept=5)) == brute(pairs(documents, "doc_id"), pairs(items, "item_id"), kept=5)


def test_ties_and_a_term_in_every_document(spark):
    docs = spark.createDataFrame([(i, "common word" + " rare" * (i % 50 == 0)) for i in range(300, 0, -1)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Common rare"), (2, "word"), (3, "WORD common common")], "item_id long, text string")
    got = found(ranked(docs, items))
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert [r[2] for r in sorted(got) if r[0] == 1][:6] == [50, 100, 150, 200, 250, 300]


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, "a b b"), (1, "a b b"), (None, "ünï Word"), (3, None), (4, ""), (5, "zz")], "item_id long, text string")
    assert found(ranked(awkward, items)) == brute(pairs(awkward, "doc_id"), pairs(items, "item_id"))
    assert ranked(empty, items).count() == 0 and ranked(awkward, items.limit(0)).count() == 0
    assert ranked(awkward.limit(2), items).count() == 0

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vigilog.llm import phrases
from vigilog.llm.phrases import collocations

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, longest=3, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    f: dict = {}
    for lang, text in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            counts.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = set()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 50 * counts[p[i : i + k]]:
                        held.add(p[i : i + k])
        rows_of = []
        for p, a in cands.items():
            if p not in held:
                score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows_of.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(frame):
    return [(r.lang, r.text) for r in frame.select("lang", "text").collect()]


def test_equal_to_counting_everything(documents):
    assert found(collocations(documents)) == brute(texts(documents))


@pytest.mark.parametrize(("least", "longest", "shards"), [(3, 2, 1), (2, 4, 3), (25, 3, 7)])
def test_other_thresholds_lengths_and_shards(documents, least, longest, shards):
    got = collocations(documents, least=least, longest=longest, top=300, n_shards=shards)
    assert found(got) == brute(texts(documents), least, longest, top=300)


def test_few_slots_change_nothing(documents, monkeypatch):
    """Phrases that share a slot are counted too early or in vain; a small hold makes many rows for each owner."""
    monkeypatch.setattr(phrases, "HELD", 500)
    assert found(collocations(documents, slots=64)) == brute(texts(documents))


def grams(text: bytes):
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
    return list(phrases._grams([batch], 3))


def test_parts_of_many_phrases():
    """Several stretches of texts: every phrase keeps its own keys."""
    texts = sorted(f"word{i} and{'' if i % 3 else ' more'}".encode() for i in range(150_000))
    joined = b"\n".join(texts)
    blobs = pa.table({"size": [len(joined)], "texts": [pa.compress(joined, codec="zstd", asbytes=True)]})
    keys = {k: np.sort(np.concatenate([x[5][k][x[6][k]] for x in grams(joined)])) for k in range(3)}
    state = [keys[k] for k in range(3)] + [np.where(np.arange(len(keys[k])) >= 0, 10, 0) for k in range(3)]
    found = phrases._parts_of(lambda owner: state, 3, 10)((pa.scalar(0), pa.scalar("en")), blobs).to_pylist()
    assert sorted(r["phrase"].encode() for r in found) == texts and len({r["key"] for r in found}) == len(texts)
    by = {r["phrase"]: r for r in found}
    for r in found[:1000] + found[-1000:]:
        words = r["phrase"].split()
        assert len(r["lefts"]) == len(r["rights"]) == len(words) - 1 and len(r["inner"]) == (2 if len(words) == 3 else 0)
        assert r["rights"][-1] in {by["word1 and"]["rights"][0], by["word0 and more"]["rights"][-1]}


def test_a_phrase_that_starts_late_is_counted_from_the_beginning(spark):
    rows = [(i, ("x y z " if i % 4 == 3 else "x . y . z ") * 3, "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert found(collocations(docs)) == brute(texts(docs))


def test_awkward_rows(spark, awkward, empty):
    assert found(collocations(awkward, least=2)) == brute(texts(awkward), least=2)
    assert collocations(empty).count() == 0 and collocations(awkward.limit(2)).count() == 0
    marks = [(1, "A b\tc d\n" * 11 + "é É " * 12, "fr"), (2, "a b; a b: a b! a b? a b, " * 9, None), (3, "p" * 3_000_000 + " q r" * 600_000, "long")]
    docs = spark.createDataFrame(marks, "doc_id long, text string, lang string")
    assert found(collocations(docs)) == brute(texts(docs))
    assert found(collocations(docs.drop("lang").where("doc_id = 2"))) == brute([(None, marks[1][1])])

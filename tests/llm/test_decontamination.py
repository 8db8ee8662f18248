from __future__ import annotations

from random import Random

from llm_helpers import shingles

from vigilog.llm.decontamination import contained_items, decontaminated


def brute(docs, benchmark):
    items = {(r.item_id, r.text) for r in benchmark.collect() if r.item_id is not None and shingles(r.text)}
    found = []
    for r in docs.collect():
        own = shingles(r.text)
        found += [(r.doc_id, i, len(s & own), len(s)) for i, t in items for s in [shingles(t)] if 100 * len(s & own) >= 75 * len(s)]
    return sorted(found, key=str)


def got(frame):
    return sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in frame.collect()), key=str)


def _benchmark(spark, documents):
    """Whole items, items with changed words, an item in two halves, short ones, nulls and repeated rows."""
    texts = [r.text for r in documents.orderBy("doc_id").collect()]
    rows = [(i, " ".join(texts[i].split()[: 8 + 7 * i])) for i in range(1, 30)]
    rows += [(100 + i, " ".join("x" if j % 23 == 22 else w for j, w in enumerate(t.split()[3:60]))) for i, t in enumerate(texts[40:80])]
    rows += [(200, " ".join(texts[90].split()[:40])), (200, " ".join(texts[90].split()[:40])), (201, "one"), (202, None), (203, ""), (None, texts[3])]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_brute_force(spark, documents, awkward):
    benchmark = _benchmark(spark, documents)
    docs = documents.select("doc_id", "text").union(awkward.select("doc_id", "text"))
    want = brute(docs, benchmark)
    assert len(want) > 40 and got(contained_items(docs, benchmark)) == want
    assert got(contained_items(docs, benchmark, most_bytes=1 << 14)) == want  # several passes


def test_the_clean_rows_stay_whole(spark, documents, awkward):
    benchmark = _benchmark(spark, documents)
    bad = {d for d, *_ in brute(awkward, benchmark)}
    left = decontaminated(awkward, benchmark)
    assert left.columns == awkward.columns
    want = sorted((tuple(r) for r in awkward.collect() if r.doc_id not in bad), key=str)
    assert sorted(map(tuple, left.collect()), key=str) == want and bad == {4, 5}


def test_empty_tables(spark, documents, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(documents, none).count() == 0
    assert decontaminated(documents, none).count() == documents.count()
    assert contained_items(empty, _benchmark(spark, documents)).count() == 0


def test_short_items_inside_long_documents(spark):
    """Items of 5 to 14 words, whole or with the last word changed, also such whose halves stand apart."""
    random = Random(7)
    texts = [[f"w{random.randrange(5000)}" for _ in range(2500)] for _ in range(8)]
    items = []
    for i in range(1200):
        at, n = random.randrange(2400), 5 + i % 10
        own = texts[i % 8][at : at + n]
        items.append((i, " ".join(own if i % 3 else [*own[:-1], "x"])))
    halves = "a b c d e f g h i j k l".split()
    texts[0] += halves[:9] + ["x"] * 300 + halves[3:]
    items.append((2000, " ".join(halves)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, benchmark)
    assert len(want) > 800 and (0, 2000, 8, 8) in want and got(contained_items(docs, benchmark)) == want

from __future__ import annotations

import math
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LLM_SMALL, words

from vigilog.llm import kneser_ney as kn, queries
from vigilog.llm.shared import release, work_folder


def discounts(counts) -> list[float]:
    n = Counter(counts)
    if not all(n[i] for i in (1, 2, 3, 4)):
        return [0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    return [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3)]


class Brute:
    def __init__(self, texts):
        tokens = [[*words(t), None] for t in texts]
        self.count = Counter(w for t in tokens for w in t)
        self.pairs = Counter(p for t in tokens for p in zip(["<begin>", *t], t, strict=False))
        self.before = Counter(w for _, w in self.pairs)
        self.of = defaultdict(lambda: [0, 0, 0, 0])
        for (a, _), n in self.pairs.items():
            self.of[a][0] += n
            self.of[a][min(n, 3)] += 1
        self.d2, self.d1 = discounts(self.pairs.values()), discounts(self.before.values())
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.spare = sum(self.d1[min(n, 3)] for n in self.before.values()) / max(len(self.pairs), 1)

    def lower(self, w):
        if not self.pairs:
            return 1 / (self.v + 1)
        n = self.before[w]
        return (n - self.d1[min(n, 3)] if n else 0) / len(self.pairs) + self.spare / (self.v + 1)

    def p(self, a, w):
        if a not in self.of:
            return self.lower(w)
        total, *seen = self.of[a]
        n = self.pairs[a, w]
        return (n - self.d2[min(n, 3)] if n else 0) / total + sum(d * s for d, s in zip(self.d2[1:], seen, strict=True)) / total * self.lower(w)

    def scores(self, text):
        t = [*words(text), None]
        base = sum(math.log10((self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        return len(t), sum(self.count[w] > 0 for w in t), base, sum(math.log10(self.p(a, w)) for a, w in zip(["<begin>", *t], t, strict=False))


def compare(docs, found):
    rows = docs.collect()
    brute = Brute([r.text for r in rows if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 != 1])
    want = sorted(((str(r.doc_id), *brute.scores(r.text)) for r in rows))
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in found)
    for a, b in zip(want, got, strict=True):
        assert a[:3] == b[:3] and b[3] == pytest.approx(a[3], rel=1e-6) and b[4] == pytest.approx(a[4], rel=1e-6)
    assert {r.train_tokens for r in found} <= {brute.n}
    return brute


def test_equals_brute_force(documents):
    found = kn.language_scores(documents).collect()
    brute = compare(documents, found)
    vocabulary = [*brute.count, "never seen"]
    assert sum(brute.p("the", w) for w in vocabulary) == pytest.approx(1)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_shards_and_small_blocks(documents, monkeypatch):
    """More shards, hot contexts spread over them, and several blocks a task give the same scores."""
    monkeypatch.setattr(kn, "HELD_TOKENS", 5000)
    docs = documents.withColumn("held_out", kn.held_out(documents.doc_id))
    model = kn.train(docs.where("not held_out").select("text"), work_folder(documents.sparkSession, "test"), shard_bytes=20_000)
    assert model.bits >= 4 and len(model.hot) > 5
    compare(documents, kn.scored(docs, model).collect())


def test_awkward_rows(spark, awkward, empty):
    compare(awkward, kn.language_scores(awkward).collect())
    assert kn.language_scores(empty).count() == 0
    none = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    found = kn.language_scores(none).collect()
    assert {r.train_tokens for r in found} == {0} and {r.score for r in found} == {0.0}


def test_parts_split_the_shuffle(documents):
    """Every gram is counted in one of the parts, and a part hands over about its share of the bytes."""
    texts = [pa.record_batch([pa.array([r.text for r in documents.collect()])], names=["text"])]
    hot, whole, split = np.array([kn.BEGIN]), {}, []
    for shard, blob in kn._blobs(kn._count_grams(3, 4, hot)(texts)):
        whole[shard] = blob
    for part in range(4):
        split.append(dict(kn._blobs(kn._count_grams(3, 4, hot, part, 4)(texts))))
        assert {s >> 2 for s in split[-1]} == {part}
    assert {s: b for x in split for s, b in x.items()} == whole and sum(map(len, split)) == len(whole)
    assert max(sum(map(len, x.values())) for x in split) < 0.5 * sum(map(len, whole.values()))


def test_contexts_followed_once_are_not_stored(documents):
    """Contexts with the sums 1, 1, 0, 0 take no place; that they were seen is known from the grams below."""
    texts = documents.where(~kn.held_out(documents.doc_id)).select("text")
    model = kn.train(texts, work_folder(documents.sparkSession, "test"), shard_bytes=20_000, order=3)
    store, place = kn.fs.FileSystem.from_uri(model.folder)
    names = [f.base_name for f in store.get_file_info(kn.fs.FileSelector(place)) if f.base_name.startswith(("contexts", "spread2-", "spread3-"))]
    shards = [kn._mapped(model.folder, name, 4) for name in names]
    assert len(shards) > 16 and not any(len(s.usual[1]) for s in shards)
    assert sum(len(s.rest[1]) for s in shards) > 100


def test_finished_shuffles_are_gone_before_the_next_part(spark, documents, monkeypatch):
    """While a part is counted, the shuffles of the parts before it are not on the disk any more."""
    folders = [Path(f.getPath()) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: sum(f.stat().st_size for folder in folders for f in folder.glob("*/shuffle_*.data") if f.exists())
    texts, left = documents.select("text"), []
    handed = kn._count_grams(3, 4, np.array([kn.BEGIN]))(texts.toArrow().to_batches())
    part = sum(len(blob) for _, blob in kn._blobs(handed)) / kn.PARTS

    def letting_go(session):
        release(session)
        deadline = time.time() + 5
        while shuffled() - before > part / 4 and time.time() < deadline:  # Spark deletes them in a thread of its own
            time.sleep(0.1)
        left.append(shuffled() - before)

    release(spark)
    time.sleep(1)
    before = shuffled()
    monkeypatch.setattr(kn, "release", letting_go)
    kn.train(texts, work_folder(spark, "test"), shard_bytes=20_000, order=3)
    assert len(left) > kn.PARTS and max(left[: kn.PARTS + 1]) < part / 4  # after the words and after each part


def test_tokens_are_searched_in_hot_words_alone(documents, monkeypatch):
    """A run over a part of the shards does not look up each token among all words of its block."""
    texts, hot = documents.select("text").toArrow().to_batches(), np.array([kn.BEGIN])
    n = sum(len(tokens) for tokens, _ in kn._token_blocks(texts))
    search, asked = np.searchsorted, []
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *x, **y: asked.append((len(a), np.size(v))) or search(a, v, *x, **y))
    list(kn._count_grams(3, 4, hot, 0, 4)(texts))
    assert n > 10_000 and sum(v for a, v in asked if a > len(hot)) < n / 2


def test_keys_of_many_shards_are_looked_up_together(monkeypatch, tmp_path):
    """The values are those of a dictionary, with shards that are missing and shards asked in several goes; a bucket holds few keys."""
    rng, bits, folder = np.random.default_rng(5), 6, f"file://{tmp_path}"
    keys = np.unique(rng.integers(0, 2**64, 200_000, dtype=np.uint64))
    counts = np.where(rng.random(len(keys)) < 0.6, 1, rng.integers(1, 700, len(keys)))
    shards = [(s, at) for s, at in kn._by_shard(keys, bits) if s not in (0, 7, 8, 63)]
    for s, at in shards:
        kn._save(folder, f"x-{s:07d}", bits, keys[at], counts[at])
    known = {int(k): int(c) for s, at in shards for k, c in zip(keys[at], counts[at], strict=True)}
    model = kn.Model(folder, bits, None, (), None, keys[:0], 1.0)
    asked = np.unique(np.concatenate([rng.choice(keys, 20_000), rng.choice(keys, 500) ^ np.uint64(1), rng.integers(0, 2**64, 9000, dtype=np.uint64)]))
    want = [known.get(k, 0) for k in asked.tolist()]
    together, goes = kn.look_up, []
    monkeypatch.setattr(kn, "look_up", lambda shards, *x: goes.append(len(shards)) or together(shards, *x))
    assert model.look_up("x", asked).tolist() == want and len(goes) < len(shards) / 10
    monkeypatch.setattr(kn, "LOOKED_UP", 100)
    assert model.look_up("x", asked).tolist() == want and max(goes[1:]) < 4
    assert model.look_up("x", asked[:0]).tolist() == [] and model.look_up("nothing", asked[:9]).tolist() == [0] * 9
    own = keys[shards[0][1]]
    begins, low, _ = kn._key_table(own, bits)
    assert begins[-1] == len(low) == len(own) <= 4 * (len(begins) - 1)


class BruteOfOrder:
    """Any order by its definition: raw counts at the top, numbers of different words before at the orders below."""

    def __init__(self, texts, order):
        self.order = order
        padded = [["<begin>"] * (order - 1) + [*words(t), None] for t in texts]
        grams = Counter(tuple(t[i : i + order]) for t in padded for i in range(len(t) - order + 1))
        self.levels = {order: grams}
        for m in range(order - 1, 0, -1):
            self.levels[m] = Counter(g[1:] for g in self.levels[m + 1])
        self.d = {m: discounts(c.values()) for m, c in self.levels.items()}
        self.vocabulary = {g[-1] for g in grams}
        self.of = defaultdict(lambda: [0, 0])
        for m, c in self.levels.items():
            for g, n in c.items():
                self.of[g[:-1]][0] += n
                self.of[g[:-1]][1] += self.d[m][min(n, 3)]

    def p(self, context, w):
        m = len(context) + 1
        lower = self.p(context[1:], w) if context else 1 / (len(self.vocabulary) + 1)
        if context not in self.of:
            return lower
        n, (total, spare) = self.levels[m][(*context, w)], self.of[context]
        return (n - self.d[m][min(n, 3)] if n else 0) / total + spare / total * lower

    def score(self, text):
        t = ["<begin>"] * (self.order - 1) + [*words(text), None]
        return sum(math.log10(self.p(tuple(t[i : i + self.order - 1]), t[i + self.order - 1])) for i in range(len(t) - self.order + 1))


@pytest.mark.parametrize(("order", "shard_bytes"), [(3, 20_000), (4, 1 << 24)])
def test_higher_orders(documents, awkward, monkeypatch, order, shard_bytes):
    """Contexts of several words, spread or not, over many shards or one."""
    monkeypatch.setattr(kn, "HELD_TOKENS", 5000)
    docs = documents.select("doc_id", "text").union(awkward.select("doc_id", "text").where("doc_id <> 8"))
    docs = docs.withColumn("held_out", kn.held_out(docs.doc_id))
    rows = docs.collect()
    brute = BruteOfOrder([r.text for r in rows if not r.held_out], order)
    assert sum(brute.p(("of", "the", "a")[: order - 1], w) for w in [*brute.vocabulary, "never seen"]) == pytest.approx(1)
    model = kn.train(docs.where("not held_out").select("text"), work_folder(documents.sparkSession, "test"), shard_bytes, order)
    found = sorted((str(r.doc_id), r.score) for r in kn.scored(docs, model).collect())
    want = sorted((str(r.doc_id), brute.score(r.text)) for r in rows)
    assert [d for d, _ in found] == [d for d, _ in want]
    assert [x for _, x in found] == pytest.approx([x for _, x in want], rel=1e-6)


def test_the_query_looks_further_back_than_one_word(spark, documents):
    """The registered query tells apart what a bigram model cannot."""
    found = {r.doc_id: r.score for r in queries.QUERIES["op2_kneser_ney"](spark, LLM_SMALL).collect()}
    bigram = {r.doc_id: r.score for r in kn.language_scores(documents).collect()}
    assert found.keys() == bigram.keys() and sum(abs(found[i] - bigram[i]) > 0.01 for i in found) > len(found) / 2

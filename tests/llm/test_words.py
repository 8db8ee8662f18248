from __future__ import annotations

import numpy as np
from llm_helpers import AWKWARD, shingles, words

from vigilog.llm import words as w


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = [(t or "").encode() for _, t in AWKWARD]
    seen: dict[int, str] = {}
    for first, hashes, bounds in w.word_runs(texts):
        for i in range(len(bounds) - 1):
            own = words(texts[first + i].decode())
            assert len(own) == bounds[i + 1] - bounds[i]
            for word, h in zip(own, hashes[bounds[i] : bounds[i + 1]].tolist(), strict=True):
                assert seen.setdefault(h, word) == word


def test_a_text_longer_than_a_stretch(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(3000)) + b" " + b"x" * 5000 + b" end"
    whole = w.hashed_words(np.frombuffer(text, np.uint8))[0]
    monkeypatch.setattr(w, "STRETCH", 1 << 10)
    runs = list(w.word_runs([b"a", text, None, b"b c"]))
    assert np.array_equal(next(h for first, h, _ in runs if first == 1), whole)
    assert sum(len(b) - 1 for _, _, b in runs) == 4


def test_shingle_sets():
    for (_, text), found in zip(AWKWARD, w.shingle_sets([(t or "").encode() for _, t in AWKWARD], 5), strict=True):
        assert len(found) == len(shingles(text))

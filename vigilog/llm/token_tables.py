"""Tokens of words seen before, so that a tokenizer runs once per distinct word of a task and not once per word."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Sequence

import numpy as np

MOST_WORDS = 400_000


class TokenTable(dict[str, int]):
    """Rows of token ids by word. Beyond ``most`` words it starts anew, which bounds its memory and changes no result."""

    def __init__(self, encode: Callable[[list[str]], Iterable[Sequence[int]]], most: int = MOST_WORDS):
        super().__init__()
        self.encode, self.most = encode, most
        self._start()

    def _start(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids, self.ends = array("i"), array("q", [0])

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and how many each word has. New words are encoded together."""
        if len(self) > self.most:
            self._start()
        rows = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.new:
            for ids in self.encode(self.new):
                self.ids.extend(ids)
                self.ends.append(len(self.ids))
            self.new = []
        ends, ids = np.array(self.ends, dtype=np.int64), np.array(self.ids, dtype=np.int32)
        return spans(ids, ends[rows], ends[rows + 1] - ends[rows])


def spans(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans ``values[start:start + size]`` one after the other, and their sizes."""
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return values[places], sizes


class HashedTable:
    """Token ids by the 64-bit hash of a word: sorted arrays instead of words, so a task can remember millions of them."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[Sequence[int]]], most: int = 2_000_000):
        self.encode, self.most = encode, most
        self._start()

    def _start(self) -> None:
        self.keys, self.rows = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.ids, self.ends = array("H"), array("I", [0])

    def tokens(self, hashes: np.ndarray, word: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of hashed words one after the other, and how many each has; ``word(i)`` gives the word of hash ``i``."""
        if len(self.keys) > self.most:
            self._start()
        keys, firsts, back = np.unique(hashes, return_index=True, return_inverse=True)
        places = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), bool)
        if len(self.keys):
            there = self.keys[np.minimum(places, len(self.keys) - 1)] == keys
        rows = np.empty(len(keys), np.int32)
        rows[there] = self.rows[places[there]]
        new = np.flatnonzero(~there)
        rows[new] = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(new))
        for ids in self.encode([word(i) for i in firsts[new].tolist()]):
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
        self.keys = np.insert(self.keys, places[new], keys[new])
        self.rows = np.insert(self.rows, places[new], rows[new])
        ends = np.array(self.ends, dtype=np.int64)
        own = rows[back]
        return spans(np.array(self.ids, dtype=np.uint16), ends[own], ends[own + 1] - ends[own])

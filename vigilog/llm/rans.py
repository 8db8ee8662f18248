"""Static range asymmetric numeral system over token ids, with many interleaved lanes.

A block is coded by itself: symbol ``i`` belongs to lane ``i % LANES``, each lane has a 64-bit state, and the lanes of one
step are coded as one array operation. The decoder needs the frequency table, the final states and the 32-bit words.
"""

from __future__ import annotations

import numpy as np

LANES = 1024
SHIFT = 20
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SHIFT = np.uint64(SHIFT)
_MASK = np.uint64((1 << SHIFT) - 1)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2**SHIFT``, at least 1 for each of the positive counts (at most ``2**SHIFT`` of them)."""
    total, room = 1 << SHIFT, (1 << SHIFT) - len(counts)
    shares = counts * (room / counts.sum())
    out = 1 + np.floor(shares).astype(np.int64)
    rest = total - int(out.sum())
    out[np.argsort(-(shares - np.floor(shares)), kind="stable")[:rest]] += 1
    return out


class Table:
    """The frequency table shared by the blocks of a file; symbols are ascending."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols, self.frequencies = symbols.astype(np.int64), frequencies.astype(np.uint64)
        ends = np.cumsum(self.frequencies)
        self.starts = ends - self.frequencies
        self.place = np.zeros(int(symbols.max(initial=0)) + 1, dtype=np.int64)
        self.place[self.symbols] = np.arange(len(symbols))
        self.of_slot = np.repeat(np.arange(len(symbols)), self.frequencies.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final states and words of a block."""
        places = self.place[ids]
        state, words = np.full(LANES, LOW, dtype=np.uint64), []
        for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
            own = places[at : at + LANES]
            f, x = self.frequencies[own], state[: len(own)]
            full = (x >> np.uint64(63 - SHIFT)) >= f
            words.append(x[full].astype(np.uint32))  # the low half
            x = np.where(full, x >> _WORD, x)
            high, low = np.divmod(x, f)
            state[: len(own)] = (high << _SHIFT) + low + self.starts[own]
        return state, np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)

    def decode(self, n: int, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The ids of a block of ``n``."""
        state, ids, at = state.copy(), np.empty(n, dtype=np.int64), 0
        words = words.astype(np.uint64)
        for first in range(0, n, LANES):
            x = state[: n - first]
            slot = x & _MASK
            place = self.of_slot[slot.astype(np.int64)]
            ids[first : first + LANES] = self.symbols[place]
            x = self.frequencies[place] * (x >> _SHIFT) + slot - self.starts[place]
            empty = np.flatnonzero(x < LOW)
            x[empty] = (x[empty] << _WORD) | words[at : at + len(empty)]
            at += len(empty)
            state[: n - first] = x
        return ids

"""Hashes of the maximal runs of bytes outside a set of separators, for whole texts inside Arrow batches.

A-Z count as a-z. The hash is that of ``words``: polynomial over the bytes, so prefix sums give all runs of a
stretch at once; two runs share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

from vigilog.llm.words import STRETCH, _BYTE, _DOWN, _UP, _BASE, _groups, _powers, mixed


def separators(spans: Iterable[tuple[int, int]]) -> np.ndarray:
    """A table of bytes, true within the spans (first and last byte)."""
    table = np.zeros(256, dtype=bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


def hashed_runs(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every run in a stretch of bytes."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    up, down = (_UP, _DOWN) if n <= STRETCH else (_powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n))
    padded = np.ones(n + 2, dtype=bool)
    padded[1:-1] = breaks[data]
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts, ends


def _stretches(data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A text in stretches that end at a separator, with their places; a run longer than a stretch stays whole."""
    at = 0
    while at < len(data):
        end = min(at + STRETCH, len(data))
        while end < len(data):
            gaps = np.flatnonzero(breaks[data[max(at, end - STRETCH) : end]])
            if len(gaps):
                end = max(at, end - STRETCH) + int(gaps[-1]) + 1
                break
            end = min(end + STRETCH, len(data))
        yield at, data[at:end]
        at = end


def text_runs(texts: Sequence[bytes | None], breaks: np.ndarray) -> Iterator[tuple]:
    """Groups of texts as (first text, bytes, hashes, starts, ends, bounds of the texts in the runs); a long text is a group.

    Between two texts of a group stands a line feed, which must be a separator. A null text counts as empty.
    """
    for at, end in _groups(texts):
        data = np.frombuffer(b"\n".join(x or b"" for x in texts[at:end]), dtype=np.uint8)
        if end - at == 1 and len(data) > STRETCH:
            parts = [(place, *hashed_runs(part, breaks)) for place, part in _stretches(data, breaks)]
            hashes = np.concatenate([p[1] for p in parts])
            starts, ends = (np.concatenate([p[0] + p[i] for p in parts]) for i in (2, 3))
            yield at, data, hashes, starts, ends, np.array([0, len(hashes)])
        else:
            hashes, starts, ends = hashed_runs(data, breaks)
            yield at, data, hashes, starts, ends, np.searchsorted(starts, np.cumsum([0] + [len(x or b"") + 1 for x in texts[at:end]]))

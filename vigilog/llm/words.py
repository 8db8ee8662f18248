"""Word and shingle hashes of whole texts, computed on byte arrays inside Arrow batches.

A word is a run of bytes other than tab, line feed, vertical tab, form feed, carriage return and space; A-Z count as
a-z. A word's hash is a polynomial over random 64-bit values of its bytes, so that a prefix sum over a stretch of text
gives the hashes of all its words at once. Two words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

STRETCH = 1 << 20  # bytes hashed at once
SPACES = b" \t\n\x0b\x0c\r"

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EXACT = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(_random.integers(1, 2**62)) * 4 + 1
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK[48:58] = _MARK[39] = False  # digits and the apostrophe
_MARK &= ~_LETTER
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_GRAM = np.uint64(int(_random.integers(1, 2**62)) * 4 + 1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, np.uint64(base), dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP = _powers(_BASE, STRETCH + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), STRETCH + 1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hashed_words(data: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word in a stretch of bytes.

    With ``exact``, A-Z differ from a-z, and a word is also cut where an ASCII mark (no apostrophe) follows an ASCII letter.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    up, down = (_UP, _DOWN) if n <= STRETCH else (_powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n))
    padded = np.ones(n + 2, dtype=bool)
    padded[1:-1] = _SPACE[data]
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    if exact:
        cuts = np.flatnonzero(_MARK[data[1:]] & _LETTER[data[:-1]]) + 1
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_EXACT if exact else _BYTE)[data] * up[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts, ends


def _cuts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in stretches that end at white space; a word longer than a stretch stays whole."""
    at = 0
    while at < len(data):
        end = min(at + STRETCH, len(data))
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[max(at, end - STRETCH) : end]])
            if len(gaps):
                end = max(at, end - STRETCH) + int(gaps[-1]) + 1
                break
            end = min(end + STRETCH, len(data))
        yield data[at:end]
        at = end


def _groups(texts: Sequence[bytes | None]) -> Iterator[tuple[int, int]]:
    """Spans of texts that make a stretch together; a longer text by itself."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (size := size + len(texts[end] or b"") + 1) <= STRETCH:
            end += 1
        end = max(end, at + 1)
        yield at, end
        at = end


def word_stretches(texts: Sequence[bytes | None], exact: bool = False) -> Iterator[tuple]:
    """Stretches as (number of the first text, bytes, word hashes, starts, ends, bounds of the texts in the words).

    A text longer than a stretch comes as several, each with that text alone.
    """
    for at, end in _groups(texts):
        run = [x or b"" for x in texts[at:end]]
        if len(run) == 1 and len(run[0]) > STRETCH:
            for data in _cuts(np.frombuffer(run[0], dtype=np.uint8)):
                found = hashed_words(data, exact)
                yield at, data, *found, np.array([0, len(found[0])])
        else:
            data = np.frombuffer(b"\n".join(run), dtype=np.uint8)
            hashes, starts, ends = hashed_words(data, exact)
            yield at, data, hashes, starts, ends, np.searchsorted(starts, np.cumsum([0] + [len(x) + 1 for x in run]))


def word_runs(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as (number of the first text, word hashes, bounds); a long text is one run.

    The words of text ``first + i`` of a run are ``hashes[bounds[i]:bounds[i + 1]]``. A null text counts as empty.
    """
    for first, parts in groupby(word_stretches(texts), key=itemgetter(0)):
        runs = [(hashes, bounds) for _, _, hashes, _, _, bounds in parts]
        if len(runs) == 1:
            yield first, *runs[0]
        else:
            words = np.concatenate([hashes for hashes, _ in runs])
            yield first, words, np.array([0, len(words)])


def shingle_run(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of a run and their bounds; a text with fewer words has one, of them all."""
    counts = np.diff(bounds)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    if not out_bounds[-1]:
        return np.empty(0, np.uint64), out_bounds
    if len(hashes) >= width:
        grams = hashes[: len(hashes) - width + 1].copy()
        for i in range(1, width):
            grams *= _GRAM
            grams += hashes[i : len(hashes) - width + 1 + i]
    else:
        grams = np.empty(0, np.uint64)
    places = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], sizes)
    few = np.flatnonzero((counts > 0) & (counts < width))
    out = grams[np.minimum(places, max(len(grams) - 1, 0))] if len(grams) else np.zeros(out_bounds[-1], np.uint64)
    for i in few:
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for x in hashes[bounds[i] : bounds[i + 1]]:
                value = value * _GRAM + x
            out[out_bounds[i]] = value + np.uint64(counts[i]) * _BYTE[0]
    return mixed(out), out_bounds


def shingle_sets(texts: Sequence[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; empty for a text without words."""
    for _, hashes, bounds in word_runs(texts):
        grams, places = shingle_run(hashes, bounds, width)
        for i in range(len(places) - 1):
            yield np.unique(grams[places[i] : places[i + 1]])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8."""
    return column.cast(pa.large_binary()).to_pylist()


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, one row at least, to bound what a task holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        lengths = np.array([x or 0 for x in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)
        groups = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)

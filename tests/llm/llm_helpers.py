"""Texts and plain-Python definitions that the tests hold the operators against."""

from __future__ import annotations

import re

LLM_SMALL = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "One"),
    (6, "a b c d e f g h i j k l"),
    (6, "a b c d e f g h i j k l"),
    (7, "a b c d e f g h i j k l"),
    (8, "word " * 30_000),
    (9, "".join(chr(0x4E00 + i % 500) for i in range(3000)) + " ünï 🎉"),
    (None, "no id at all here but words enough to be a text"),
    (None, None),
]


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return _WORD.findall(text.translate(_LOWER) if lower else text)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

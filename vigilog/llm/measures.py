"""Measures of a whole text as column expressions: one pass, no Python. A null text counts as empty."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GAPS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words in order: runs of characters other than the six ASCII white-space characters."""
    return F.array_remove(F.split(F.translate(text, GAPS[:-1], " " * 5), " "), "")


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, GAPS, "") != "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words that the text has twice or more, the first run included.

    Runs are compared by 64-bit hashes. Only a text with a repeated run pays for sorting them.
    """

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            return F.array_sort(F.array_compact(F.transform(s, lambda x, j: F.when(same(x, j), x["i"]))))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        step = lambda done, p: F.struct(
            (done["n"] + F.least(F.lit(window), p + window - done["end"])).alias("n"), (p + window).alias("end")
        )
        return F.aggregate(bound(pairs, places), start, step, lambda done: done["n"])

    def grams(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(window)]))

    def count(runs: Column) -> Column:
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(covered(runs))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(bound(bound(hashes, grams), count))

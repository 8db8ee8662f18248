"""Quality rules as a short-circuit cascade of native column expressions.

Every rule is a condition on the text that a rejected document meets. On a bounded sample the cascade measures what a
rule costs and how often it rejects, and puts the rule with the most rejections per second first. A document leaves at
its first rule, so the costly rules run for what the cheap ones let through. The verdict is the same in any order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vigilog.llm import measures as m

SAMPLE_ROWS = 2000
FEWEST_WORDS = 10
REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Facts:
    """A text (not null) and its counts, each an expression of the text or a column that has it already."""

    text: Column
    n_words: Column
    n_chars: Column
    n_symbols: Column

    @staticmethod
    def of(text: Column, n_words: Column | None = None) -> Facts:
        return Facts(text, F.size(m.words_of(text)) if n_words is None else n_words, _chars(text), m.count_of(text, m.SYMBOLS))


@dataclass(frozen=True)
class Rule:
    """``fails(facts)`` is true for a text that the rule rejects."""

    name: str
    fails: Callable[[Facts], Column]


def _chars(text: Column) -> Column:
    return F.length(F.translate(text, m.GAPS, ""))


def _repeated(x: Facts) -> Column:
    return m.bound(m.words_of(x.text), lambda w: 100 * m.repeated_words(w) > REPEATED_PERCENT * F.size(w))


def _dup_lines(x: Facts) -> Column:
    return m.bound(m.lines_of(x.text), lambda y: 2 * (F.size(y) - F.size(F.array_distinct(y))) > F.size(y))


def _capitals(x: Facts) -> Column:
    upper = m.count_of(x.text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return upper > m.count_of(x.text, "abcdefghijklmnopqrstuvwxyz")


RULES = (
    Rule("few_words", lambda x: x.n_words < FEWEST_WORDS),
    Rule("repeated_words", _repeated),
    Rule("symbols", lambda x: x.n_symbols > 0.25 * x.n_words),
    Rule("exclamations", lambda x: m.count_of(x.text, "!") > 0.25 * x.n_words),
    Rule("capitals", _capitals),
    Rule("word_length", lambda x: (x.n_chars > 25 * x.n_words) | (x.n_chars < 2 * x.n_words)),
    Rule("dup_lines", _dup_lines),
)


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """About ``rows`` texts (at most, twice that) spread over the whole table."""
    total = docs.count()
    return docs.select(m.text_of(F.col("text")).alias("text")).sample(min(1.0, rows / max(total, 1)), seed).limit(2 * rows)


def ordered(rules: Sequence[Rule], docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules by rejection per cost, with what the sample showed: ``rule``, ``seconds``, ``rejected`` (share).

    The sample is bounded and cached for the timing. On an empty table the given order stays.
    """
    sample = sample_of(docs, rows).cache()
    try:
        n = sample.count()
        if not n:
            return [{"rule": r, "seconds": 0.0, "rejected": 0.0} for r in rules]
        idle = _seconds(sample, F.length("text") > 0)[0]
        found = []
        for r in rules:
            seconds, rejected = _seconds(sample, r.fails(Facts.of(F.col("text"))))
            found.append({"rule": r, "seconds": max(seconds - idle, 1e-4), "rejected": rejected / n})
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: -x["rejected"] / x["seconds"])


def _seconds(sample: DataFrame, fails: Column) -> tuple[float, int]:
    best = None
    for _ in range(2):  # the first run compiles
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(fails)).first()[0]
        seconds = time.perf_counter() - began
        best = seconds if best is None else min(best, seconds)
    return best, rejected


def first_failure(facts: Facts, rules: Sequence[Rule]) -> Column:
    """The name of the first rule in order that rejects the text, else null; later rules are not evaluated."""
    branch = F.lit(None).cast("string")
    for r in reversed(rules):
        branch = F.when(r.fails(facts), F.lit(r.name)).otherwise(branch)
    return branch


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``rejected_by``: the name of the first rule in the cascade that rejects the text, null if none does.

    A null or empty text has no words and fails the rule on few words. Other columns pass through unread; one named
    ``rejected_by`` is replaced. An empty table stays empty. Repeated rows are judged each for itself.
    """
    order = [x["rule"] for x in ordered(rules, docs, rows)]
    text = F.col("text")
    own = docs.select(F.struct(*[c for c in docs.columns if c != "rejected_by"]).alias("row"), m.text_of(text).alias("text"))
    own = own.select("row", "text", F.size(m.words_of(text)).alias("n_words"))
    return own.select("row.*", first_failure(Facts.of(text, F.col("n_words")), order).alias("rejected_by"))


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the base counts of each whole text."""
    text = F.col("text")
    base = docs.select("doc_id", m.text_of(text).alias("text"))
    base = base.select("doc_id", "text", m.words_of(text).alias("words"), m.lines_of(text).alias("lines"))
    return base.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        _chars(text).cast("long").alias("word_chars"),
        m.count_of(text, m.SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        m.repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """The base counts of every document, ``base_failed``, ``kept`` and ``rejected_by``.

    The two base rules are decided from the counts; the cascade of the others runs for what passes them.
    """
    rest = [x["rule"] for x in ordered(RULES[2:], docs)]
    failed = F.expr(f"n_words < {FEWEST_WORDS} or 100 * n_repeat_words > {REPEATED_PERCENT} * n_words")
    counted = text_counts(docs).withColumn("base_failed", failed)
    known = Facts(F.col("text"), F.col("n_words"), F.col("word_chars"), F.col("n_symbols"))
    judged = counted.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(first_failure(known, rest)))
    return judged.select(
        *("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()),
        F.col("rejected_by").isNull().alias("kept"),
        "rejected_by",
    )

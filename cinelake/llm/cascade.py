"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a boolean column over a few measures. A bounded sample gives each rule's running
time and the share it rejects; the cascade asks the rule with the most rejections per second first,
and a later rule is evaluated only for rows that passed the earlier ones. The order changes the
cost alone: a row is kept if it passes all rules.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.text import BLANK_CHARACTERS, word_array

#: Rows the order of the rules is estimated on. They never decide what is kept.
SAMPLE_ROWS = 1000
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANK_CHARACTERS, ""))


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def capitals(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANK_CHARACTERS, "")) > 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(text: Column) -> Column:
    """Words covered by a five-word window that stands in the text twice or more.

    Windows, as hashes, are sorted with their places only where some hash repeats; equal neighbours
    are repeats. Their places in order then cover up to five words each.
    """
    def windows(h):
        return F.when(F.size(h) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))),
        ).otherwise(F.array().cast("array<bigint>"))

    def places(s):
        same = lambda j, e: F.coalesce(F.get(s, j).x == e.x, F.lit(False))
        marked = F.transform(s, lambda e, j: F.struct(e.i.alias("i"), (same(j - 1, e) | same(j + 1, e)).alias("twice")))
        return F.sort_array(F.transform(F.filter(marked, lambda e: e.twice), lambda e: e.i))

    def covered(p):
        return F.aggregate(
            p, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct((a.n + F.least(F.lit(WINDOW), i - a.last)).alias("n"), i.alias("last")),
            lambda a: a.n)

    def of_windows(g):
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), let(ordered, lambda s: covered(places(s)))).otherwise(F.lit(0))

    hashed = F.transform(word_array(text), lambda x: F.xxhash64(x))
    return let(hashed, lambda h: let(windows(h), of_windows))


def dup_lines(text: Column) -> Column:
    return let(filled_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


#: Every measure of a text that is not null, by name.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: F.size(word_array(text)),
    "word_chars": word_chars,
    "n_symbols": symbols,
    "n_dup_lines": dup_lines,
    "n_repeat_words": repeat_words,
    "n_capitals": capitals,
    "n_lines": lambda text: F.size(filled_lines(text)),
}


def measures(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures of every row, as longs; a null text has none of anything."""
    body = F.coalesce(docs[text], F.lit(""))
    return docs.select(docs[id].alias("doc_id"), *(f(body).cast("long").alias(n) for n, f in MEASURES.items()))


@dataclass(frozen=True)
class Rule:
    """``fails`` gets a function from a measure's name to its column."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: Limits lie far from ordinary prose, so that a clean text passes.
RULES: tuple[Rule, ...] = (
    Rule("too few words", lambda m: m("n_words") < 10),
    Rule("too much repetition", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("too many symbols", lambda m: 100 * m("n_symbols") > 25 * m("n_words")),
    Rule("too many repeated lines", lambda m: (m("n_lines") >= 4) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
    Rule("shouting", lambda m: 100 * m("n_capitals") > 50 * m("word_chars")),
    Rule("words too long or short", lambda m: (m("word_chars") > 20 * m("n_words")) | (m("word_chars") < 2 * m("n_words"))),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS,
             ) -> list[Estimate]:
    """Cost and rejected share of each rule on at most ``sample_rows`` rows, best order first."""
    sample = docs.select(F.coalesce(docs[text], F.lit("")).alias("text")).limit(sample_rows).persist()
    try:
        rows = max(sample.count(), 1)
        out = []
        for rule in rules:
            counted = sample.agg(F.count_if(rule.fails(lambda name: MEASURES[name](F.col("text")).cast("long"))).alias("n"))
            counted.first()  # compiles the expression
            start = time.perf_counter()
            rejected = counted.first().n
            out.append(Estimate(rule, time.perf_counter() - start, rejected / rows))
    finally:
        sample.unpersist()
    return sorted(out, key=lambda e: -e.worth)


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS,
            ) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their columns as they are.

    The rules are branches of one condition in the estimated order, so a measure is worked out only
    for rows that all earlier rules kept. A null text has no words and fails the rule on words.
    Repeated rows are judged alike; an empty table stays empty.
    """
    body = F.coalesce(docs[text], F.lit(""))
    return docs.where(passes(estimate(docs, rules, text, sample_rows), lambda name: MEASURES[name](body).cast("long")))


def passes(order: Sequence[Estimate], measure: Callable[[str], Column]) -> Column:
    kept = F.lit(True)
    for e in reversed(order):
        kept = F.when(e.rule.fails(measure), F.lit(False)).otherwise(kept)
    return kept


def verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES, id: str = "doc_id", text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``, the rules asked in the estimated order."""
    order = estimate(docs, rules, text, sample_rows)
    return measures(docs, id, text).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & passes(order, F.col))

"""Quality rules as a short-circuit cascade, with DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.llm.common import cut, text_of

# What separates words, and what counts as a symbol.
SPACE = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails`` holds; null counts as passing."""
    name: str
    fails: Column


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures of each whole text: n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, and the words themselves as ``_words``.

    Every step is a column of its own, so no array is built twice. Repeated windows are found by
    sorting one row's window hashes, n log n in its words; a text without any costs one pass.
    """
    keep = [c for c in docs.columns if c not in MEASURES]
    t = text_of(text)
    d = docs.select(*keep, F.translate(t, SPACE, " " * len(SPACE)).alias("_flat"))
    d = d.select(*keep, F.array_remove(F.split("_flat", " ", -1), "").alias("_words"))
    d = d.select(*keep, "_words", F.transform("_words", lambda x: F.xxhash64(x)).alias("_hash"))
    n = F.size("_words")
    d = d.select(*keep, "_words", F.slice(F.transform(
        "_hash", lambda x, i: F.xxhash64(x, F.get("_hash", i + 1), F.get("_hash", i + 2))),
        F.lit(1), F.greatest(n - 2, F.lit(0))).alias("_win"))
    some = F.size(F.array_distinct("_win")) < F.size("_win")
    d = d.select(*keep, "_words", F.when(some, F.array_sort(F.transform(
        "_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_sorted"))
    again = F.filter("_sorted", lambda x, i: (
        (F.get("_sorted", i + 1)["h"] == x["h"]) |
        ((i > 0) & F.coalesce(F.get("_sorted", i - 1)["h"] == x["h"], F.lit(False)))))
    d = d.select(*keep, "_words", F.array_sort(F.transform(again, lambda x: x["i"])).alias("_at"))
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get("_at", i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.select(*keep, "_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                 lines.alias("_lines"))
    return d.select(
        *keep, "_words", n.cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"),
                    lambda a, x: a + F.char_length(x)).alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words")


MEASURES = ("_words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "_flat", "_hash", "_win", "_sorted", "_at", "_lines", "base_failed",
            "kept")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules for running prose; all thresholds are shares of the document's own size."""
    t, n = text_of(text), F.col("n_words")
    chars = F.greatest(F.char_length(t), F.lit(1))
    return [
        Rule("symbols", F.col("n_symbols") > 0.1 * n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("duplicate_lines", F.col("n_dup_lines") > 0.5 * F.col("n_lines")),
        Rule("digits", F.char_length(F.regexp_replace(t, "[^0-9]+", "")) > 0.3 * chars),
        Rule("shouting", F.size(F.filter("_words", lambda w: (w == F.upper(w)) & (w != F.lower(w))))
             > 0.5 * n),
        Rule("word_variety", F.size(F.array_distinct("_words")) < 0.05 * n),
        Rule("ellipses", F.regexp_count(t, F.lit("\\.\\.\\.|…")) > 0.3 * F.col("n_lines") + 10),
    ]


def order_rules(sample: DataFrame, rules: list[Rule], repeats: int = 3) -> list[tuple[Rule, float, float]]:
    """Rules with their rejection share and seconds on ``sample``, most rejections per second
    first. Seconds are the least of some runs over the sample, less a run without any rule."""
    def seconds(c: Column) -> float:
        best = float("inf")
        for _ in range(repeats):
            began = time.perf_counter()
            sample.select(F.count_if(F.coalesce(c, F.lit(False)))).first()
            best = min(best, time.perf_counter() - began)
        return best

    shares = sample.select(*[F.avg(F.coalesce(r.fails, F.lit(False)).cast("int")).alias(f"r{i}")
                             for i, r in enumerate(rules)]).first()
    idle = seconds(F.col("n_words") < -1)
    found = [(r, shares[i] or 0.0, max(seconds(r.fails) - idle, 1e-4)) for i, r in enumerate(rules)]
    return sorted(found, key=lambda x: -x[1] / x[2])


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does. CASE stops at that rule, so
    the ones after it are not evaluated for the row."""
    out = F.when(F.coalesce(rules[0].fails, F.lit(False)), rules[0].name)
    for r in rules[1:]:
        out = out.when(F.coalesce(r.fails, F.lit(False)), r.name)
    return out


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, *, text: str = "text",
                sample_rows: int = 2000) -> DataFrame:
    """``docs`` with base measures, ``base_failed`` and ``kept``.

    A document is kept when it passes the base conditions and every rule. The order of the rules
    comes from a random sample of about ``sample_rows`` rows (a bound that does not grow with the
    corpus); it decides how much is computed, never the verdict. Rows that fail the base
    conditions skip all rules. Nothing is shuffled and no row depends on another.

    Null and empty texts have no words: all counts are 0, base_failed is true. Columns named like
    a measure are replaced; all others stay. An empty table gives an empty result.
    """
    rules = standard_rules(text) if rules is None else rules
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    measured = with_measures(docs, text).withColumn("base_failed", base_failed())
    if rules and total:
        sample = cut(with_measures(docs.select(text).sample(share, seed=7), text), "rule-sample")
        rules = [r for r, _, _ in order_rules(sample, rules)]
    verdict = cascade(rules).isNull() if rules else F.lit(True)
    return measured.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict))

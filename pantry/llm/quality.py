"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are estimated on a bounded sample; rules are
then ordered by rejections per cost, and a document stops at the first rule that
rejects it.  The order decides only how much is computed, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import placed, written

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WORDS, LINES, TEXT = "__llm_words", "__llm_lines", "__llm_text"


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a boolean column from the prepared columns."""

    name: str
    rejects: Callable[[], Column]


def _n() -> Column:
    return F.size(WORDS)


#: Word counts here are never 0: the base rules come first.
RULES = (
    Rule("symbols", lambda: F.regexp_count(TEXT, F.lit(SYMBOLS)) * 10 > _n()),
    Rule("exclamations", lambda: F.regexp_count(TEXT, F.lit("!")) * 2 > _n()),
    Rule("duplicate_lines", lambda: F.col("n_dup_lines") * 2 > F.size(LINES)),
    Rule("capitals", lambda: F.regexp_count(TEXT, F.lit("[A-Z]")) * 5 > F.length(TEXT) * 2),
    Rule("digits", lambda: F.regexp_count(TEXT, F.lit("[0-9]")) * 2 > F.length(TEXT)),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * _n()) | (F.col("word_chars") > 20 * _n())),
    Rule("vocabulary", lambda: F.size(F.array_distinct(WORDS)) * 5 < _n()),
)


def prepared(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {TEXT: text, WORDS: F.filter(F.split(text, SPACE + "+"), lambda w: w != ""),
            LINES: F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))}


def repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are compared by 64-bit hashes.  Only texts with an equal pair sort
    them; the covered words are then the union of the stretches [p, p + 3).
    """
    hashes, grams, found = "__llm_hashes", "__llm_grams", "__llm_found"
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(grams, F.when(F.size(hashes) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(found, F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(F.transform(
        grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get(found, j)["h"] == x["h"], F.lit(False))
    df = df.withColumn(found, F.sort_array(F.transform(
        F.filter(found, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(found, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda acc, p: F.struct(
        (p + 3).alias("end"), (acc["n"] + 3 - F.greatest(F.lit(0), acc["end"] - p)).alias("n")), lambda acc: acc["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop(hashes, grams, found)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as ``row`` (a struct) with the base measures of each text."""
    d = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in prepared(F.col(text)).items() if k == TEXT])
    d = d.withColumns({k: c for k, c in prepared(F.col(TEXT)).items() if k != TEXT})
    d = repeat_words(d, WORDS, "n_repeat_words")
    n = F.size(WORDS).cast("long")
    return d.withColumns({
        "n_words": n, "word_chars": F.length(F.array_join(WORDS, "")).cast("long"),
        "n_symbols": F.regexp_count(TEXT, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(LINES) - F.size(F.array_distinct(LINES))).cast("long"),
        "base_failed": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)})


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000, text: str = "text") -> list[Rule]:
    """``rules`` by rejections per cost on ``sample_rows`` rows at most.

    The sample bounds what is timed; which rows it holds changes the order alone.
    """
    d = placed(docs.select(F.col(text).alias("text")), "text")
    n = d.count()
    if not n:
        return list(rules)
    cut = min(1.0, 1.5 * sample_rows / n)
    draw = F.pmod(F.xxhash64(*d.columns[1:]), F.lit(1_000_000)) < int(cut * 1_000_000)
    sample = written(measured(d.where(draw).select("text").limit(sample_rows)).drop("row"), "rule-sample")
    base = ~F.col("base_failed")
    worth = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sample.where(base & rule.rejects()).count()
        worth.append((-(rejected + 0.5) / (time.perf_counter() - began), rule.name, rule))
    return [w[2] for w in sorted(worth, key=lambda w: w[:2])]


def cascade(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """``row`` (the input row), the base measures, base_failed, kept and
    rejected_by (the first rule in cascade order that rejects; base rules: base).

    A null text is empty, and an empty text has no words, so the base rejects it.
    Ids, repeated rows and further columns play no part; an empty table gives none.
    """
    rules = rule_order(docs, text=text) if rules is None else rules
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        first = first.when(rule.rejects(), F.lit(rule.name))
    d = measured(docs, text).withColumn("rejected_by", first)
    return d.withColumn("kept", F.col("rejected_by").isNull()).drop(WORDS, LINES, TEXT)

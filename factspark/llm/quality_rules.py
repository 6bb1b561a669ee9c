"""Quality rules as a cascade that stops at the first rule that rejects.

All of it is column expressions. Each rule is timed on a sample and its rejections are
counted there; rules then stand in the order of rejections per second, in one CASE whose
later branches are not evaluated once one holds.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.functions.strings import let
from factspark.llm.components import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

Statistics = dict[str, Column]


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def word_chars(found: Column) -> Column:
    return F.char_length(F.array_join(found, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def lines_with_words(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def repeated_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_hashes(found: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    hashes = F.transform(found, lambda w, i: F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2)))
    return F.slice(hashes, 1, F.greatest(F.size(found) - 2, F.lit(0)))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in windows whose hash occurs twice or more, the first included.

    Windows are sorted by hash and compared with their neighbours, so that the work
    grows with n log n; a text without a repeated window is done before that.
    """

    def positions(s: Column) -> Column:
        alike = F.transform(
            s,
            lambda x, k: F.when(
                (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]
            ),
        )
        return F.sort_array(F.filter(alike, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = let(let(order, positions), covered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(counted)


def capitals(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[A-ZÀ-ÖØ-Þ]")), F.lit(0)).cast("long")


def text_statistics(text: Column) -> Statistics:
    """The statistics as expressions of the text itself, so that a cascade can leave them out."""
    found = words(text)
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": word_chars(found),
        "n_symbols": symbols(text),
        "n_lines": F.size(lines_with_words(text)).cast("long"),
        "n_dup_lines": let(lines_with_words(text), repeated_lines),
        "n_repeat_words": let(let(found, window_hashes), repeated_words),
        "n_capitals": capitals(text),
    }


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Statistics], Column]


BASE_RULES = (
    Rule("few_words", lambda s: s["n_words"] < 50),
    Rule("mostly_repeated", lambda s: 100 * s["n_repeat_words"] > 50 * s["n_words"]),
)
MORE_RULES = (
    Rule("symbols", lambda s: 10 * s["n_symbols"] > s["n_words"]),
    Rule("repeated_lines", lambda s: 100 * s["n_dup_lines"] > 40 * s["n_lines"]),
    Rule("long_words", lambda s: s["word_chars"] > 12 * s["n_words"]),
    Rule("short_words", lambda s: 2 * s["word_chars"] < 5 * s["n_words"]),
    Rule("capitals", lambda s: 100 * s["n_capitals"] > 40 * s["word_chars"]),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float


def measure(sample: DataFrame, statistics: Statistics, rules: tuple[Rule, ...]) -> list[Measured]:
    """Seconds and share of rejections of each rule on its own over ``sample``."""

    def timed(condition: Column) -> tuple[float, float]:
        start = time.perf_counter()
        row = sample.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("int")).alias("share")).first()
        return time.perf_counter() - start, row["share"] or 0.0

    empty = timed(F.lit(False))[0]
    out = []
    for rule in rules:
        seconds, share = timed(rule.rejects(statistics))
        out.append(Measured(rule, max(seconds - empty, 1e-3), share))
    return out


def ordered(measured: list[Measured]) -> list[Rule]:
    """Rules by rejections per second, the most first."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.rejected / m.seconds)]


def cascade(rules: list[Rule], statistics: Statistics) -> Column:
    """True unless a rule rejects; a rule is evaluated only if none before it rejects."""
    verdict = None
    for rule in rules:
        condition = rule.rejects(statistics)
        verdict = F.when(condition, False) if verdict is None else verdict.when(condition, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


#: So that a rerun takes the same rows of the same partitions.
SAMPLE_SEED = 1


def sample_of(docs: DataFrame, text_column: str, rows: int) -> DataFrame:
    """About ``rows`` texts, nulls and copies by their share; for estimates only."""
    text = F.col(f"`{text_column}`").cast("string").alias("text")
    share = min(1.0, rows / max(docs.count(), 1))
    # By row, as a hash takes either all copies of a text or none.
    return stored(docs.select(text).sample(share, SAMPLE_SEED), "rule-sample")


def plan_cascade(docs: DataFrame, text_column: str, rules: tuple[Rule, ...], sample_rows: int = 1000) -> list[Rule]:
    """``rules`` in the order that the sample suggests; the verdict is the same in any order."""
    sample = sample_of(docs, text_column, sample_rows)
    return ordered(measure(sample, text_statistics(F.col("text")), rules))


def quality_filter(docs: DataFrame, text_column: str = "text", sample_rows: int = 1000) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    A null or empty text has no words and is rejected. Each row is judged on its own,
    so repeated rows stay or go together.
    """
    rules = plan_cascade(docs, text_column, BASE_RULES + MORE_RULES, sample_rows)
    return docs.filter(cascade(rules, text_statistics(docs[f"`{text_column}`"].cast("string"))))


def quality_verdicts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = 1000
) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed`` and ``kept`` of every document.

    A null text has no words and counts zero everywhere, so that it fails the base
    rules. Rows are independent; other columns are ignored.
    """
    rules = plan_cascade(docs, text_column, MORE_RULES, sample_rows)
    text = F.col("text")
    found = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text")
    ).select("doc_id", "text", words(text).alias("words"))
    hashed = found.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        window_hashes(F.col("words")).alias("hashes"),
        lines_with_words(text).alias("lines"),
    )
    base = hashed.select(
        "doc_id",
        "text",
        "n_words",
        "word_chars",
        symbols(text).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        repeated_lines(F.col("lines")).alias("n_dup_lines"),
        repeated_words(F.col("hashes")).alias("n_repeat_words"),
    )
    known = {c: F.col(c) for c in base.columns if c not in ("doc_id", "text")}
    failed = BASE_RULES[0].rejects(known) | BASE_RULES[1].rejects(known)
    verdict = F.when(F.col("base_failed"), False).otherwise(cascade(rules, known | {"n_capitals": capitals(text)}))
    judged = base.withColumn("base_failed", failed).withColumn("kept", verdict)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

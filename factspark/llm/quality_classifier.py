"""A quality classifier of few rules over text statistics.

Shallow trees are grown on labelled documents; each path from a root becomes a rule, a
conjunction of comparisons. A logistic regression with an l1 penalty weighs the rules and
leaves most out. What remains is one column expression over the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import chunks, flat_bytes, map_blocks, prefix_hashes, span_hashes
from factspark.llm.components import stored
from factspark.llm.langid import is_held_out
from factspark.llm.segments import runs_of, words

#: Labelled rows to learn from, about; they are chosen by a hash of their id.
TRAIN_ROWS = 30_000
TREES = 12
DEPTH = 3
PENALTY = 0.0005

#: Each statistic is a share, a mean or a logarithm, so that it compares across lengths;
#: ``vocabulary`` is log(distinct words) / log(words), which long texts hardly lower.
STATISTICS = (
    "log_words",
    "word_bytes",
    "vocabulary",
    "repeated_next",
    "repeated_windows",
    "distinct_lines",
    "line_words",
    "capitals",
    "digits",
    "symbols",
    "marks",
    "ends",
    "blanks",
)


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_CAPITALS = _flags(bytes(range(0x41, 0x5B)))
_DIGITS = _flags(b"0123456789")
_SYMBOLS = _flags(b"#*$%&|<>")
_MARKS = _flags(b"!?;:()[]{}=+_~^@/\\\"")
_ENDS = _flags(b".!?")
_BLANKS = _flags(b" \t\n\x0b\x0c\r")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _count(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[edges])


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner the number of distinct keys, and of rows whose key occurs again."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[~same[:-1]], minlength=n), np.bincount(o[same[1:] | same[:-1]], minlength=n)


def block_statistics(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """STATISTICS of each text of a block, as rows; all zero for a text without words."""
    n = len(bounds) - 1
    starts, ends = words(flat, bounds)
    sums = prefix_hashes(flat)
    edges = np.searchsorted(starts, bounds)
    n_words = np.diff(edges)
    owner = np.repeat(np.arange(n), n_words)
    keys = span_hashes(sums, starts, ends)
    distinct, _ = _repeats(keys, owner, n)
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    last = np.arange(len(keys)) + 2
    windows = np.flatnonzero(last < edges[1:][owner]) if len(keys) else last
    triple = keys[windows] * np.uint64(3) + keys[windows + 1] * np.uint64(5) + keys[windows + 2] * np.uint64(7)
    _, repeated = _repeats(triple, owner[windows], n)
    line_starts, line_ends = runs_of(flat != 0x0A, bounds)
    line_owner = np.searchsorted(bounds, line_starts, "right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    lines, _ = _repeats(span_hashes(sums, line_starts, line_ends), line_owner, n)
    n_bytes = np.diff(bounds)
    total = _count(~_BLANKS[flat], bounds)
    out = np.stack([
        np.log1p(n_words),
        _share(np.bincount(owner, ends - starts, n), n_words),
        np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)),
        _share(np.bincount(owner[again], minlength=n), n_words),
        _share(repeated, n_words),
        _share(lines, n_lines),
        _share(n_words, n_lines),
        _share(_count(_CAPITALS[flat], bounds), total),
        _share(_count(_DIGITS[flat], bounds), total),
        _share(_count(_SYMBOLS[flat], bounds), n_words),
        _share(_count(_MARKS[flat], bounds), n_words),
        _share(np.bincount(owner[_ENDS[flat[ends - 1]]], minlength=n) if len(ends) else np.zeros(n), n_words),
        _share(_count(_BLANKS[flat], bounds), n_bytes),
    ], axis=1)
    out[n_words == 0] = 0
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and STATISTICS of ``doc_id, text``; a null text counts as empty."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        rows = [
            block_statistics(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)
        ]
        values = np.concatenate(rows)
        return pa.table({"doc_id": table["doc_id"]} | {name: pa.array(values[:, k]) for k, name in enumerate(STATISTICS)})

    schema = ", ".join(["doc_id long", *(f"{name} double" for name in STATISTICS)])
    return map_blocks(docs.select("doc_id", "text"), run, schema)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    value: float

    def column(self) -> Column:
        found = F.col(self.statistic)
        return found > self.value if self.above else found <= self.value


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1 as an expression of the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule) -> Column:
    out = rule[0].column()
    for condition in rule[1:]:
        out = out & condition.column()
    return out


_STEP = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(description: str) -> set[Rule]:
    """Every path from the root of a printed tree, tightened to one bound for each side."""
    found: set[Rule] = set()
    path: list[tuple[int, Condition]] = []
    for line in description.splitlines():
        step = _STEP.match(line)
        if not step:
            continue
        depth = len(step[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, Condition(STATISTICS[int(step[2])], step[3] == ">", float(step[4]))))
        found.add(_tight([c for _, c in path]))
    return found


def _tight(conditions: list[Condition]) -> Rule:
    best: dict[tuple[str, bool], Condition] = {}
    for c in conditions:
        old = best.get((c.statistic, c.above))
        if old is None or (c.value > old.value) == c.above:
            best[(c.statistic, c.above)] = c
    return tuple(sorted(best.values(), key=lambda c: (c.statistic, c.above)))


def learn(train: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 1) -> RuleModel:
    """A model from ``label`` (0.0 or 1.0) and STATISTICS.

    With one label only, or none, the model has no rules and its score is the share of
    label 1 among the rows and one more of each.
    """
    counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = counts.get(1.0, 0), counts.get(0.0, 0)
    prior = float(np.log((good + 1) / (bad + 1)))
    if not good or not bad:
        return RuleModel(prior, ())
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(train).select("label", "features", *STATISTICS)
    forest = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, minInstancesPerNode=5).fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)}, key=str)
    if not rules:
        return RuleModel(prior, ())
    held = vectors.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features"))
    weights = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100).fit(held)
    chosen = tuple((r, float(w)) for r, w in zip(rules, weights.coefficients.toArray(), strict=True) if w != 0)
    return RuleModel(float(weights.intercept), chosen)


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    ``docs`` has ``doc_id, text`` and ``labels`` has ``doc_id, quality``. The model
    learns from labels 0 and 1 of documents whose crc32 of the id is not 1 modulo 3; a
    null id is not held out and never labelled. An empty text has all statistics zero.
    Repeated rows give repeated results; an empty table gives no rows; other columns are
    ignored.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = stored(statistics(named), "statistics")
    held_out = is_held_out(F.col("doc_id"), 3, 1)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    usable = usable.filter("label IN (0.0, 1.0)").filter(~held_out)
    share = min(1.0, train_rows / max(usable.count(), 1))
    usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    train = stored(measured.join(usable, "doc_id"), "labelled-statistics")
    score = learn(train).score()
    scored = measured.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

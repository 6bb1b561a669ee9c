"""Rules, classifier and language models: brute force, hand-made cases and held-out accuracy."""

import itertools
import math
import re
from collections import Counter
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from factspark.llm import langid, quality_classifier, quality_rules
from factspark.llm.blocks import prefix_hashes, span_hashes

SF = "/root/testdata/sf0.01"


def statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n, repeats = len(words), len(covered)
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * repeats > 50 * n
    chars, capitals = sum(map(len, words)), len(re.findall("[A-ZÀ-ÖØ-Þ]", text or ""))
    kept = not (failed or 10 * symbols > n or 100 * dup > 40 * len(lines) or chars > 12 * n
                or 2 * chars < 5 * n or 100 * capitals > 40 * chars)
    return n, chars, symbols, dup, repeats, failed, kept


def test_statistics_equal_brute_force(spark, edge_docs):
    more = [(-1, "a b c " * 30), (-2, "Some line of words.\n" * 20), (-3, "word # and * " * 40), (-4, "YES NO " * 30)]
    more += [(-5, " ".join(f"word{i}" for i in range(80)))]
    docs = edge_docs.select("doc_id", "text", F.lit("x").alias("words"), F.lit(1).alias("n_words"))
    docs = docs.unionByName(spark.createDataFrame([(*r, "x", 1) for r in more], docs.schema))
    expected = Counter((r["doc_id"], *statistics(r["text"])) for r in docs.collect())
    assert Counter(tuple(r) for r in quality_rules.quality_verdicts(docs).collect()) == expected
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(x[0] for x in expected.elements() if x[-1])


def test_rules_stand_in_the_order_of_rejections_per_second():
    rules = [quality_rules.Rule(n, lambda s: F.lit(True)) for n in "abc"]
    measured = [quality_rules.Measured(r, t, x) for r, t, x in zip(rules, (1, 2, 1), (0.1, 0.9, 0.2), strict=True)]
    assert [r.name for r in quality_rules.ordered(measured)] == ["b", "c", "a"]


def test_a_cascade_stops_at_the_first_rejection(spark):
    rules = [quality_rules.Rule("few", lambda s: s["x"] < 5), quality_rules.Rule("error", lambda s: F.raise_error("reached").isNull())]
    df = spark.range(5).select(quality_rules.cascade(rules, {"x": F.col("id")}).alias("kept"))
    assert not any(r["kept"] for r in df.collect())


def test_no_python_in_the_native_operators(spark, no_docs):
    plan = quality_rules.quality_verdicts(no_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_rules_of_a_printed_tree():
    text = """DecisionTreeRegressionModel
  If (feature 0 <= 1.5)
   If (feature 1 <= -2.0E-1)
    Predict: 1.0
   Else (feature 1 > -2.0E-1)
    Predict: 0.0
  Else (feature 0 > 1.5)
   If (feature 0 <= 3.0)
    Predict: 1.0
"""
    names = quality_classifier.STATISTICS
    rules = {tuple((c.statistic, c.above, c.value) for c in r) for r in quality_classifier.tree_rules(text)}
    low, high = (names[0], False, 1.5), (names[0], True, 1.5)
    second = names[1]
    assert rules == {
        (low,), tuple(sorted([low, (second, False, -0.2)])), tuple(sorted([low, (second, True, -0.2)])), (high,),
        ((names[0], False, 3.0), high),
    }


def test_block_statistics_by_hand():
    texts = ["The cat sat.\nThe cat sat.", "", "a a a A #1!"]
    raw = [t.encode() for t in texts]
    rows = quality_classifier.block_statistics(
        np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    )
    first = dict(zip(quality_classifier.STATISTICS, rows[0].tolist(), strict=True))
    assert first["log_words"] == pytest.approx(math.log(7)) and first["word_bytes"] == pytest.approx(20 / 6)
    assert first["vocabulary"] == pytest.approx(math.log(4) / math.log(7)) and first["repeated_windows"] == 2 / 6
    assert first["distinct_lines"] == 0.5 and first["line_words"] == 3 and first["ends"] == 2 / 6
    assert not rows[1].any()
    third = dict(zip(quality_classifier.STATISTICS, rows[2].tolist(), strict=True))
    assert third["repeated_next"] == 2 / 5 and third["symbols"] == third["marks"] == 1 / 5


def test_the_classifier_separates_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored)
    assert len(scored) > 50 and right >= 0.95 * len(scored)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_nothing_to_learn_from(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, None, "x"), (2, 1, "x"), (None, 0, "x"), (3, 7, "x")], "doc_id long, quality int, text string")
    rows = quality_classifier.classify(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and len({r["score"] for r in rows}) == 1
    assert quality_classifier.classify(no_docs, labels).count() == 0


def test_forward_sums_all_segmentations(piece_bpe):
    index, none, _ = langid.vocabulary(piece_bpe)
    pieces = np.random.default_rng(1).random((none + 1, 2)) * 1e-3
    pieces[-1] = 0

    def summed(word):
        text, total = b" " + word, np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            edges, p = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)], np.ones(2)
            for a, b in itertools.pairwise(edges):
                flat = np.frombuffer(text[a:b], np.uint8)
                k = index.find(span_hashes(prefix_hashes(flat), np.array([0]), np.array([b - a])))[0]
                p = p * ((pieces[k] if k >= 0 else 0) + (langid.FLOOR if b - a == 1 else 0))
            total += p
        return total

    for word in (b"the", b"thing", b"un", "été".encode(), b"zq"):
        assert langid.forward(langid.piece_table([word], piece_bpe), pieces)[0, -1] == pytest.approx(summed(word), rel=1e-9)


LONG_WORDS = [
    "donaudampfschifffahrtsgesellschaftskapitänsmütze", "中文文本没有空格所以一个句子就是一个很长的词", "これはとても長い日本語の文章ですスペースはありません",
    "ภาษาไทยไม่มีช่องว่างระหว่างคำ", "x" * 300, "the" * 50, "ñ" * 41 + "ing", "🙂" * 12,
]


def exact_sums(word, pieces, path):
    """The sum over all segmentations of the whole word, and how often each piece is expected, in many digits."""
    index, none, longest = langid.vocabulary(path)
    text, n = b" " + word, len(word) + 1
    found = {}
    for a in range(n):
        for b in range(a + 1, min(n, a + longest) + 1):
            flat = np.frombuffer(text[a:b], np.uint8)
            k = index.find(span_hashes(prefix_hashes(flat), np.array([0]), np.array([b - a])))[0]
            if k >= 0:
                found[a, b] = int(k)
    totals, expected = [], np.zeros_like(pieces)
    with localcontext(prec=60, Emin=-(10**6)):
        for language in range(pieces.shape[1]):
            weight = {(a, b): Decimal(float(pieces[k, language])) for (a, b), k in found.items()}
            floor = Decimal(langid.FLOOR)
            ahead, behind = [Decimal(1)] + [Decimal(0)] * n, [Decimal(0)] * n + [Decimal(1)]
            for b in range(1, n + 1):
                ahead[b] = ahead[b - 1] * floor + sum(w * ahead[a] for (a, e), w in weight.items() if e == b)
            for a in range(n - 1, -1, -1):
                behind[a] = behind[a + 1] * floor + sum(w * behind[b] for (s, b), w in weight.items() if s == a)
            totals.append(float(ahead[n].ln()))
            for (a, b), w in weight.items():
                expected[found[a, b], language] += float(ahead[a] * w * behind[b] / ahead[n])
    return totals, expected


def test_long_words_are_summed_whole(piece_bpe):
    none = langid.vocabulary(piece_bpe)[1]
    pieces = np.random.default_rng(1).random((none + 1, 2)) ** 4 * 1e-2
    pieces[-1] = 0
    model = langid.Model(["a", "b"], np.zeros(2), pieces)
    words = [*[w.encode() for w in LONG_WORDS], b"short", b"word"]
    scores = langid.word_scores(words, model, piece_bpe)
    sums = np.zeros_like(pieces)
    for word, score in zip(words, scores, strict=True):
        totals, expected = exact_sums(word, pieces, piece_bpe)
        assert score == pytest.approx(totals, rel=1e-9)
        sums += expected
        counted = langid.summed_counts([word], pieces, np.ones((1, 2)), piece_bpe)
        assert np.allclose(counted, expected, rtol=1e-6, atol=1e-12)
    together = langid.summed_counts(words, pieces, np.ones((len(words), 2)), piece_bpe)
    assert np.allclose(together, sums, rtol=1e-6, atol=1e-9)


def test_a_word_is_not_cut(piece_bpe):
    flat = np.frombuffer(("中" * 100 + " " + "b" * 200).encode(), np.uint8)
    starts, ends = langid.word_spans(flat, np.array([0, len(flat)]))
    assert (ends - starts).tolist() == [300, 200]


def test_expected_counts_sum_to_the_pieces_used(piece_bpe):
    none = langid.vocabulary(piece_bpe)[1]
    pieces = np.full((none + 1, 1), 1.0 / none)
    pieces[-1] = 0
    table = langid.piece_table([b"a"], piece_bpe)
    counts = langid.expected_counts(table, pieces, np.array([[3.0]]))
    # " a" is one piece, or (far less likely) two.
    assert counts.sum() == pytest.approx(3, rel=0.01)


def test_languages_of_held_out_documents(spark, piece_bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify_languages(docs, piece_bpe).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_edge_cases(spark, piece_bpe, no_docs, edge_docs):
    rows = [(1, None, "en"), (2, "123 !! 🙂", "en"), (3, "the and of", "en"), (4, "le la de", "fr"), (None, "the", None), (5, "x" * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in langid.identify_languages(docs, piece_bpe).collect()}
    assert got[1][1:] == got[2][1:] == ("und", 0.0) and not got[None][0]
    assert all(0 < got[i][2] <= 1 for i in (3, 4, 5, None))
    assert {r["lang_pred"] for r in langid.identify_languages(edge_docs, piece_bpe).collect()} == {"und"}
    assert langid.identify_languages(no_docs, piece_bpe).count() == 0


def test_the_cost_sample_holds_nulls_and_copies_by_their_share(spark):
    copied = F.when(F.col("id") % 3 == 1, "one text").when(F.col("id") % 3 == 2, F.concat(F.lit("text "), "id"))
    docs = spark.range(60_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), copied.alias("text"))
    sample = quality_rules.sample_of(docs, "text", 1000)
    found = {r["kind"]: r["count"] for r in sample.groupBy(F.substring("text", 1, 4).alias("kind")).count().collect()}
    assert found.keys() == {None, "one ", "text"} and all(230 < n < 440 for n in found.values())
    assert quality_rules.sample_of(docs.limit(500), "text", 1000).count() == 500

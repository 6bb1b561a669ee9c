"""Importance resampling against direct computation, and the draw against a full sort."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from factspark.llm import resampling
from factspark.llm.blocks import flat_bytes

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
MOST = 1 << 62


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]


def brute(docs, target, percent=25):
    """Rows of id, features, weight and score in the order of the draw, and how many are drawn."""
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    ns, nt, out = sum(s.values()) + 10_000, sum(t.values()) + 10_000, []
    for i, words, f in found:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((words < 20, -score, i is None, i or 0, len(f), i, weight, score))
    n = sum(not r[0] for r in out)
    return [(r[5], r[4], r[6], r[7]) for r in sorted(out)], percent * n // 100


@pytest.fixture(scope="module")
def corpus(spark, edge_texts):
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "délta", "42", "中文", "don't", "x_y", "É"]
    docs = list(enumerate(edge_texts))
    docs += [(1000 + i, " ".join(rng.choices(words[i % 4 :], k=rng.randint(15, 60)))) for i in range(300)]
    # A third of all rows is one row; ids repeat with other texts, and some are null.
    docs += [(7777, " ".join(words * 4))] * 350 + [(1000, "Beta " * n) for n in (25, 26, 27)]
    docs += [(None, "alpha " * 30), (None, "gamma " * 31), (-5, "alpha " * 22)]
    rows = [(i, t, 1, "w", 2) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, rank int, words string, score int").repartition(5)
    target = ["beta gamma 42", "délta beta beta", None, ""]
    return docs, frame, target, spark.createDataFrame([(1, t) for t in target], "item_id long, text string")


def test_draw_equals_brute_force(corpus):
    docs, frame, target, target_frame = corpus
    expected, k = brute(docs, target)
    ranked = [(*r, n + 1 if n < k else None) for n, r in enumerate(expected)]
    got = resampling.importance_resample(frame, target_frame)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    rows = [tuple(r) for r in got.collect()]
    assert Counter(rows) == Counter(ranked) and k > 100
    again = resampling.importance_resample(frame.repartition(2), target_frame).collect()
    assert Counter(map(tuple, again)) == Counter(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 57, 58, 59, 60, 399, 400, 500])
def test_first_rows_equal_a_sort(spark, k):
    rng = random.Random(9)
    rows = [(rng.choice([-3, 0, 5, MOST, -MOST]), rng.choice([1, 2, 9]), i) for i in range(400)]
    frame = spark.createDataFrame(rows, "a long, b int, c long")
    got = frame.filter(resampling.first_rows(frame, ["a", "b", "c"], k)).collect()
    assert sorted(map(tuple, got)) == sorted(rows)[:k]


def test_gains_and_means(spark):
    assert resampling.bucket_gains([0, 0], [0, 0]) == [0, 0]
    gains = [5] * 10_000
    gains[zlib.crc32(b"a b") % 10_000] = -4
    texts = spark.createDataFrame([(1, "A? b"), (2, "a b a b"), (3, "")], "doc_id long, text string")
    assert sorted(map(tuple, resampling.weighed(texts, gains).collect())) == [(1, 2, 3, 2), (2, 4, 7, 2), (3, 0, 0, 0)]


def test_features_of_a_block(edge_texts):
    texts = [*edge_texts[:300], "é" * 100 + " B", "x" * 64 + " " + "y" * 65 + " Z", "中" * 40]
    flat, offsets = flat_bytes(pa.array(texts, pa.string()))
    n_words, owner, buckets = resampling.block_features(flat, offsets, 10_000)
    expected = [features(t) for t in texts]
    assert n_words.tolist() == [n for n, _ in expected]
    found = defaultdict(list)
    for i, b in zip(owner.tolist(), buckets.tolist(), strict=True):
        found[i].append(b)
    assert [sorted(found[i]) for i in range(len(texts))] == [sorted(f) for _, f in expected]


def test_empty_tables(spark, corpus, no_docs):
    _, frame, _, target = corpus
    assert resampling.importance_resample(no_docs, target).count() == 0
    rows = resampling.importance_resample(frame.limit(50), target.limit(0)).collect()
    assert len(rows) == 50
    short = spark.createDataFrame([(1, "a few words"), (2, None)], "doc_id long, text string")
    assert all(r["rank"] is None for r in resampling.importance_resample(short, target).collect())

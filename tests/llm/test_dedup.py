"""Suffix-array and SimHash dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from factspark.llm import simhash, suffix_dedup
from factspark.llm.components import components
from factspark.llm.suffix_array import suffix_array

from .conftest import DOCS


def test_suffix_array_equals_sorting():
    rng = random.Random(3)
    for trial in range(1500):
        n, k = rng.randint(0, 12 if trial % 2 else 60), rng.randint(1, 4)
        s = [rng.randint(1, k) for _ in range(n)]
        s = (s[: n // 3] * 4)[:n] if trial % 5 == 0 else s
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def removed(rows, length):
    """What brute force removes: (doc_id, bytes, removed, runs, digest of the rest)."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        out[(i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    shared = [text(20) for _ in range(5)]
    rows = [(1, None), (2, ""), (None, text(60)), (3, "x" * 500), (4, "ab" * 300), (5, shared[0] * 4), (5, shared[0] * 4)]
    rows += [(6, shared[0] * 4 + "z"), (5, "same id, other text"), (7, text(4000))]
    for i in range(150):
        rows.append((10 + i, text(rng.randint(0, 60)) + rng.choice(shared) + text(rng.randint(0, 60)) + shared[i % 5] * (i % 7 == 0)))
    return rows


@pytest.mark.parametrize(("limit", "part"), [(512, 1 << 20), (6, 1 << 20), (0, 500)])
def test_removed_bytes_equal_brute_force(spark, passages, monkeypatch, limit, part):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", part)
    docs = spark.createDataFrame(passages, "doc_id long, text string")
    got = Counter(tuple(r) for r in suffix_dedup.suffix_dedup(docs, 60).collect())
    assert got == removed(passages, 60)


@pytest.mark.parametrize("length", [5, 33, 400])
def test_other_lengths(spark, passages, length):
    rows = [r for r in passages if len(r[1] or "") < 3000][:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in suffix_dedup.suffix_dedup(docs, length).collect())
    assert got == removed(rows, length)


def test_repeated_rows_bring_their_runs_once(spark, passages, monkeypatch):
    rows = [r for r in passages if r[0] is not None and r[0] < 40 and len(r[1] or "") < 3000]
    rows += [passages[5]] * 30 + [passages[2]] * 30
    seen, with_bytes = [], suffix_dedup._with_bytes

    def spied(*args):
        seen.append(with_bytes(*args))
        return seen[-1]

    monkeypatch.setattr(suffix_dedup, "_with_bytes", spied)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in suffix_dedup.suffix_dedup(docs, 60).collect())
    assert got == removed(rows, 60)
    found = Counter((r["h"], r["doc_id"], r["text_hash"], r["lo"]) for r in seen[0].collect())
    assert {i for _, i, _, _ in found} >= {5} and set(found.values()) == {1}


def test_texts_without_repeats(spark, passages):
    rows = [(i, t, "x", None, 1, "r", "z", "h", "w") for i, t in passages]
    docs = spark.createDataFrame(rows, DOCS)
    got = suffix_dedup.without_repeats(docs, 60)
    assert got.columns == docs.columns
    left = Counter((r["doc_id"], r["text"]) for r in got.collect())
    raw = [(t or "").encode() for _, t in passages]
    seen = Counter(b[k : k + 60] for b in raw for k in range(len(b) - 59))
    expected = Counter()
    for (i, t), b in zip(passages, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 59):
            if seen[b[k : k + 60]] > 1:
                gone[k : k + 60] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if not gone.any():
            expected[(i, t)] += 1
        elif kept:
            expected[(i, kept)] += 1
    assert left == expected


def fingerprint(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(codes, names, distance):
    """The smallest name within reach of each code."""
    unique = np.unique(codes)
    parent = {int(c): int(c) for c in unique}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for c in unique:
        for near in unique[np.bitwise_count(unique ^ c) <= distance]:
            parent[find(int(near))] = find(int(c))
    best = {}
    for c, name in zip(codes.tolist(), names, strict=True):
        if name is not None:
            best[find(c)] = min(best.get(find(c), name), name)
    return [best.get(find(c)) for c in codes.tolist()]


def test_fingerprints_and_components(edge_docs):
    docs = edge_docs.filter("doc_id IS NULL OR length(text) < 10000 OR text IS NULL")
    rows = docs.select("doc_id", "text").collect()
    codes = np.array([fingerprint(r["text"]) for r in rows], np.uint64)
    parts = linked(codes, [r["doc_id"] for r in rows], 2)
    expected = Counter((r["doc_id"], f"{c:016x}", p) for r, c, p in zip(rows, codes.tolist(), parts, strict=True))
    assert Counter(tuple(r) for r in simhash.simhash_dedup(docs).collect()) == expected
    kept = simhash.simhash_keep(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        {(p is not None, p or 0) for p in parts}
    )


@pytest.mark.parametrize(("limit", "distance"), [(1 << 16, 2), (20, 2), (20, 3)])
def test_links_in_crowded_groups(spark, monkeypatch, limit, distance):
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rng = np.random.default_rng(5)
    codes = set()
    for base in rng.integers(0, 2**63, 8, dtype=np.uint64).tolist():
        for _ in range(150):
            code = base
            for bit in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                code ^= 1 << bit
            codes.add(code)
    codes = np.array(sorted(codes), np.uint64)
    nodes = spark.createDataFrame([(c,) for c in codes.view(np.int64).tolist()], "fingerprint long")
    labels = {r["node"]: r["label"] for r in components(simhash.links(nodes, distance)).collect()}
    got = [labels.get(c, c) for c in codes.view(np.int64).tolist()]
    expected = linked(codes, list(range(len(codes))), distance)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    labels = {r["node"]: r["label"] for r in components(links).collect()}
    assert len(labels) == 403 and len({labels[i] for i in range(401)}) == 1 and labels[1000] == labels[1001] != labels[0]


def test_no_documents(no_docs):
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0
    assert simhash.simhash_dedup(no_docs).count() == 0
    assert simhash.simhash_keep(no_docs).count() == 0

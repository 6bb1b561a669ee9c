"""Mixing: targets and quotas against direct computation, and what the mix takes."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from factspark.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[n] for n in free)
        part = {n: left * weight[n] / total for n in free}
        over = [n for n in free if part[n] > most * sizes[n]]
        if not over:
            return out | part
        for n in over:
            out[n] = most * sizes[n]
            left -= out[n]
            free.discard(n)
    return out


def seats(shares, n):
    """The highest quotients share / 1, share / 3, ... one by one."""
    won = Counter()
    for _ in range(n):
        best = max(shares, key=lambda u: (shares[u] / (2 * won[u] + 1), [-ord(c) for c in u]))
        won[best] += 1
    return won


def n_words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1000, "d": 5, None: 50}, {"a": 0}, {"a": 7}, {None: 3, "z": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows, (5, 2, 1), 1.5, 2).collect()}
    expected = targets(sizes)
    assert got.keys() == expected.keys()
    assert all(got[n] == pytest.approx(expected[n]) for n in got)


def test_quotas_are_the_highest_quotients(spark):
    shares = {f"s{i}": x for i, x in enumerate([100.0, 33.3, 7.7, 1.2, 0.4, 250.1, 12.5, 12.5001])}
    rows = spark.createDataFrame([(n, 0, 10_000, x) for n, x in shares.items()], "source string, shard int, words long, share double")
    got = {r["source"]: r["quota"] for r in mixing.shard_quotas(rows, 1, 2).collect()}
    assert got == {n: seats(shares, round(sum(shares.values())))[n] for n in shares}


@pytest.fixture(scope="module")
def docs(spark):
    def words(n):
        return " ".join(["w"] * n)

    rows = [(i, words(i % 90) + "\n", "xyz"[i % 3] if i % 7 else None, "a") for i in range(900)]
    rows += [(20_005, "one two", "x", "b"), (20_005, "one two", "x", "b"), (None, words(9), "tiny", "c"), (20_007, None, "x", "d"), (20_008, "", "none", "e")]
    rows += [(10_000, words(20_000), "z", "f")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(3)


@pytest.mark.parametrize("block", [1, 8, 100])
def test_what_the_mix_takes(docs, block):
    rows = mixing.mix_sources(docs, block=block).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], n_words(r["text"])) for r in docs.collect())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    expected = targets(sizes)
    shards = Counter(r["source"] for r in rows)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
    for source, total in taken.items():
        assert abs(total - expected[source]) <= 2 * block * (shards[source] // mixing.SHARD_DOCS + 1) + 1
    again = mixing.mix_sources(docs.repartition(5), block=block).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


@pytest.mark.parametrize("extra", [0, 1, 2, 3])
def test_reruns_agree_over_partitionings(spark, extra):
    """At even and odd numbers of words: 150 percent of an odd one ends in a half."""
    rows = [(i, "w " * (i * 37 % 101), f"s{i * i % 11}") for i in range(2000)] + [(-1, "w " * extra, "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [Counter(map(tuple, mixing.mix_sources(docs.repartition(n)).collect())) for n in (1, 4, 5, 9)]
    words = sum(n_words(t) for _, t, _ in rows)
    assert all(f == found[0] for f in found)
    assert abs(sum(r[5] * n for r, n in found[0].items()) - 1.5 * words) <= 0.5


def test_texts_stay_out_of_the_sorted_rows(docs):
    """What is sorted within shards are sizes; texts are only shuffled by number."""
    plan = mixing.mixed_rows(docs)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line or "hashpartitioning(source" in line]
    assert windows and not any("row#" in line for line in windows)


def test_rows_of_the_mix(docs):
    taken = defaultdict(list)
    for r in mixing.mix_sources(docs).collect():
        taken[r["doc_id"]].append(r["taken"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    found = defaultdict(list)
    for r in got.collect():
        assert texts[r["doc_id"]].startswith(r["text"])
        found[r["doc_id"]].append(n_words(r["text"]))
    assert {i: sum(n) for i, n in found.items()} == {i: sum(t) for i, t in taken.items() if sum(t)}


@pytest.mark.parametrize(("seed", "block"), [(1, 1), (2, 1), (3, 1), (4, 7), (5, 7)])
def test_the_rows_hold_the_words_of_the_chosen_blocks(spark, seed, block):
    """Every word is another one, so that a part of a text shows which part it is."""
    sizes = {"one long text": [500], "few": [40, 1, 0, 200, 30], "many": [3 * i % 50 for i in range(40)]}
    rows, number = [], 0
    for source, counts in sizes.items():
        for n in counts:
            rows.append((number, "\n".join(f"{number}-{i}" for i in range(n)) + " \n", source))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    options = {"seed": seed, "block": block, "weights": (1, 2, 3), "share": 0.7, "most": 2}
    taken = Counter()
    for r in mixing.mix_sources(docs, **options).collect():
        taken[r["source"]] += r["taken"]
    texts, got = {i: t for i, t, _ in rows}, Counter()
    for r in mixing.mixed_rows(docs, **options).collect():
        assert r["text"] in texts[r["doc_id"]]
        got.update(r["text"].split())
    start = F.xxhash64(F.lit(seed + 2), "source", F.lit(0))
    ordered = docs.withColumn("start", start).orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").collect()
    expected = Counter()
    for source in sizes:
        mine = [r for r in ordered if r["source"] == source]
        words = [w for r in mine for w in r["text"].split()]
        blocks = [words[k : k + block] for k in range(0, len(words), block)]
        times, rest = divmod(taken[source], len(words))
        expected.update(words * times)
        place = mine[0]["start"] % len(blocks)
        while rest > 0:
            expected.update(blocks[place])
            rest -= len(blocks[place])
            place = (place + 1) % len(blocks)
        assert rest == 0
    assert got == expected


def test_another_seed_takes_other_documents(docs):
    first, second = ({(r["doc_id"], r["taken"]) for r in mixing.mix_sources(docs, seed=s).collect()} for s in (1, 9))
    assert first != second


def test_plain_columns_only(docs, no_docs):
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "InPandas", "NestedLoop", "Cartesian"))
    assert mixing.mix_sources(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
    assert docs.filter(F.col("text").isNull()).count() == 1

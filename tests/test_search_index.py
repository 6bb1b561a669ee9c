"""The stored index against the search over plain postings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factspark.operators import search as SE
from factspark.operators import search_index as SI
from factspark.operators.fusion import FACT
from factspark.session import fresh_path
from factspark.sources.snapshots import expire, pin

SCHEMA = "breed string, fact_type string, fact_value string, source_list string, mentions_count bigint, final_score double"
WORDS = ["tail", "coat", "no", "long", "short", "usa", "maine", "coon-cat", "été", "x1"]
KINDS = "query string, all_of array<string>, any_of array<string>, none_of array<string>, prefix array<string>"
QUERIES = [
    (1, "tail", None, None, None, None),
    (2, "long coat", None, None, ["usa"], None),
    (3, None, None, ["maine", "coon-cat"], None, None),
    (4, None, None, None, ["tail", "no"], None),
    (5, "", None, None, None, ["c"]),
    (6, "rare", None, None, None, None),
    (7, "tail nowhere", None, None, None, None),
    (8, "été", ["coon-cat"], None, None, ["sh"]),
    (9, " -- ", None, None, None, None),
]


def fact(rng, i):
    value = " ".join(rng.choices(WORDS, k=rng.randint(1, 5))) + f" v{i}"
    score = rng.choice([None, float("nan"), 0.5, 0.5, round(rng.random(), 3), rng.random()])
    return (f"b{i % 7}", "t", value, rng.choice([None, "", "a; b", "c"]), rng.randint(1, 9), score)


def key(rows):
    return [tuple("nan" if v != v else v for v in r) for r in rows]


def expected(spark, facts, limit=None):
    found = SE.search(facts, SE.postings(facts), asked(spark), limit)
    return key(found.select("query_id", *SI.STORED, "rank").collect())


def asked(spark):
    return spark.createDataFrame(QUERIES, "query_id int, " + KINDS)


@pytest.mark.parametrize("limit", [1, 30])
def test_limited_search_equals_the_full_one(spark, monkeypatch, limit):
    monkeypatch.setattr(SI, "SHARES", (1 / 16, 1 / 2))
    rng = random.Random(limit)
    rows = [fact(rng, i) for i in range(160)] + [("b", "t", "rare", "z", 1, 0.01)]
    facts = spark.createDataFrame(rows, SCHEMA)
    at = SI.build_index(facts, fresh_path(spark, "index"))
    found = SI.search_index(spark, at, asked(spark), limit).collect()
    assert key(found) == expected(spark, facts, limit)


def test_unlimited_search_equals_the_plain_one_after_refreshes(spark):
    rng = random.Random(5)
    rows = {i: fact(rng, i) for i in range(60)}
    root = fresh_path(spark, "index")
    SI.build_index(spark.createDataFrame(list(rows.values()), SCHEMA), root)
    for step in range(3):
        for i in rng.sample(sorted(rows), 12):
            rows.pop(i)
        for i in rng.sample(sorted(rows), 8):
            rows[i] = (*rows[i][:3], "tail; usa", 3, rng.random())
        rows |= {i: fact(rng, i) for i in range(100 * (step + 1), 100 * (step + 1) + 10)}
        facts = spark.createDataFrame(list(rows.values()), SCHEMA)
        at = SI.refresh_index(facts, root)
        assert SI.segments(at) == step + 2
    assert SI.refresh_index(facts, root) == at
    assert expire(spark, root, keep=1) == 0
    whole, three = expected(spark, facts), expected(spark, facts, 3)
    assert key(SI.search_index(spark, at, asked(spark)).collect()) == whole
    assert key(SI.search_index(spark, at, asked(spark), 3).collect()) == three
    compacted = SI.compact_index(spark, root)
    assert SI.segments(compacted) == 1
    assert Counter(key(SI.live_facts(spark, compacted).collect())) == Counter(key(facts.collect()))
    assert key(SI.search_index(spark, compacted, asked(spark), 3).collect()) == three
    # A pinned search goes on over its own state.
    assert key(SI.search_index(spark, pin(spark, root, at.number), asked(spark)).collect()) == whole
    assert expire(spark, root, keep=1) == 4 * len(SI.PARTS)
    assert key(SI.search_index(spark, compacted, asked(spark)).collect()) == whole


def test_a_limited_search_reads_few_blocks(spark):
    rows = [("b", "t", f"tail n{i}", "s", 1, i / 2000) for i in range(2000)] + [("b", "t", "rare", "s", 1, 0.0)]
    at = SI.build_index(spark.createDataFrame(rows, SCHEMA), fresh_path(spark, "index"))
    queries = spark.createDataFrame([(1, "tail"), (2, "rare"), (3, "rare nowhere")], "query_id int, query string")
    report = []
    found = SI.search_index(spark, at, queries, 5, report).collect()
    assert [r.fact_value for r in found] == [f"tail n{i}" for i in range(1999, 1994, -1)] + ["rare"]
    # tail ends after the bands of the best facts, rare starts at its own, the third reads none.
    assert len(at.properties["bounds"]) == 3
    assert report[0] == {"band": 0, "queries": 1, "blocks": 1}
    assert report[-1] == {"band": 3, "queries": 1, "blocks": 1}
    assert sum(r["blocks"] for r in report) == 3 < 2 * 4


def test_buckets_and_bands_are_pruned_in_the_scan(spark):
    facts = spark.createDataFrame([("b", "t", "tail", "s", 1, 0.5)], SCHEMA)
    at = SI.build_index(facts, fresh_path(spark, "index"))
    terms = SE.search_terms(spark.createDataFrame([(1, "tail no")], "query_id int, query string"))
    rows, blocks = SI._blocks(SI._postings(spark, at).filter(F.col("band") == 0), terms)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert blocks == 2 and "In(bucket" in plan.split("PushedFilters")[1].split("]")[0]
    assert "(band" in plan.split("PartitionFilters")[1].split("]")[0]
    assert [r.lexeme for r in rows.collect()] == ["tail"]


def test_segments_of_stated_changes(spark, monkeypatch):
    monkeypatch.setattr(SI, "MAX_SEGMENTS", 2)
    root = fresh_path(spark, "index")
    none = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no index"):
        SI.add_segment(none, root)
    at = SI.build_index(none, root)
    assert SI.search_index(spark, at, asked(spark), 2).collect() == []
    one = spark.createDataFrame([("b", "t", "tail", "s", 1, 0.5), ("b", "t", "no tail", "s", 1, None)], SCHEMA)
    at = SI.add_segment(one, root)
    assert [r.fact_value for r in SI.search_index(spark, at, asked(spark), 2).collect() if r.query_id == 1] == ["tail", "no tail"]
    # The same key changed and removed at once is changed; the third segment makes one of all.
    changed = spark.createDataFrame([("b", "t", "tail", "coat", 2, 0.1)], SCHEMA)
    at = SI.add_segment(changed, root, one.select(*FACT))
    assert SI.segments(at) == 1 and SI.live_facts(spark, at).collect() == changed.collect()

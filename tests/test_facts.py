"""Dictionary, fact and fusion operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from factspark.functions.strings import sorted_set
from factspark.operators import crawl
from factspark.operators import facts as FA
from factspark.operators import fusion, joins, quality
from factspark.operators.dedup import keep_first, last_write_wins
from factspark.operators.dictionary import build_dictionary
from factspark.operators.literature import article_list, article_requests, popularity


def parsed(spark, fact):
    df = spark.createDataFrame([(fact,)], "fact string")
    return [(r.fact_type, r.fact_value) for r in FA.parse_facts(df).collect()]


@pytest.mark.parametrize(
    "fact, expected",
    [
        ("CHARACTER: calm ", ("character", "calm")),
        ("feature:Coat = long ", ("feature_coat", "long")),
        ("FEATURE:long", ("feature", "long")),
        ("FEATURE:=long", ("feature_", "long")),
        ("FEATURE:coat=", None),
        ("FEATURE:a=b=c", ("feature_a", "b=c")),
        ("ORIGIN:a:b", ("origin", "a:b")),
        (":x", ("", "x")),
        ("BREED:x", None),
        ("breed:x", None),
        ("novalue", None),
        ("TAG:", None),
        ("TAG:  ", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_fact(spark, fact, expected):
    assert parsed(spark, fact) == ([expected] if expected else [])


@pytest.mark.parametrize(
    "facts, entity",
    [
        ([], None),
        (None, None),
        (["ORIGIN:a", "BREED: B ", "BREED:A"], "B"),
        (["BREED: ", "BREED:A"], ""),
        (["breed:x"], None),
        (["BREED:a:b"], "a:b"),
    ],
)
def test_entity_of_doc(spark, facts, entity):
    df = spark.createDataFrame([(facts,)], "f array<string>")
    assert df.select(FA.entity_of_doc(F.col("f"))).first()[0] == entity


def test_structured_facts(spark):
    rows = [("A", "", "x,  y, x"), (None, "US", None), ("B", "US", "a,b"), ("", None, "")]
    df = spark.createDataFrame(rows, "name string, origin string, temperament string")
    found = [r.extracted_facts for r in FA.structured_facts(df, "p").collect()]
    assert found == [
        ["BREED:A", "CHARACTER:x", "CHARACTER:y", "CHARACTER:x"],
        ["ORIGIN:US"],
        ["BREED:B", "ORIGIN:US", "CHARACTER:a,b"],
        [],
    ]


def test_candidate_facts(spark):
    docs = spark.createDataFrame(
        [
            ("/raw/wiki/1.json", ["BREED:A", "ORIGIN:x", "ORIGIN:x", "breed:q"], None),
            ("/raw/wiki/1.json", ["BREED:A", "ORIGIN:x"], " Book "),
            ("/raw/wiki/2.json", ["BREED: ", "BREED:A", "ORIGIN:x"], None),
            ("/raw/wiki/3.json", None, None),
        ],
        "source_file string, extracted_facts array<string>, source string",
    )
    rows = sorted(tuple(r) for r in FA.candidate_facts(docs).collect())
    path = "/raw/wiki/1.json"
    assert rows == [("A", "origin", "x", "book", path), ("A", "origin", "x", "wiki", path)]
    no_source = sorted(tuple(r) for r in FA.candidate_facts(docs.drop("source")).collect())
    assert no_source == [("A", "origin", "x", "wiki", path)]


def test_normalize_candidates(spark):
    rows = [
        (2, " maine-coon ", "character ", " Calm", None),
        (1, "Maine-COON", "CHARACTER", "calm", " Unknown"),
        (3, None, "a", "b", "c"),
        (4, "x", "", "b", "c"),
    ]
    df = spark.createDataFrame(rows, "id int, breed string, fact_type string, fact_value string, source string")
    found = sorted(tuple(r) for r in FA.normalize_candidates(df, ["id"]).collect())
    assert found == [(1, "Maine-Coon", "CHARACTER", "calm", "unknown"), (4, "X", "", "b", "c")]


def test_build_dictionary(spark):
    lines = [("A B, C D, , A B",), (", X",), ("A, ",), ("",), ("  ",)]
    df = spark.createDataFrame(lines, "line string")
    found = sorted((r.canonical, r.alias, r.toks, r.n) for r in build_dictionary(df, "L").collect())
    assert found == [("A", "A", ["a"], 1), ("A B", "A B", ["a", "b"], 2), ("A B", "C D", ["c", "d"], 2)]


def fuse(spark, rows, weights, **options):
    candidates = spark.createDataFrame(
        rows, "breed string, fact_type string, fact_value string, source string, hdfs_path string"
    )
    return fusion.fuse_facts(candidates, weights, **options)


def test_final_score(spark):
    rows = [("A", "t", "one", "wikipedia", "p")]
    rows += [("A", "t", "two", s, f"p{i}") for s in ("wikipedia", "cat-api") for i in range(2)]
    rows += [("A", "t", "gone", "elsewhere", "p"), ("A", "t", "gone", None, "p")]
    found = {r.fact_value: r for r in fuse(spark, rows, fusion.default_weights(spark)).collect()}
    assert set(found) == {"one", "two"}
    assert found["one"].final_score == pytest.approx(0.44)
    assert found["two"].final_score == pytest.approx(0.396 + 0.2 + 0.2 * (1 - 1 / 3))
    assert (found["two"].mentions_count, found["two"].sources_count) == (4, 2)
    assert found["two"].source_list == "cat-api; wikipedia"


def test_top_ten_and_ties(spark):
    rows = [("A", "t", f"v{i:02}", "petmd", "p") for i in range(25)]
    found = sorted(r.fact_value for r in fuse(spark, rows, fusion.default_weights(spark)).collect())
    assert found == [f"v{i:02}" for i in range(10)]


def test_salted_join_gives_the_same(spark, monkeypatch):
    rows = [("A", "t", f"v{i % 7}", "petmd" if i % 3 else "pubmed", f"p{i}") for i in range(200)]
    weights = fusion.default_weights(spark)
    expected = sorted(map(tuple, fuse(spark, rows, weights).collect()))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    salted = fuse(spark, rows, weights)
    assert sorted(map(tuple, salted.collect())) == expected


def test_popularity_and_article_lists(spark):
    base = "/raw/pubmed/article_list"
    one = "<r><Count>3</Count><IdList><Id>5</Id><Id>6</Id></IdList><Count>9</Count></r>"
    rows = [
        (f"{base}/Maine%20Coon/a.json", one),
        (f"{base}/Maine%20Coon/b.json", "<r><Count>5</Count><IdList><Id>5</Id></IdList></r>"),
        (f"{base}/Maine%20Coon/c.json", "<r></r>"),
        (f"{base}/Manx/c.json", "<broken"),
    ]
    raw = spark.createDataFrame(rows, "source_file string, payload string")
    lists = article_list(raw)
    assert {r["breed"]: r["count"] for r in popularity(lists, "s").collect()} == {"Maine Coon": 8, "Manx": None}
    paths = sorted(r.target_path for r in article_requests(raw, "/o").collect())
    assert paths == ["/o/Maine%20Coon/5.json", "/o/Maine%20Coon/6.json"]


def test_listing_without_result(spark):
    data = '<script id="__NEXT_DATA__">{"props":{"pageProps":{"data":%s}}}</script>'
    rows = [
        ("https://h.org/l", data % '{"result":[],"items":[{"url":"/a"}]}'),
        ("https://h.org/m", data % '{"result":[{"url":"/b"},{"url":""},{"name":"x"}]}'),
        ("https://h.org/n", "<p>nothing</p>"),
        ("https://h.org/o", data % "broken"),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    assert sorted(r.target_url for r in crawl.listing_links(pages).collect()) == ["https://h.org/a", "https://h.org/b"]
    assert [r.link for r in crawl.listing_items(pages, fallback=False).collect()] == ["/b"]


def test_page_title(spark):
    rows = [("https://h.org/a", "<h1 class='x'>T</h1>"), ("https://h.org/maine-coon", "<p>"), ("https://h.org/maine-coon/", "<h1></h1>")]
    pages = spark.createDataFrame(rows, "url string, html string")
    assert [r.title for r in crawl.page_title(pages).collect()] == ["T", "Maine Coon", ""]


def test_search_requests(spark):
    lines = spark.createDataFrame([("Maine Coon, Coon Cat,  ",), ("",)], "line string")
    found = [(r.name, r.target_path) for r in crawl.search_requests(lines, "/l").collect()]
    assert found == [("Maine Coon", "/l/Maine Coon/maine+coon.json"), ("Coon Cat", "/l/Maine Coon/coon+cat.json")]


def test_first_and_last_of_a_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [("cold", 7, "w")]
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(4)
    assert {r.k: r.v for r in keep_first(df, ["k"], ["t"]).collect()} == {"hot": "v0", "cold": "w"}
    assert {r.k: r.v for r in last_write_wins(df, ["k"], ["t"]).collect()} == {"hot": "v499", "cold": "w"}


def test_sorted_set_order_is_pythons(spark):
    values = ["b", "é", "a", "\U0001f600", "￮", "b", "Z"]
    df = spark.createDataFrame([(values,)], "v array<string>")
    assert df.select(sorted_set(F.col("v"))).first()[0] == sorted(set(values))


def test_quality_checks(spark):
    weights = fusion.default_weights(spark)
    assert quality.assert_valid(weights, "source_weights") is weights
    with pytest.raises(ValueError, match="repeat the key"):
        quality.assert_valid(weights.union(weights), "source_weights")
    with pytest.raises(ValueError, match="NULL"):
        quality.assert_valid(weights.withColumn("source", F.lit(None)), "source_weights")

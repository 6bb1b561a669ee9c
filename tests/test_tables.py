"""Readers, writers and search on small tables."""

import hashlib
import json
import math

import pytest
from pyspark.errors import AnalysisException

from factspark.operators import search as SE
from factspark.operators.fusion import default_weights
from factspark.plans import q_sources  # noqa: F401
from factspark.plans.registry import QUERIES
from factspark.schemas import API_RAW, NAMES_RAW, TABLES
from factspark.session import fresh_path, remove_stored
from factspark.sources import readers as R
from factspark.sources import writers as W


def test_dense_ids_over_many_tasks(spark):
    df = spark.range(5000).selectExpr("id % 7 AS k", "'x' AS v").repartition(4)
    rows = W.dense_ids(df, ["k"], "n").collect()
    assert sorted(r.n for r in rows) == list(range(1, 5001))
    assert [r.k for r in sorted(rows, key=lambda r: r.n)] == sorted(r.k for r in rows)


def test_payload_records_are_bounded(spark):
    lines = spark.createDataFrame([(f"l{i:04}",) for i in range(25)], "line string").repartition(3)
    found = {r.record_no: (r.n_lines, r.payload) for r in W.text_payloads(lines, 10).collect()}
    assert found == {
        n: (10 if n < 2 else 5, "\n".join(f"l{i:04}" for i in range(10 * n, min(10 * n + 10, 25))))
        for n in range(3)
    }


def test_envelopes_are_read_back_in_order(spark):
    lines = spark.createDataFrame([(f"l{i:04}",) for i in range(25)], "line string").repartition(3)
    path = fresh_path(spark, "envelopes")
    W.write_text_envelopes(lines, path, "s", 7)
    back = R.read_json(spark, path, NAMES_RAW).orderBy("record_no").collect()
    assert "\n".join(r.payload for r in back) == "\n".join(f"l{i:04}" for i in range(25))
    assert [r.n_lines for r in back] == [7, 7, 7, 4]


def test_replace_folder(spark):
    path = fresh_path(spark, "t")
    W.replace_folder(spark.range(3), path)
    W.replace_folder(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


class _OneRenameFails:
    """A file system whose rename fails the n-th time."""

    def __init__(self, fs, fails):
        self.fs, self.fails, self.calls = fs, fails, 0

    def exists(self, path):
        return self.fs.exists(path)

    def delete(self, path, recursive):
        return self.fs.delete(path, recursive)

    def rename(self, old, new):
        self.calls += 1
        return False if self.calls == self.fails else self.fs.rename(old, new)


@pytest.mark.parametrize("fails", [1, 2])
def test_old_rows_stay_when_a_rename_fails(spark, fails):
    path, staged = fresh_path(spark, "t"), fresh_path(spark, "staged")
    W.replace_folder(spark.range(3), path)
    spark.range(5).write.parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    with pytest.raises(OSError, match="cannot move"):
        W._swap(_OneRenameFails(fs, fails), target, hadoop.Path(staged), hadoop.Path(path + ".old"))
    assert spark.read.parquet(path).count() == 3


def test_replaced_rows_may_come_from_the_folder_itself(spark):
    path = fresh_path(spark, "t")
    W.replace_folder(spark.range(3), path)
    W.replace_folder(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_stored_results_can_be_removed(spark):
    path = fresh_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert remove_stored(spark) >= 1 and remove_stored(spark) == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_write_counted(spark):
    path = fresh_path(spark, "t")
    assert W.write_counted(spark.range(50), path, preview=20)[0] == 50


def test_tables_are_created_and_refreshed(spark):
    W.create_tables(spark)
    W.create_tables(spark)
    assert {t.name for t in spark.catalog.listTables()} >= set(TABLES)
    W.refresh_table(default_weights(spark), "source_weights")
    rows = [("A", "t", f"v{i}", "petmd", "p") for i in range(5)]
    columns = "breed string, fact_type string, fact_value string, source string, hdfs_path string"
    for _ in range(2):
        W.refresh_table(spark.createDataFrame(rows, columns), "candidate_facts", order_by=["fact_value"])
    stored = sorted(map(tuple, spark.table("candidate_facts").collect()))
    assert stored == [(i + 1, *row) for i, row in enumerate(rows)]
    with pytest.raises(ValueError, match="NULL"):
        W.refresh_table(
            spark.createDataFrame([(None, "t", "v", "s", "p")], columns), "candidate_facts",
            order_by=["fact_value"],
        )
    assert spark.table("candidate_facts").count() == 5


def test_files_of_pretty_lists_grow_with_their_size(spark):
    rows = [(f"u{i}", None if i % 7 == 0 else f'a "{i}"\n[b],\t{{c}}') for i in range(300)]
    df = spark.createDataFrame([*rows, (None, None), ("long", "x" * 5000)], "url string, content string").repartition(3)
    path = fresh_path(spark, "lists")
    W.write_json_lists(df, path, characters=800)
    found = R.read_json(spark, path, "url string, content string", multiline=True)
    assert sorted(map(str, found.collect())) == sorted(map(str, df.collect()))
    files = [json.loads(f[0]) for f in spark.read.text(path, wholetext=True).collect()]
    assert [["long"]] == [[r["url"] for r in f] for f in files if "long" in [r.get("url") for r in f]]
    assert 10 < len(files) < 100
    W.write_json_lists(df.limit(0), path)
    assert R.read_json(spark, path, "url string, content string", multiline=True).count() == 0


def test_pages_do_not_take_a_file_each(spark, tmp_path):
    rows = [(i, f"u{i % 90}", f"<p>{i % 90}\n</p>") for i in range(100)] + [(None, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    df = QUERIES["src_json_multiline"](spark, str(tmp_path))
    expected = [(u, h and hashlib.md5(h.encode()).hexdigest()) for _, u, h in rows]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)
    assert len(df.inputFiles()) <= 4


def test_missing_input_and_columns(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        R.read_json(spark, "/no/such/folder", API_RAW)
    with pytest.raises(ValueError, match="content"):
        R.unify_text(spark.range(1))
    with pytest.raises(ValueError, match="url"):
        R.require_columns(spark.range(1), all_of=["url"])


def test_unify_text(spark):
    both = spark.createDataFrame([("c", "p"), (None, "p"), (None, None)], "content string, payload string")
    assert [r.text for r in R.unify_text(both).collect()] == ["c", "p", None]
    assert R.unify_text(both.drop("content")).columns == ["text"]


FACTS = [
    ("Maine Coon", "coat", "long coat", "a; b", 3, 0.9),
    ("Maine Coon", "origin", "usa", "a", 1, 0.5),
    ("Manx", "tail", "no tail no tail", "c", 2, 0.7),
]
SCHEMA = "breed string, fact_type string, fact_value string, source_list string, mentions_count int, final_score double"


def python_rank(text, terms):
    tokens = text.lower().replace(";", " ").split()
    places = [[i + 1 for i, t in enumerate(tokens) if t == term] for term in terms]
    if len(terms) == 1:
        return sum(0.1 / (j * j) for j in range(1, len(places[0]) + 1)) / 1.64493406685
    rest = 1.0
    for a in range(len(places)):
        for b in range(a):
            for p in places[a]:
                for q in places[b]:
                    near = 1 / (1.005 + 0.05 * math.exp(abs(p - q) / 1.5 - 2))
                    rest *= 1 - math.sqrt(0.01 * near)
    return 1 - rest


def test_search(spark):
    facts = spark.createDataFrame(FACTS, SCHEMA)
    rows = [(1, "maine  COON"), (2, " tail "), (3, "no tail"), (4, "tail usa"), (5, "")]
    queries = spark.createDataFrame(rows, "query_id int, query string")
    found = SE.search(facts, SE.postings(facts), queries).collect()
    assert [(r.query_id, r.fact_value) for r in found] == [
        (1, "long coat"), (1, "usa"), (2, "no tail no tail"), (3, "no tail no tail")
    ]
    text = "Manx tail no tail no tail c"
    assert found[2]["rank"] == pytest.approx(python_rank(text, ["tail"]))
    assert found[3]["rank"] == pytest.approx(python_rank(text, ["no", "tail"]))


def test_structured_search(spark):
    facts = spark.createDataFrame(FACTS, SCHEMA)
    rows = [
        (1, ["maine"], None, ["usa"], None),
        (2, None, ["tail", "usa"], None, None),
        (3, None, None, None, ["ma", "us"]),
        (4, None, None, ["coon"], None),
        (5, ["maine"], ["zzz"], None, None),
    ]
    kinds = "all_of array<string>, any_of array<string>, none_of array<string>, prefix array<string>"
    queries = spark.createDataFrame(rows, "query_id int, " + kinds)
    found = SE.match(facts, SE.postings(facts), queries).collect()
    assert sorted((r.query_id, r.fact_value) for r in found) == [
        (1, "long coat"), (2, "no tail no tail"), (2, "usa"), (3, "usa"), (4, "no tail no tail")
    ]


def test_a_limit_holds_for_each_query(spark):
    facts = spark.createDataFrame(FACTS, SCHEMA)
    queries = spark.createDataFrame([(1, "maine"), (2, "manx")], "query_id int, query string")
    found = SE.search(facts, SE.postings(facts), queries, limit=1).collect()
    assert [(r.query_id, r.fact_value) for r in found] == [(1, "long coat"), (2, "no tail no tail")]


def test_terms_are_split_as_the_text_is(spark):
    facts = spark.createDataFrame(FACTS, SCHEMA)
    rows = [(1, "", ["maine-coon"], None, None, None), (2, "maine-coon", None, None, None, None),
            (3, None, None, ["zzz", "no-tail"], None, None), (4, None, None, None, ["coon-zzz", "maine-coon"], None),
            (5, None, None, None, None, ["maine-co"]), (6, "--", None, None, None, ["m"]), (7, " ", None, None, ["--"], None)]
    kinds = "all_of array<string>, any_of array<string>, none_of array<string>, prefix array<string>"
    queries = spark.createDataFrame(rows, "query_id int, query string, " + kinds)
    found = SE.match(facts, SE.postings(facts), queries).collect()
    by_query = {q: sorted(r.fact_value for r in found if r.query_id == q) for q in range(1, 8)}
    assert by_query[1] == by_query[2] == by_query[5] == ["long coat", "usa"]
    assert by_query[3] == by_query[4] == ["no tail no tail"]
    assert by_query[6] == ["long coat", "no tail no tail", "usa"] and by_query[7] == []


def test_queries_that_only_exclude_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(SE, "QUERY_BLOCK", 3)
    facts = spark.createDataFrame(FACTS, SCHEMA)
    queries = spark.createDataFrame([(i, ["coon"]) for i in range(20)], "query_id int, none_of array<string>")
    found = SE.match(facts, SE.postings(facts), queries).collect()
    assert sorted((r.query_id, r.fact_value, r["rank"]) for r in found) == [(i, "no tail no tail", 0.0) for i in range(20)]


def test_a_search_reads_the_buckets_of_its_words(spark):
    facts = spark.createDataFrame(FACTS, SCHEMA)
    path = fresh_path(spark, "postings")
    SE.write_postings(SE.postings(facts), path)
    back = SE.read_postings(spark, path)
    assert back.filter("lexeme = 'tail'").first().positions == [2, 4, 6]
    queries = spark.createDataFrame([(1, "tail")], "query_id int, query string")
    found = SE.matching_postings(back, SE.query_terms(queries))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.fact_value for r in SE.search(facts, back, queries).collect()] == ["no tail no tail"]

"""Every named query against its SQL, and what the plans must look like."""

import os
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from factspark.operators.fusion import FACT  # noqa: E402
from factspark.plans import inputs, q_text  # noqa: E402
from test_tables import python_rank  # noqa: E402
from tools.check import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_search_with_operators_in_full(spark, con):
    """All rows of ``op_search_operators`` against its SQL, and the rank against plain Python."""
    facts = q_text._facts(spark, SF_DIR)
    found = q_text.search(facts, q_text._stored_postings(spark, facts), inputs.mixed_queries(spark)).collect()
    whole = f"SELECT query_id, {', '.join(FACT)}, source_list, mentions_count, final_score FROM ({entry.oracle_sql()['op_search_operators']})"
    expected = Counter(con.execute(whole).fetchall())
    listed = ("query_id", *FACT, "source_list", "mentions_count")
    assert Counter((*[r[c] for c in listed], round(r["final_score"], 9)) for r in found) == expected
    assert max(Counter(r["query_id"] for r in found).values()) > 40
    stored = {tuple(r[c] for c in FACT): (r["source_list"], r["mentions_count"]) for r in facts.collect()}
    assert all((r["source_list"], r["mentions_count"]) == stored[tuple(r[c] for c in FACT)] for r in found)
    asked = {number: (" ".join([plain, *all_of, *any_of]), prefix) for number, plain, all_of, any_of, _, prefix in inputs.MIXED}
    for r in found:
        words = re.findall(r"[^\W_]+", " ".join(r[c] for c in (*FACT, "source_list")).lower())
        exact, prefix = asked[r["query_id"]]
        wanted = set(re.findall(r"[^\W_]+", exact.lower()))
        terms = sorted(w for w in set(words) if w in wanted or w.startswith(tuple(prefix)))
        assert r["rank"] == pytest.approx(python_rank(" ".join(words), terms) if terms else 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["join_gazetteer", "op_search", "op_popularity", "txt_html_to_text",
                                  "crawl_article_ids", "agg_final_score"])
def test_no_python_in_the_plan(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "EvalPython" not in text and "InPandas" not in text and "CartesianProduct" not in text


def test_text_is_matched_without_shuffling_words(spark):
    """Lookups are broadcast, and the only exchange above the scan moves hits to documents."""
    text = plan(entry.queries()["op_extract_facts"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    exchanges = [line for line in text.splitlines() if " Exchange " in line]
    assert len(exchanges) == 1 and "hashpartitioning(doc_id" in exchanges[0]
    assert text.count("Sort [") == 1


@pytest.mark.parametrize("name", ["op_candidate_facts", "txt_html_to_text", "prj_select", "op_normalize_candidates"])
def test_texts_are_not_dealt_out_by_a_fixed_number(spark, name):
    assert "REPARTITION_BY_NUM" not in plan(entry.queries()[name](spark, SF_DIR))


def test_shared_files_are_written_by_as_many_tasks_as_read_the_documents(spark, tmp_path, monkeypatch):
    rows = spark.range(64).selectExpr("id AS doc_id", "'a cat' AS text", "'en' AS lang", "'s' AS source")
    rows.repartition(32).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(q_text, "fresh_path", lambda *_: f"{tmp_path}/records")
    found = q_text.op_extract_shared_files(spark, str(tmp_path))
    tasks = inputs.doc_raw(spark, str(tmp_path)).rdd.getNumPartitions()
    assert len(list((tmp_path / "records").glob("part-*"))) == tasks > 3
    assert found.count() == 64


def test_top_facts_are_cut_before_the_shuffle(spark):
    text = plan(entry.queries()["win_row_number_topk"](spark, SF_DIR))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "BroadcastHashJoin" in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(entry.queries()["agg_final_score"](spark, SF_DIR))
    assert "l_extendedprice" not in text and "l_orderkey" not in text

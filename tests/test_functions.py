"""Column functions against Python and hand-made tables."""

import html
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from factspark.functions import markup as M
from factspark.functions import paths as P
from factspark.functions import strings as S

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
texts = st.lists(st.text(alphabet=st.sampled_from(" \t\n\x0b\x1c\x85\xa0 　aB-'é中1"), max_size=12),
                 min_size=20, max_size=60)


@FEW
@given(texts)
def test_strip_is_pythons(column, values):
    assert column(values, S.strip) == [v.strip() for v in values]


@FEW
@given(texts)
def test_title_case_is_pythons(column, values):
    assert column(values, S.title_case) == [v.title() for v in values]


@FEW
@given(st.lists(st.text(alphabet="ab:= ", max_size=8), min_size=20, max_size=60))
def test_split_at_first(column, values):
    assert column(values, lambda c: S.before_first(c, ":")) == [v.split(":", 1)[0] for v in values]
    after = [v.split(":", 1)[1] if ":" in v else None for v in values]
    assert column(values, lambda c: S.after_first(c, ":")) == after


@FEW
@given(texts)
def test_words_are_pythons(column, values):
    assert column(values, S.words) == [v.split() for v in values]


@pytest.mark.parametrize(
    "path, explicit, source",
    [
        ("hdfs://nn:9000/raw/cat-api/breeds.json", None, "cat-api"),
        ("hdfs://nn:9000/RAW/Wikipedia/cat_articles/A.json", None, "wikipedia"),
        ("hdfs://nn:9000/raw/foo.json", None, "foo.json"),
        ("/processed/x.json", None, "unknown"),
        ("/a/raw/b/raw/c", None, "b"),
        ("/raw//raw/x", None, "raw"),
        ("/raw/", None, "unknown"),
        (None, None, "unknown"),
        ("", None, "unknown"),
        ("/raw/x/y", " PubMed ", "pubmed"),
        ("/raw/petmd/x", "  ", "petmd"),
    ],
)
def test_path_source(spark, path, explicit, source):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(path, explicit)], "path string, explicit string")
    assert df.select(P.path_source(F.col("path"), F.col("explicit"))).first()[0] == source


def test_url_parts(column):
    urls = ["https://h.org/a/maine-coon", "https://h.org/a/maine-coon/", "https://h.org/x?y=1"]
    assert column(urls, P.url_slug) == ["maine-coon", "maine-coon", "x?y=1"]
    assert column(urls, P.slug_title) == ["Maine Coon", "", "X?Y=1"]
    assert column(["/a/b/c.json", "c.json", "/a/b/"], P.parent_dir) == ["b", "", ""]


def test_only_blanks_are_decoded(column):
    assert column(["Maine%20Coon+a%C3%A9"], P.decode_blanks) == ["Maine Coon+a%C3%A9"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a</p><p>b</p>", "a b"),
        ("no markup &amp; <3", "no markup &amp; <3"),
        ('<script>var t="</p>";</script>x<style>p{}</style>y<!-- <b>z</b> -->', "x y"),
        ("<b>open <i>tags", "open tags"),
        ("<p>&lt;b&gt; &amp;lt; &eacute;&#233;&#x1F600;&quot;&#38;gt;</p>", '<b> &lt; éé\U0001f600"&gt;'),
        ("<p>&unknown; &#0; &#xD800;</p>", "&unknown; � �"),
        ("a<script>never closed", "a"),
        ("<!-- never closed <b>x</b>", ""),
        ("<SCRIPT\ntype=a>x</Script\n>kept", "kept"),
        ("", ""),
        (None, None),
    ],
)
def test_html_to_text(column, page, text):
    assert column([page], M.html_to_text) == [text]


def test_entities_match_pythons_table(column):
    names = ["&Agrave;", "&euro;", "&nbsp;x", "&hearts;", "&copy;&copy;", "&yuml;"]
    assert column(names, M.decode_entities) == [html.unescape(n) for n in names]


REFERENCES = ["&amp;", "&#0038;lt;", "&AMP;", "&check;", "&lbrace;", "&#00000065;", "&#X41;", "&#128;", "&#0;", "&#13;",
              "&#xD800;", "&#99999999999;", "&#x81;", "&#1;", "&#xFDD0;", "&#x1FFFE;", "&nosuch;", "&", ";", "lt;", "#38;",
              "&#;", "&NotEqualTilde;", " ", "x", "\n"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(REFERENCES), max_size=6).map(" ".join), min_size=20, max_size=40))
def test_references_decode_as_python_does(column, texts):
    assert column(texts, M.decode_entities) == [html.unescape(t) for t in texts]


BASES = ["https://h.org/a/b/c", "https://h.org", "https://h.org/", "https://h.org/a?x=/y#f", "https://h.org/a//b/?q#z"]
PARTS = ["..", ".", "x", "y.html", "", "..."]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(BASES), st.lists(st.sampled_from(PARTS), max_size=5).map("/".join),
                          st.sampled_from(["", "?a=../b", "#t", "?a#b"])), min_size=20, max_size=40))
def test_links_resolve_as_in_a_browser(spark, rows):
    # Python takes "//" at the start as a host, even an empty one.
    rows = [(base, link + rest) for base, link, rest in rows if not link.startswith("//")]
    df = spark.createDataFrame(rows or [(BASES[0], "")], "base string, link string")
    found = df.select("base", "link", P.resolve_url(df.base, df.link).alias("url")).collect()
    assert [r.url for r in found] == [urljoin(r.base, r.link) for r in found]


@pytest.mark.parametrize(
    "xml, ids",
    [
        ("<r><IdList><Id>1</Id><Id> 2 </Id><Id></Id></IdList></r>", ["1", "2"]),
        ('<?xml version="1.0"?><!DOCTYPE r "x"><r><IdList><Id>7</Id></IdList></r>\n', ["7"]),
        ("<r><IdList><Id>1</Id></IdList><IdList><Id>2</Id></IdList></r>", ["1"]),
        ("<r><IdList/><IdList><Id>2</Id></IdList></r>", None),
        ("<n:r><IdList a='1'><Id t='2'>1</Id></IdList></n:r>", ["1"]),
        ("<!-- a --><r><IdList><Id>1</Id></IdList></r>\n<!-- b -->", ["1"]),
        ("<r><Count>3</Count></r>", None),
        ("<r><IdList><Id>1</Id></IdList>", None),
        ("", None),
        (None, None),
    ],
)
def test_xml_ids(column, xml, ids):
    assert column([xml], M.xml_ids) == [ids]


def test_first_count(column):
    payloads = ["<Count>3</Count><Count>9</Count>", "<r></r>", "<Count>x</Count>", None]
    assert column(payloads, M.first_count) == [3, None, None, None]

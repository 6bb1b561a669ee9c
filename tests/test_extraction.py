"""Text rules against direct Python statements of them."""

import re
import time
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from factspark.operators import extraction as X
from factspark.operators import joins
from factspark.operators.dictionary import patterns
from factspark.operators.search import POSITION_WEIGHT

PHRASES = [
    ("BREED", "Abc", "a b c"), ("BREED", "Cd", "c d"), ("DISEASE", "Bcde", "b c d e"),
    ("SYMPTOM", "D", "d"), ("SYMPTOM", "Aa", "a a"), ("ORIGIN", "place", "b c"), ("ORIGIN", "e", "e"),
    ("BREED", None, "x"),
]
ADJECTIVES = {"a", "d", "e"}
HEADS = {"b": "coat", "bs": "coat"}
SUBJECTS = {"c"}
COPULAS = {"is", "b"}

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
words = st.lists(st.sampled_from("a A b bs c d e x is".split()), max_size=25)
documents = st.lists(words, min_size=5, max_size=25)


def python_matches(tokens):
    """All dictionary phrases, the best first, kept when nothing kept overlaps them."""
    low = [t.lower() for t in tokens]
    hits = set()
    for label, canonical, alias in PHRASES:
        toks = alias.split()
        for i in range(len(low) - len(toks) + 1):
            if low[i : i + len(toks)] == toks:
                hits.add((int(label == "ORIGIN"), -len(toks), i, label, canonical))
    kept = []
    for tier, minus_n, i, label, canonical in sorted(hits, key=lambda h: h[:3]):
        if all(i + -minus_n <= k[0] or k[0] + k[1] <= i for k in kept):
            surface = " ".join(tokens[i : i - minus_n])
            name = canonical if tier == 0 and canonical else surface
            kept.append((i, -minus_n, label, f"{label}:{name}"))
    return kept


def python_facts(tokens):
    low = [t.lower() for t in tokens] + [""] * 8
    matches = python_matches(tokens)
    facts = {m[3] for m in matches}
    for i in range(len(tokens)):
        if low[i] in ADJECTIVES and low[i + 1] in HEADS:
            facts.add(f"FEATURE:{HEADS[low[i + 1]]}={low[i]}")
        if low[i] in ADJECTIVES and low[i + 1] in ADJECTIVES and low[i + 2] in HEADS:
            facts.add(f"FEATURE:{HEADS[low[i + 2]]}={low[i]}")
    ends = [i + 1 for i in range(len(tokens)) if low[i] in SUBJECTS]
    ends += [i + n for i, n, label, _ in matches if label == "BREED"]
    for end in ends:
        for c in range(end, min(end + 3, len(tokens))):
            if low[c] in COPULAS:
                facts |= {f"CHARACTER:{w}" for w in low[c + 1 : c + 3] if w in ADJECTIVES}
    return sorted(facts)


def rules(spark):
    adjectives = spark.createDataFrame([(w,) for w in sorted(ADJECTIVES)], "token string")
    return X.Rules(patterns(spark, PHRASES), adjectives, heads=HEADS,
                   subjects=sorted(SUBJECTS), copulas=sorted(COPULAS))


def corpus(spark, docs):
    rows = [(i, ", ".join(tokens)) for i, tokens in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id int, text string")


@FEW
@given(documents)
def test_matches(spark, docs):
    found = X.gazetteer_match(corpus(spark, docs), patterns(spark, PHRASES))
    ours = sorted((r.doc_id, r.start - 1, r.n, r.label, r.fact) for r in found.collect())
    assert ours == sorted((i, *m) for i, tokens in enumerate(docs) for m in python_matches(tokens))


@FEW
@given(documents)
def test_document_facts(spark, docs):
    found = X.document_facts(corpus(spark, docs), rules(spark), ["doc_id"], "text")
    assert {r.doc_id: r.extracted_facts for r in found.collect()} == {
        i: python_facts(tokens) for i, tokens in enumerate(docs)
    }


def test_lookups_too_large_to_broadcast(spark, monkeypatch):
    docs = ["a b c d e".split(), "x is a d b c d e".split(), [], "A a a a b".split()] * 3
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    found = X.document_facts(corpus(spark, docs), rules(spark), ["doc_id"], "text")
    assert "_salt" in found._jdf.queryExecution().toString()
    assert {r.doc_id: r.extracted_facts for r in found.collect()} == {
        i: python_facts(tokens) for i, tokens in enumerate(docs)
    }


def test_only_words_that_pass_the_filter_are_shuffled(spark, monkeypatch):
    names = spark.range(20_000).selectExpr(
        "'BREED' AS label", "concat('N', id) AS canonical", "concat('breed', id % 50, ' kind', id, IF(id % 2 = 0, ' tail', '')) AS alias"
    ).unionByName(spark.sql("SELECT 'SYMPTOM' AS label, 'Solo' AS canonical, 'solo' AS alias"))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 2_000)
    filler = [f"word{i} breed{i % 50} other{i}" for i in range(2000)]
    texts = [" ".join(filler[i::10]) + f" Breed{i} KIND{50 * i + i} tail solo" for i in range(10)]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id int, text string")
    lexicon = X._lexicon(spark, X.preferred_phrases(X.phrase_table(names)), X.Rules(names))
    assert lexicon.prefilter is not None
    every = X.token_rows(docs, "text", ["doc_id"], 2).count()
    rows = X.token_rows(docs, "text", ["doc_id"], 2, lexicon.prefilter)
    shuffled = [(r["doc_id"], r["pos"], r["context"][0]) for r in rows.collect()]
    # A row for each document, what matches, and others by chance: each of the two tests of a
    # word passes (1 - exp(-3 / 12)) ** 3 = 1.1 % at most. A frequent first word alone is none.
    assert every == 6052 and sum(p == 0 for _, p, _ in shuffled) == 12 and len(shuffled) <= 12 + 20 + 0.03 * every
    assert {(d, w) for d, p, w in shuffled if p} >= {(i, w) for i in range(10) for w in (f"Breed{i}", "solo")}
    found = X.gazetteer_match(docs, names)
    text = found._jdf.queryExecution().toString()
    assert "_salt" in text and "wanted" in text
    expected = {(i, f"N{51 * i}") for i in range(10)} | {(i, "Solo") for i in range(10)}
    assert {(r["doc_id"], r["canonical"]) for r in found.collect()} == expected
    same = X.gazetteer_hits(docs, names).count()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 64 << 20)
    assert X.gazetteer_hits(docs, names).count() == same


def test_a_long_run_of_overlaps(spark):
    docs = [["a"] * 3001, "b c d e".split() * 200]
    found = X.document_facts(corpus(spark, docs), rules(spark), ["doc_id"], "text")
    assert {r.doc_id: r.extracted_facts for r in found.collect()} == {
        i: python_facts(tokens) for i, tokens in enumerate(docs)
    }


def test_extract_facts_keeps_documents_without_facts(spark):
    rows = [
        ("f1", "T", "<p>A b, C</p> &amp; zzz"),
        ("f2", None, ""),
        ("f3", "U", None),
        ("f4", "V", "nothing here"),
    ]
    docs = spark.createDataFrame(rows, "source_file string, title string, text string")
    plain = replace(rules(spark), adjectives=None)
    found = X.extract_facts(docs, plain)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == [
        ("T", "f1", ["BREED:Abc"]), (None, "f2", []), ("U", "f3", []), ("V", "f4", [])
    ]


def test_extra_extractor(spark):
    docs = spark.createDataFrame([("f1", "T", "a b c"), ("f2", "U", "zz")], "source_file string, title string, text string")

    def shout(rows):
        def batches(frames):
            for frame in frames:
                yield frame.assign(fact="LEN:" + frame["text"].str.len().astype(str))[["source_file", "fact"]]

        return rows.mapInPandas(batches, "source_file string, fact string")

    plain = replace(rules(spark), adjectives=None)
    found = X.extract_facts(docs, plain, ["source_file"], extra_extractors=[shout])
    assert {r.source_file: r.extracted_facts for r in found.collect()} == {
        "f1": ["BREED:Abc", "LEN:5"], "f2": ["LEN:2"]
    }


@FEW
@given(st.lists(st.text(alphabet="aÉß1_- \n中İ", max_size=15), min_size=10, max_size=40))
def test_tokens(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string")
    found = {r[0]: r[1] for r in df.select("i", X.tokens(df.text)).collect()}
    assert found == {i: re.findall(r"[^\W_]+", t) for i, t in rows}


def test_rules_need_something(spark):
    assert POSITION_WEIGHT == pytest.approx(0.1)
    empty = patterns(spark, [("L", None, "--")])
    found = X.document_facts(corpus(spark, [["a"]]), X.Rules(empty), ["doc_id"], "text")
    assert found.first().extracted_facts == []


def test_records_of_one_file_stay_apart(spark):
    rows = [("f", "T1", "a b c"), ("f", "T2", "c d"), ("f", "T2", "c d"), ("f", None, None)]
    docs = spark.createDataFrame(rows, "source_file string, title string, text string")
    plain = replace(rules(spark), adjectives=None)
    found = X.extract_facts(docs, plain).collect()
    assert sorted((r.title or "", r.source_file, r.extracted_facts) for r in found) == [
        ("", "f", []), ("T1", "f", ["BREED:Abc"]), ("T2", "f", ["BREED:Cd"]), ("T2", "f", ["BREED:Cd"])
    ]
    with pytest.raises(Exception, match="more than one document"):
        X.extract_facts(docs, plain, ["source_file"]).collect()


LONG = " ".join(f"a{i} x" for i in range(12))


@pytest.mark.parametrize("window", [2, 8])
def test_long_phrases_are_found_in_pieces(spark, monkeypatch, window):
    monkeypatch.setattr(X, "PHRASE_WINDOW", window)
    phrases = [("BREED", "Long", LONG), ("BREED", None, LONG + " tail"), ("SYMPTOM", "X", "x"), ("BREED", "Aa", "b b b")]
    texts = [f"x {LONG} is a", f"{LONG} TAIL", LONG[:-2], f"{LONG} {LONG}", "b b b b b b b is d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    adjectives = spark.createDataFrame([("a",), ("d",)], "token string")
    found = X.document_facts(docs, X.Rules(patterns(spark, phrases), adjectives), ["doc_id"], "text")
    facts = {r.doc_id: r.extracted_facts for r in found.collect()}
    assert facts[0] == ["BREED:Long", "CHARACTER:a", "SYMPTOM:X"]
    assert facts[1] == [f"BREED:{LONG} TAIL"]
    assert facts[2] == ["SYMPTOM:X"] and facts[3] == ["BREED:Long"]
    assert facts[4] == ["BREED:Aa", "CHARACTER:d"]
    hits = X.gazetteer_hits(docs, patterns(spark, phrases)).filter("n > 3").collect()
    assert sorted((r.doc_id, r.start, r.n, r.canonical) for r in hits) == [
        (0, 2, 24, "Long"), (1, 1, 24, "Long"), (1, 1, 25, None), (3, 1, 24, "Long"), (3, 25, 24, "Long")
    ]


def test_very_long_runs_cost_in_proportion(spark):
    def seconds(n):
        docs = spark.createDataFrame([(0, "a " * n)], "doc_id int, text string")
        start = time.perf_counter()
        found = X.gazetteer_match(docs, patterns(spark, [("SYMPTOM", "Aa", "a a")])).count()
        assert found == n // 2
        return time.perf_counter() - start

    seconds(100)
    assert seconds(48_000) <= 2.5 * seconds(24_000) + 2


def test_a_large_dictionary_keeps_the_first_words_broadcast(spark, monkeypatch):
    names = spark.range(200_000).selectExpr(
        "'BREED' AS label", "concat('N', id) AS canonical", "concat('breed', id % 2000, ' kind', id) AS alias"
    )
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 4 << 20)
    docs = spark.createDataFrame([(0, "Breed17 kind4017 and breed3 kind9")], "doc_id int, text string")
    found = X.gazetteer_match(docs, names)
    text = found._jdf.queryExecution().toString()
    assert "_salt" in text and "Join Inner, (first_word" in text and "rightHint=(strategy=broadcast)" in text
    assert [(r.start, r.canonical) for r in found.collect()] == [(1, "N4017")]


def test_facts_are_the_same_with_and_without_word_lists(spark, monkeypatch):
    import random

    from factspark.session import literal_table

    draw = random.Random(5)
    words = ["Red", "blue", "coat", "cat", "is", "was", "the", "maine", "coon", "Cat", "on", "undé", "x1"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "a <b>red</b>&nbsp;coat"])], "k long, text string")
    docs = docs.selectExpr("k", "text", "'t' AS title", "'f' AS source_file")
    phrases = [
        ("BREED", "Maine", "maine coon"), ("BREED", "Cat", "cat"), ("ORIGIN", "o", "coon"), ("ORIGIN", "p", "on the coat"),
        ("TAG", None, "coat"), ("TAG", "t", "the"), ("TAG", "u", "undé x1 cat"),
    ]
    dictionary = literal_table(spark, phrases, "label string, canonical string, alias string")
    adjectives = literal_table(spark, [("red",), ("blue",), ("on",)], "token string")
    for one_word in (False, True):
        chosen = dictionary.filter("alias NOT LIKE '% %'") if one_word else dictionary
        rules = X.Rules(chosen, adjectives, subjects=["x1"], copulas=["is", "was"])
        found = []
        for limit in (2000, 0):
            monkeypatch.setattr(X, "LISTED", limit)
            facts = X.document_facts(docs.withColumn("text", X.without_markup(docs["text"])), rules, ["k"], "text")
            found.append(sorted(map(str, facts.collect())))
        assert found[0] == found[1]
        assert len(found[0]) == 63 and any("CHARACTER" in f for f in found[0])


def test_a_repeated_word_is_shuffled_once(spark):
    from factspark.session import literal_table

    dictionary = literal_table(spark, [("TAG", "c", "coat"), ("TAG", "m", "maine coon")], "label string, canonical string, alias string")
    docs = spark.createDataFrame([(1, "coat and " * 3000 + "maine coon")], "k long, text string")
    phrases = X.preferred_phrases(X.phrase_table(dictionary))
    events, _ = X._events(docs, ["k"], "text", [], X.Rules(dictionary), phrases, once=True)
    assert events.count() <= 3
    assert X.document_facts(docs, X.Rules(dictionary), ["k"], "text").first()["extracted_facts"] == ["TAG:c", "TAG:m"]

"""Features by hand, the lexicon's counts against brute force, and held-out labels."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factspark.llm import toxicity
from factspark.llm.blocks import flat_bytes
from factspark.llm.toxicity import FEATURES, Lexicon

SF = "/root/testdata/sf0.01"
LEXICON = Lexicon((b"idiot ", b"trash ", b"vequ", b"bully "), (4.0, 2.0, 3.0, 1.0))


def measured(texts, lexicon=LEXICON):
    flat, offsets = flat_bytes(pa.array(texts, pa.string()))
    return [SimpleNamespace(**dict(zip(FEATURES, row, strict=True))) for row in toxicity.block_features(flat, offsets, lexicon.plain(), lexicon.squeezed()).tolist()]


def test_features_by_hand():
    texts = ["You IDIOT, you are trash! Really?", "idiots vequelle vequ", None, "", " \n", "!!! 12", "calm words only"]
    a, b, null, empty, blank, signs, calm = measured(texts)
    assert a.log_words == pytest.approx(math.log(7)) and a.hit_density == pytest.approx(2 / 6) and a.log_hits == pytest.approx(math.log(3))
    assert a.hit_kinds == pytest.approx(math.log(3)) and a.strongest == 4 and a.weight_density == 1 and a.burst == 2
    assert a.near_you == 1 and a.you_density == pytest.approx(2 / 6) and a.shouted == pytest.approx(1 / 6)
    assert a.capitals == pytest.approx(7 / 25) and a.exclamations == a.questions == pytest.approx(1 / 6) and a.marks == pytest.approx(3 / 6)
    # A whole word is no beginning: "idiots" is none of the entries.
    assert b.hit_density == pytest.approx(2 / 3) and b.strongest == 3 and b.near_you == 0
    zero = [0.0] * len(FEATURES)
    assert [list(vars(x).values()) for x in (null, empty, blank)] == [zero] * 3
    assert signs.hit_density == 0 and signs.exclamations == 1.5 and calm.log_hits == 0


@pytest.mark.parametrize(
    ("word", "disguised", "inside", "stretched"),
    [
        ("1d10t", True, True, False), ("i.d.i.o.t", True, True, False), ("tr@$h!!!", True, True, False), ("idiooooot", True, False, True),
        ("***idiot***", False, False, False), ("idiot", False, False, False), ("bu11y", False, True, False), ("b-u-l-l-y", True, True, False),
        ("x1y", False, True, False), ("1234", False, False, False), ("veequelle", False, False, False), ("v3qu", True, True, False),
    ],
)
def test_disguised_words(word, disguised, inside, stretched):
    (row,) = measured([f"an {word}"])
    assert (row.disguised_hits > 0, row.obfuscation > 0, row.stretched > 0) == (disguised, inside, stretched)


def test_strongest_entries_equal_brute_force(edge_texts):
    texts = [t.lower() for t in edge_texts[:150] if t] + ["ab abc abcd abcde abd"]
    entries = (b"abc", b"abcd", b"ab ", b"abd ", b"word ", b"wor", "é ".encode(), "中中".encode())
    lexicon = Lexicon(entries, tuple(float(i + 1) for i in range(len(entries))))
    for text in texts:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)
        expected = [max([w for e, w in zip(entries, lexicon.weights, strict=True) if (x.encode() + b" ").startswith(e)], default=0) for x in words]
        flat = np.frombuffer(text.encode(), np.uint8)
        inside = toxicity._LETTER[flat]
        starts, ends = toxicity.runs_of(inside, np.array([0, len(flat)]))
        assert lexicon.plain().strongest(flat, starts, ends).tolist() == expected


def test_near_you_and_bursts_stay_within_their_text():
    texts = ["you", "idiot " + "a " * 5 + "you", "idiot " + "a " * 4 + "you", "idiot " * 80, "trash " + "a " * 60 + "trash"]
    rows = measured(texts)
    assert [r.near_you for r in rows] == [0, 0, 1, 0, 0] and [r.burst for r in rows] == [0, 1, 1, 50, 1]


def test_blocks_do_not_matter(edge_texts):
    whole = measured(edge_texts[:200])
    assert whole == [measured([t])[0] for t in edge_texts[:200]]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    words = [a + b + c for a in ("ka", "lo", "mé") for b in ("ri", "tu", "sen") for c in ("", "x", "dra")]
    rows = []
    for i in range(600):
        text = rng.choices(words, k=rng.randint(8, 60))
        if toxic := i % 5 == 0:
            text += rng.choices(["nasty", "vequ" + rng.choice(words), "Vequ"], k=4)
        rng.shuffle(text)
        rows.append((i, " ".join(text), float(toxic)))
    return rows


def test_entry_counts_equal_brute_force(spark, labelled):
    rows = [(t, label, i % 2) for i, t, label in labelled]
    frame = spark.createDataFrame(rows, "text string, label double, fold int").repartition(3)
    expected = Counter()
    for text, label, fold in rows:
        found = set()
        for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text):
            raw = w.encode().lower()
            found |= {raw + b" "} | {raw[:k] for k in toxicity.STEMS if len(raw) >= k}
        expected.update((e, int(label) + 2 * fold) for e in found)
    entries = sorted({e for e, _ in expected})
    keys = toxicity.entry_keys(entries).view(np.int64).tolist()
    got = {r["key"]: tuple(r)[1:] for r in toxicity.entry_counts(frame).collect()}
    assert got == {k: tuple(expected[e, c] for c in range(4)) for k, e in zip(keys, entries, strict=True)}
    some = np.array(keys[:50], np.int64).view(np.uint64)
    assert toxicity.entry_texts(frame, some) == dict(zip(keys[:50], entries[:50], strict=True))


def test_lexicons_come_from_their_fold(spark, labelled):
    frame = spark.createDataFrame([(t, y, i % 2) for i, t, y in labelled], "text string, label double, fold int")
    first, second, both = toxicity.learn_lexicons(frame.filter("fold = 0 OR label = 0"))
    assert not second.entries and {b"vequ", b"nasty ", b"nast"} <= set(first.entries) and {b"vequ", b"nasty "} <= set(both.entries)
    assert all(not e.startswith((b"kari", b"lotu")) for e in both.entries)


def test_near_copies_count_once(spark):
    texts = ["one two three four five six seven eight nine ten", "a b", "a b", "a c", ""]
    texts += [texts[0] + " " + x for x in ("x", "y", "z")]
    rows = toxicity._sketches(spark.createDataFrame([(t, 1.0) for t in texts], "text string, label double")).collect()
    found = {r["text"]: r["sketch"] for r in rows}
    assert len({found[t] for t in texts[5:] + texts[:1]}) <= 2 and found["a b"] == found["a c"] == found[""] == -1


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    # Some labels of these tables are wrong on purpose.
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.05 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_learned_words_are_found_in_other_texts(spark, labelled):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in labelled] + [(None, "NASTY vequx", "x"), (900, None, "x"), (901, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(y), "x") for i, _, y in labelled] + [(None, 0, "x"), (0, None, "x"), (901, 7, "x")], "doc_id long, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all(got[i]["predicted"] == y for i, _, y in labelled) and got[None]["predicted"] == 1 and not got[None]["held_out"]
    assert got[900]["score"] == got[901]["score"] and got[900]["predicted"] == 0


def test_nothing_to_learn_from(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (4, 7)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and len({r["score"] for r in rows}) == 1
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert toxicity.score_toxicity(edge_docs.withColumn("toxic", F.lit("x")), labels.limit(0)).count() == edge_docs.count()

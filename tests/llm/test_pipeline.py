"""Each stage of the pipeline against brute force on its own input, and the whole run."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from factspark.llm.components import stored
from factspark.llm.mixing import mix_sources

from .test_dedup import fingerprint, linked
from .test_quality import statistics

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(800)]

    def text(n):
        return " ".join(rng.choices(words, k=n)) + "."

    passage = text(90)
    clean = [text(rng.randint(60, 200)) for _ in range(60)]
    texts = [*clean, clean[3], clean[3], clean[4].replace(" ", "  ", 2), clean[5].upper(), None, "", "too short"]
    texts += [text(60) + " " + passage + " " + text(60) for _ in range(4)] + ["junk # * " * 60, "the same words " * 40]
    rows = [(i, t, "en", ["a", "b", None][i % 3], 1) for i, t in enumerate(texts)]
    rows += [rows[0], (None, text(70), None, "a", None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The input and the result of each stage."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, folder), name)
        out.append((docs, result))
        docs = result
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "suffix_dedup", "source_mix", "bpe"]
    assert all(result.columns == docs.columns for docs, result in stages[:-1])


def test_quality_stage(stages):
    docs, result = stages[0]
    assert Counter(rows(result)) == Counter(r for r in rows(docs) if statistics(r[1])[-1])


def test_near_dedup_stage(stages):
    docs, result = stages[1]
    before = rows(docs)
    codes = np.array([fingerprint(t) for _, t in before], np.uint64)
    parts = linked(codes, [i for i, _ in before], 2)
    kept = rows(result)
    assert len(kept) == len(set(parts)) < len(before)
    assert {i for i, _ in kept} == set(parts) and not Counter(kept) - Counter(before)


def test_repeats_stage(stages):
    docs, result = stages[2]
    before, size = rows(docs), corpus_pipeline.REPEAT_BYTES
    raw = [(t or "").encode() for _, t in before]
    seen = Counter(b[k : k + size] for b in raw for k in range(len(b) - size + 1))
    expected = Counter()
    for (i, t), b in zip(before, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = True
        for lo in np.flatnonzero(gone[:-1] & ~np.append(False, gone[:-2])).tolist():
            hi = lo + int(np.flatnonzero(~gone[lo:])[0])
            whole = [m for m in re.finditer(rb"[^\x20\x09-\x0d]+", b) if lo <= m.start() and m.end() <= hi]
            if len(whole) <= corpus_pipeline.REPEAT_WORDS:
                gone[lo:hi] = False
        kept = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes().decode("utf-8", "ignore") if gone.any() else t
        if kept or not gone.any():
            expected[(i, kept)] += 1
    assert Counter(rows(result)) == expected and expected != Counter(before)


def test_passages_of_over_fifty_words_go_and_shorter_ones_stay(spark, folder):
    """Passages of 45 to 60 short and long words, each in three documents."""
    rng = random.Random(6)
    short = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 5))) for _ in range(400)]
    long = ["".join(rng.choices("abcdefghij", k=rng.randint(6, 12))) for _ in range(400)]
    rows, planted = [], {}
    for n in (45, 50, 51, 53, 60):
        for words in (short, long):
            passage = " ".join(rng.choices(words, k=n))
            assert len(passage) >= corpus_pipeline.REPEAT_BYTES or n < 51
            for _ in range(3):
                own = [" ".join(rng.choices(short + long, k=80)) for _ in range(2)]
                planted[len(rows)] = (n, own, passage)
                rows.append((len(rows), f"{own[0]} {passage} {own[1]}", "en", "a", 1))
    result = corpus_pipeline.repeats_stage(spark, spark.createDataFrame(rows, COLUMNS), folder)
    for r in result.collect():
        n, own, passage = planted[r["doc_id"]]
        # A few letters beside a passage may repeat by chance.
        assert (passage in r["text"]) == (n <= 50) and r["text"].startswith(own[0][:-6]) and r["text"].endswith(own[1][6:])
        assert n > 50 or r["text"] == rows[r["doc_id"]][1]


def test_mix_stage(stages):
    docs, result = stages[3]
    taken = defaultdict(int)
    for r in mix_sources(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    found = defaultdict(int)
    texts = dict(rows(docs))
    parts = defaultdict(list)
    for i, t in rows(result):
        # Each row is a run of the document's words: all of them, or the chosen ones.
        assert t in texts[i] and re.findall("[^\x20\x09-\x0d]+", t) and not t[:1].isspace()
        parts[i].append(re.findall("[^\x20\x09-\x0d]+", t))
        found[i] += len(parts[i][-1])
    assert found == {i: n for i, n in taken.items() if n}
    # No word is taken more often than its document's times and once more.
    for i, runs in parts.items():
        whole = re.findall("[^\x20\x09-\x0d]+", texts[i])
        used = Counter(w for run in runs for w in run)
        assert all(used[w] <= -(-found[i] // len(whole)) * n for w, n in Counter(whole).items())


def test_bpe_stage_and_the_whole_run(spark, folder, stages, byte_bpe):
    docs, result = stages[4]
    tokenizer = Tokenizer.from_file(byte_bpe)
    expected = Counter()
    for i, t in rows(docs):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), t))
        expected[(i, len(ids), *digests)] += 1
    assert Counter(map(tuple, result.collect())) == expected
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == expected


def test_registration():
    names = [f"op{n}_" for n in range(1, 14)]
    queries = entry.queries()
    assert all(sum(q.startswith(n) for q in queries) == 1 for n in names) and "pipeline" in queries
    assert corpus_pipeline.ORACLE_SQL is None and {"op2_topk_search", "op5_quality_rules"} <= entry.oracle_sql().keys()

"""Encoding, counts and token files against the libraries themselves."""

import hashlib
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from factspark.llm import bpe, token_counts, token_files
from factspark.llm.blocks import HashIndex, cut_parts, flat_bytes
from factspark.session import fresh_path


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@lru_cache
def library(path):
    return Tokenizer.from_file(path)


def library_ids(path, texts):
    tokenizer = library(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_hash_index_numbers_keys_in_order():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 50_000, dtype=np.uint64))
    index = HashIndex(4)
    index.add(keys[:100])
    index.add(keys[100:])
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1)) < 0).mean() > 0.99


def test_parts_join_to_the_texts():
    flat, offsets = flat_bytes(pa.array(["ab cd ef gh", None, "x" * 40, ""]))
    bounds, owner = cut_parts(flat, offsets, limit=4)
    assert bounds[-1] == len(flat) and (np.diff(bounds) >= 0).all()
    assert sorted(set(owner.tolist())) == [0, 1, 2, 3] and (owner == 0).sum() > 1 and (owner == 2).sum() == 1


def test_round_trip_equals_the_library(edge_docs, byte_bpe):
    rows = edge_docs.select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(byte_bpe)
    expected = Counter()
    for row, ids in zip(rows, library_ids(byte_bpe, [r["text"] for r in rows]), strict=True):
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected[(row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(decoded))] += 1
    got = bpe.bpe_round_trip(edge_docs, byte_bpe)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_ids_decode_to_the_texts(edge_docs, byte_bpe):
    encoded = bpe.bpe_ids(edge_docs, byte_bpe)
    decoded = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(encoded, byte_bpe).collect()}
    assert decoded == {r["doc_id"]: r["text"] or "" for r in edge_docs.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab 's't\n\t  re"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_any_texts_encode_as_the_library_does(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, counts = bpe.encode_texts(pa.chunked_array([pa.array(texts, pa.string())]), bpe.load(path), bpe._table(path))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == library_ids(path, texts)


def test_small_tables_start_anew(edge_texts, byte_bpe, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    table = bpe.PieceTable(bpe.load(byte_bpe).encode)
    texts = [t for t in edge_texts if t is None or len(t) < 5000]
    for first in range(0, len(texts), 60):
        part = texts[first : first + 60]
        ids, _ = bpe.encode_texts(pa.chunked_array([pa.array(part, pa.string())]), bpe.load(byte_bpe), table)
        assert ids.tolist() == [i for x in library_ids(byte_bpe, part) for i in x]


def test_counts_equal_the_library(edge_docs, piece_bpe):
    model = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    expected = Counter()
    for row in edge_docs.collect():
        text = row["text"] or ""
        n = len(model.encode(text))
        expected[(row["doc_id"], len(text.encode()), n, n > 4096)] += 1
    got = token_counts.token_counts(edge_docs, piece_bpe, limit=4096).collect()
    assert Counter(tuple(r) for r in got) == expected
    assert any(r["over_limit"] for r in got)


def test_whole_tokens_are_proven(piece_bpe):
    counter = token_counts.load(piece_bpe)
    assert len(counter.whole) > 20_000
    sample = [w.decode() for w in counter.whole[::500]]
    assert counter.merge(sample).tolist() == [1] * len(sample)


@pytest.mark.parametrize("end_id", [0, 70_000])
def test_token_files_follow_the_ids(spark, edge_docs, byte_bpe, end_id):
    folder = fresh_path(spark, "token-files")
    manifest = token_files.write_token_files(edge_docs, byte_bpe, folder, end_id)
    assert {r["id_bits"] for r in manifest.collect()} == {16 if end_id < 1 << 16 else 32}
    rows = sorted(edge_docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    expected, start = [], 0
    for row, ids in zip(rows, library_ids(byte_bpe, [r["text"] for r in rows]), strict=True):
        data = np.array([*ids, end_id], "<u4").tobytes()
        expected.append((row["doc_id"], start, len(ids) + 1, zlib.crc32(data)))
        start += len(ids) + 1
    got = [tuple(r) for r in token_files.read_token_files(manifest, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected


def test_one_id_of_a_third_of_all_rows_is_dealt_out(spark, byte_bpe, monkeypatch):
    rows = [(7, f"text {i % 40}") for i in range(300)] + [(None, "same")] * 200 + [(-(2**63), "least")] + [(i, "x") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    folder = fresh_path(spark, "token-files")
    # Spark would join parts as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs, byte_bpe, folder).cache()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = manifest.collect()
    assert len(shards) >= 4 and max(r["n_docs"] for r in shards) <= 350 and sum(r["n_null"] for r in shards) == 200
    got = sorted(map(tuple, token_files.read_token_files(manifest, folder, rows_per_batch=37).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert Counter((r[0], r[2]) for r in got) == Counter((i, len(ids) + 1) for (i, _), ids in zip(rows, library_ids(byte_bpe, [t for _, t in rows]), strict=True))
    starts = np.cumsum([0, *(r[2] for r in got)])
    assert [r[1] for r in got] == starts[:-1].tolist()
    # Another file system reads parts of files by their offsets.
    monkeypatch.setattr(token_files, "READ_IDS", 2)

    class Remote(fs.SubTreeFileSystem):
        pass

    path = folder.removeprefix("file:")
    stem = manifest.first()["path"]
    far, near = Remote(path, fs.LocalFileSystem()), fs.LocalFileSystem()
    with token_files._Integers(far, f"{stem}.ids", "<u2") as a, token_files._Integers(near, f"{path}/{stem}.ids", "<u2") as b:
        assert a.mapped is None and b.file is None and (a.part(1, 5) == b.part(1, 5)).all()
        edges = np.array([0, 1, 6])
        assert token_files._checksums(a, edges) == [zlib.crc32(b.part(x, y).astype("<u4")) for x, y in ((0, 1), (1, 6))]


def test_no_documents(spark, no_docs, byte_bpe, piece_bpe):
    assert bpe.bpe_round_trip(no_docs, byte_bpe).count() == 0
    assert token_counts.token_counts(no_docs, piece_bpe).count() == 0
    assert token_files.token_file_digests(no_docs, byte_bpe).count() == 0

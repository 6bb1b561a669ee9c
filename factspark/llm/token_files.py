"""Token ids as flat binary files that training jobs map into memory.

A shard holds three files of little-endian integers: ``.ids`` (the ids of all its documents
end to end, each document closed by the end id, unsigned, of 16 bits where the vocabulary
fits and of 32 bits otherwise), ``.offsets`` (64-bit, one more than documents: where each
document starts in the shard) and ``.docs`` (64-bit document ids). Shards follow each
other in the order of document ids; the manifest names them and gives each its base, the
number of ids in all shards before it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factspark.llm.blocks import gather, prepare
from factspark.llm.bpe import PieceTable, encode_texts, load
from factspark.session import fresh_path

_SHARD = "shard int, path string, id_bits int, n_docs long, n_null long, n_ids long"

_ARROW_SHARD = [
    ("shard", pa.int32()), ("path", pa.string()), ("id_bits", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64()),
]

#: Bytes of texts that are encoded at once: the arrays over their pieces take many times that.
WRITE_BYTES = 3 << 20
#: Ids that are read from a file at once.
READ_IDS = 8 << 20


def _library_table(path: str) -> PieceTable:
    """Pieces encoded by the tokenizers library, each distinct one once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = flat.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        got = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(x) for x in got], np.int64)
        return np.array([i for x in got for i in x], np.int32), lengths

    return PieceTable(encode)


@lru_cache(2)
def _table(path: str) -> PieceTable:
    return _library_table(path)


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the folder's path there."""
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the shards below ``folder`` and return the manifest: _SHARD and ``base``.

    Documents are dealt by ranges of their id and sorted in each task, which writes one
    shard. Rows of one id are dealt further by a hash of their text, and equal rows by
    their place in the input, so that no id is more than one task's share. File names are
    new for every attempt of a task and only the manifest makes a file part of the data,
    so a task that runs again leaves nothing double. A null or empty text has the end id
    alone. Null document ids come first (``n_null`` of a shard, written as 0); equal ids
    follow each other ordered by the hash of their text.
    """
    spark = docs.sparkSession
    prepare(spark)
    named = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    keyed = named.select("*", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "text_hash", "place"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("text_hash", "place")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        model = load(tokenizer)
        id_bits = 16 if max(model.size - 1, end_id) < 1 << 16 else 32
        shard = TaskContext.get().partitionId()
        path = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        n_docs = n_null = n_ids = 0
        with (
            system.open_output_stream(f"{base}/{path}.ids") as ids_file,
            system.open_output_stream(f"{base}/{path}.offsets") as offsets_file,
            system.open_output_stream(f"{base}/{path}.docs") as docs_file,
        ):
            offsets_file.write(np.zeros(1, "<i8").tobytes())
            for table in gather(batches, WRITE_BYTES):
                ids, counts = encode_texts(table["text"], model, _table(tokenizer))
                ends = np.cumsum(counts + 1)
                closed = np.full(len(ids) + len(counts), end_id, f"<u{id_bits // 8}")
                inner = np.ones(len(closed), bool)
                inner[ends - 1] = False
                closed[inner] = ids
                ids_file.write(closed.tobytes())
                offsets_file.write((n_ids + ends).astype("<i8").tobytes())
                docs_file.write(np.array(table["doc_id"].fill_null(0), "<i8").tobytes())
                n_docs += len(counts)
                n_null += table["doc_id"].null_count
                n_ids += len(closed)
        if n_docs:
            row = {"shard": shard, "path": path, "id_bits": id_bits, "n_docs": n_docs, "n_null": n_null, "n_ids": n_ids}
            yield pa.RecordBatch.from_pylist([row], pa.schema(_ARROW_SHARD))

    stored = f"{folder}/manifest"
    dealt.mapInArrow(write, _SHARD).write.parquet(stored)
    # One row per task: small enough for one window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema(_SHARD).parquet(stored)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class _Integers:
    """A file's integers: mapped into memory where the file system is local, else read by parts."""

    def __init__(self, system: fs.FileSystem, path: str, kind: str) -> None:
        self.kind = np.dtype(kind)
        self.mapped = self.file = None
        if isinstance(system, fs.LocalFileSystem):
            self.mapped = np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
        else:
            self.file = system.open_input_file(path)

    def part(self, first: int, last: int) -> np.ndarray:
        if self.file is None:
            return self.mapped[first:last]
        size = self.kind.itemsize
        return np.frombuffer(self.file.read_at((last - first) * size, first * size), self.kind)

    def __enter__(self) -> _Integers:
        return self

    def __exit__(self, *_: object) -> None:
        if self.file is not None:
            self.file.close()


def _checksums(ids: _Integers, edges: np.ndarray) -> list[int]:
    """The checksum of each document's ids, of which few are held at a time."""
    out = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        crc = 0
        for first in range(start, end, READ_IDS):
            crc = zlib.crc32(ids.part(first, min(first + READ_IDS, end)).astype("<u4"), crc)
        out.append(crc)
    return out


def read_token_files(manifest: DataFrame, folder: str, rows_per_batch: int = 20_000) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    The checksum is over the ids as little-endian unsigned 32-bit integers, whatever
    their width in the file.
    """
    shards = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                stem, n = f"{base}/{row['path']}", row["n_docs"]
                with (
                    _Integers(system, f"{stem}.ids", f"<u{row['id_bits'] // 8}") as ids,
                    _Integers(system, f"{stem}.offsets", "<i8") as offsets,
                    _Integers(system, f"{stem}.docs", "<i8") as names,
                ):
                    for first in range(0, n, rows_per_batch):
                        last = min(first + rows_per_batch, n)
                        edges = np.array(offsets.part(first, last + 1))
                        missing = np.arange(first, last) < row["n_null"]
                        yield pa.record_batch({
                            "doc_id": pa.array(np.array(names.part(first, last)), pa.int64(), mask=missing),
                            "start": pa.array(edges[:-1] + row["base"], pa.int64()),
                            "n_tokens": pa.array(np.diff(edges), pa.int64()),
                            "ids_crc32": pa.array(_checksums(ids, edges), pa.int64()),
                        })

    return manifest.repartition(max(1, shards)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents as token files in the shared folder and read them back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder, end_id), folder)

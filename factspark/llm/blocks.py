"""Texts as flat byte arrays, so that tasks work on whole blocks with numpy.

A block holds the UTF-8 bytes of many documents end to end. Tokens are found as
positions in it, and each token is known by a 64-bit polynomial hash over its bytes,
read off prefix sums: looking up a token costs no Python object.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes that one pass of numpy works on, and bytes of texts that are handled together.
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 12 << 20
#: Rows in one Arrow batch: long texts must not meet in batches of many thousand rows.
BATCH_ROWS = 1000

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make the session ready for Python tasks: bounded Arrow batches, this package on the workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="factspark-")) / "factspark-tasks.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)


def map_blocks(df: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` over blocks of rows of about ``BLOCK_BYTES``."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gather(batches):
            yield from fn(table).to_batches(max_chunksize=20_000)

    return df.mapInArrow(run, schema)


def gather(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def flat_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = pc.fill_null(column, empty)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def cut_parts(flat: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of parts of at most about ``limit`` bytes, and the document of each part.

    A long text is cut only before a blank between two ASCII letters or digits, where
    every segmentation used here has a boundary anyway.
    """
    lengths = np.diff(offsets)
    if not (lengths > limit).any():
        return offsets, np.arange(len(lengths))
    bounds, owner = [0], []
    for i, n in enumerate(lengths):
        start, end = int(offsets[i]), int(offsets[i + 1])
        while end - start > limit:
            tail = flat[start + limit : end]
            blanks = np.flatnonzero((tail[1:-1] == 0x20) & _ALNUM[tail[:-2]] & _ALNUM[tail[2:]])
            if not blanks.size:
                break
            start += limit + 1 + int(blanks[0])
            bounds.append(start)
            owner.append(i)
        bounds.append(end)
        owner.append(i)
    return np.array(bounds, np.int64), np.array(owner, np.int64)


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole parts of about ``limit`` bytes: (first part, part after the last)."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield first, last
        first = last


class Powers:
    """Powers of the hash multiplier and of its inverse, as far as they are needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1024)
            for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
                values = np.full(size, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.cumprod(values, dtype=np.uint64))


POWERS = Powers()


def prefix_hashes(flat: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` reads the hash of any span."""
    POWERS.need(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[flat] * POWERS.up[: len(flat)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes, the same wherever the span stands."""
    return mix((sums[ends] - sums[starts]) * POWERS.down[starts] + (ends - starts).astype(np.uint64))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of ``values`` over the whole word (a bijection)."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class HashIndex:
    """A map from 64-bit keys to the numbers 0, 1, 2, ... that looks up whole arrays."""

    def __init__(self, bits: int = 12) -> None:
        self.size = 0
        self._allocate(bits)

    def _allocate(self, bits: int) -> None:
        self.mask = np.int64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_MULTIPLIER)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is unknown."""
        keys = np.maximum(keys, np.uint64(1))
        slots = self._slots(keys)
        found = self.keys[slots]
        numbers = self.numbers[slots]
        todo = np.flatnonzero((found != keys) & (found != 0))
        while todo.size:
            slots[todo] = (slots[todo] + 1) & self.mask
            found = self.keys[slots[todo]]
            numbers[todo] = self.numbers[slots[todo]]
            todo = todo[(found != keys[todo]) & (found != 0)]
        return numbers

    def add(self, keys: np.ndarray) -> None:
        """Number new, distinct keys in their order."""
        keys = np.maximum(keys, np.uint64(1))
        first = self.size
        self.size += len(keys)
        while self.size * 2 > len(self.keys):
            old, numbers = self.keys, self.numbers
            self._allocate(len(old).bit_length())
            held = numbers >= 0
            self._put(old[held], numbers[held])
        self._put(keys, np.arange(first, self.size, dtype=np.int32))

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slots = self._slots(keys)
        todo = np.arange(len(keys))
        while todo.size:
            free = self.keys[slots[todo]] == 0
            tried = todo[free]
            self.keys[slots[tried]] = keys[tried]
            won = tried[self.keys[slots[tried]] == keys[tried]]
            self.numbers[slots[won]] = numbers[won]
            todo = todo[self.numbers[slots[todo]] != numbers[todo]]
            slots[todo] = (slots[todo] + 1) & self.mask


class Ragged:
    """Rows of different lengths, kept end to end, that grow at the end."""

    def __init__(self, dtype: type) -> None:
        self.values = np.zeros(1024, dtype)
        self.ends = np.zeros(1024, np.int64)
        self.rows = 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.ends[self.rows])
        if used + len(values) > len(self.values):
            grown = np.zeros(max(2 * len(self.values), used + len(values)), self.values.dtype)
            grown[:used] = self.values[:used]
            self.values = grown
        if self.rows + len(lengths) + 1 > len(self.ends):
            ends = np.zeros(max(2 * len(self.ends), self.rows + len(lengths) + 1), np.int64)
            ends[: self.rows + 1] = self.ends[: self.rows + 1]
            self.ends = ends
        self.values[used : used + len(values)] = values
        self.ends[self.rows + 1 : self.rows + len(lengths) + 1] = used + np.cumsum(lengths)
        self.rows += len(lengths)

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows + 1] - self.ends[rows]

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``rows`` end to end, and the length of each."""
        starts = self.ends[rows]
        lengths = self.ends[rows + 1] - starts
        return self.values[spread(starts, lengths)], lengths


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each row, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of ``values`` for each row number below ``n``, as exact integers."""
    out = np.zeros(n, np.int64)
    np.add.at(out, rows, values) if len(values) < 64 else out.__iadd__(_grouped(values, rows, n))
    return out


def _grouped(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    edges = np.searchsorted(rows, np.arange(n + 1))
    return sums[edges[1:]] - sums[edges[:-1]]

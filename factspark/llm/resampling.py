"""Resampling a corpus towards a target distribution by importance weights.

Words and pairs of neighbouring words fall into a fixed number of buckets. A bucket's gain
is the logarithm of how much more likely the target is to use it than the corpus; the
gains are one array, and a document's weight is its features' mean gain. Noise that
depends on the document's id alone turns the highest scores into a draw without
replacement. Scores are stored; where the draw ends is found by counting rows on either
side of thresholds, first on the score, then among the rows tied there on the id, and only
the drawn rows are sorted, by ranges.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import chunks, flat_bytes, gather, map_blocks, prepare
from factspark.llm.components import stored
from factspark.llm.segments import runs_of
from factspark.sources.writers import dense_ids

BUCKETS = 10_000
#: Bisection steps that one counting job takes at once: it counts at all their middles.
LEVELS = 4
#: Words of more bytes get their checksum one by one.
WORD_BYTES = 64

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()
_START = np.uint32(0xFFFFFFFF)


def checksums(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The state of crc32 after the bytes of each span, from ``state`` on; the checksum is its complement."""
    sizes = ends - starts
    out = state.copy()
    order = np.argsort(-np.minimum(sizes, WORD_BYTES + 1), kind="stable")
    order = order[np.searchsorted(-sizes[order], -WORD_BYTES, "left") :]
    first, length, current = starts[order], sizes[order], state[order]
    for k in range(int(length[0]) if len(order) else 0):
        active = int(np.searchsorted(-length, -k, "left"))
        now = current[:active]
        current[:active] = _CRC[(now ^ flat[first[:active] + k]) & 0xFF] ^ (now >> 8)
    out[order] = current
    for i in np.flatnonzero(sizes > WORD_BYTES).tolist():
        out[i] = zlib.crc32(flat[starts[i] : ends[i]].tobytes(), int(~state[i])) ^ 0xFFFFFFFF
    return out


def block_features(flat: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text of a block, and of all features (single words first) the text and the bucket."""
    starts, ends = runs_of(_INSIDE[flat], bounds)
    edges = np.searchsorted(starts, bounds)
    n_words = np.diff(edges)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    low = _LOWER[flat]
    single = checksums(low, starts, ends, np.full(len(starts), _START))
    second = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    after_blank = single[second - 1]
    after_blank = _CRC[(after_blank ^ np.uint32(0x20)) & 0xFF] ^ (after_blank >> 8)
    pair = checksums(low, starts[second], ends[second], after_blank)
    return n_words, np.append(owner, owner[second]), (~np.append(single, pair)).astype(np.int64) % buckets


def _texts(df: DataFrame, text_column: str, *keep: Column) -> DataFrame:
    return df.select(*keep, F.col(f"`{text_column}`").cast("string").alias("text"))


def bucket_counts(df: DataFrame, text_column: str, buckets: int) -> list[int]:
    """How many features of all texts fall into each bucket; what comes back is one number for each."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in gather(batches):
            flat, offsets = flat_bytes(table["text"])
            for first, last in chunks(offsets):
                low = int(offsets[first])
                _, _, found = block_features(flat[low : int(offsets[last])], offsets[first : last + 1] - low, buckets)
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    found = _texts(df, text_column).mapInArrow(run, "bucket int, n long")
    counts = [0] * buckets
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: Sequence[int], target: Sequence[int]) -> list[int]:
    """1000 times the logarithm of each bucket's smoothed share in the target over that in the corpus, floored."""
    n = len(corpus)
    all_corpus, all_target = float(sum(corpus) + n), float(sum(target) + n)
    return [
        math.floor(1000 * math.log((float(t + 1) * all_corpus) / (float(s + 1) * all_target)))
        for s, t in zip(corpus, target, strict=True)
    ]


def weighed(docs: DataFrame, gains: Sequence[int]) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of ``doc_id, text``.

    The weight is the floored mean of the features' gains, exact, and 0 without features.
    """
    table_of_gains = np.array(gains, np.int64)

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        words, features = np.zeros((2, len(table)), np.int64)
        total = np.zeros(len(table), np.int64)
        for first, last in chunks(offsets):
            low = int(offsets[first])
            n_words, owner, found = block_features(flat[low : int(offsets[last])], offsets[first : last + 1] - low, len(gains))
            words[first:last] = n_words
            features[first:last] = np.bincount(owner, minlength=last - first)
            # Whole numbers far below 2 ** 53, so that sums in doubles are exact.
            total[first:last] = np.bincount(owner, table_of_gains[found], last - first).astype(np.int64)
        weight = np.where(features > 0, total // np.maximum(features, 1), 0)
        return pa.table({"doc_id": table["doc_id"], "n_words": words, "n_features": features, "weight": weight})

    return map_blocks(docs, run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """-1000 ln(-ln u) floored, with u between 0 and 1 from the id; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def first_rows(rows: DataFrame, order: Sequence[str], k: int) -> Column:
    """What holds for exactly the first ``k`` rows by ``order``, columns of whole numbers without null.

    ``order`` must tell all rows apart and ``rows`` must be stored, as they are counted
    again and again. Column by column the value is found by bisection at which the k-th row
    stands; the rows tied there go on to the next column.
    """
    chosen, tied = F.lit(False), F.lit(True)
    if k <= 0:
        return chosen
    left = k
    for name in order:
        value = F.col(name)
        among = rows.filter(tied)
        low, high, n = among.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
        if left >= n:
            return chosen | tied
        # The k-th row's value is above ``low`` (where ``below`` rows lie) and at most ``high``.
        low, below, upto = low - 1, 0, n
        while high - low > 1:
            middles = sorted({low + (high - low) * i // (1 << LEVELS) for i in range(1, 1 << LEVELS)} - {low, high})
            counts = among.agg(*[F.count_if(value <= F.lit(m)) for m in middles]).first()
            for m, found in zip(middles, counts, strict=True):
                if found < left:
                    low, below = m, found
                else:
                    high, upto = m, found
                    break
        if upto == left:
            return chosen | (tied & (value <= F.lit(high)))
        chosen = chosen | (tied & (value < F.lit(high)))
        tied = tied & (value == F.lit(high))
        left -= below
    raise ValueError("the order does not tell all rows apart")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    buckets: int = BUCKETS,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred (floored)
    with the highest scores are drawn and ranked from 1, ties by the smaller id, a null id
    last, and then by fewer features; the others' rank is null. A null or empty text has
    no features and weight 0. Each row is a document, also where ids or whole rows repeat;
    rows alike in all of this are interchangeable. Empty tables give no rows, an empty
    target evens out the buckets. Other columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, text_column, buckets), bucket_counts(target, target_column, buckets))
    scored = weighed(_texts(docs, text_column, F.col(f"`{id_column}`").cast("long").alias("doc_id")), gains).select(
        "*",
        (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("place"),
    )
    scored = stored(scored, "resampling-scores").select(
        "*",
        (F.col("n_words") >= min_words).alias("eligible"),
        (-F.col("score")).alias("lost"),
        F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("known_id"),
    )
    order = ["lost", "no_id", "known_id", "n_features", "place"]
    eligible = scored.filter("eligible")
    drawn = F.col("eligible") & first_rows(eligible, order, percent * eligible.count() // 100)
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = dense_ids(scored.filter(drawn).select(*out, *order[:3], "place"), order, "rank")
    rest = scored.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, F.col("rank").cast("long").alias("rank")).unionByName(rest)

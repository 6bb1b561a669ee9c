"""SimHash near-dedup over a hierarchical index in Gray order.

Fingerprints within ``max_distance`` bits agree on at least two of ``max_distance + 2``
segments, so each distinct fingerprint goes to one group for each pair of segments. In a
task, the fingerprints of a group are sorted by Gray rank, which puts alike ones side by
side. Nodes above them hold the bits that all their fingerprints share; a child holds only
what its parents don't. A search adds up differences on the way down and drops a whole
node as soon as they exceed the distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.llm.blocks import chunks, flat_bytes, map_blocks, prepare
from factspark.llm.components import components, stored
from factspark.llm.segments import words

#: Fingerprints that one group may hold; larger groups are dealt by more bits.
GROUP_LIMIT = 1 << 16
#: Children of a node, and searches that go down together.
FANOUT = 8
_SEARCHES = 1 << 14
_CHUNK = 2 << 20


def _lower(flat: np.ndarray) -> np.ndarray:
    return np.where((flat >= 0x41) & (flat <= 0x5A), flat + 32, flat).astype(np.uint8)


def shingle_hashes(flat: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle of every text end to end, and the shingles of each text."""
    starts, ends = words(flat, offsets)
    inside = np.zeros(len(flat) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    keep = np.cumsum(inside[:-1]).astype(bool)
    gap = np.zeros(len(flat) + 1, bool)
    gap[ends] = True
    gap = gap[:-1] & ~keep
    joined = np.where(gap, 0x20, flat)[keep | gap].astype(np.uint8).tobytes()
    position = np.cumsum(keep | gap)
    begin, stop = position[starts] - 1, position[ends - 1]
    edges = np.searchsorted(starts, offsets)
    n_words = np.diff(edges)
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - width + 1, 1))
    first = np.repeat(edges[:-1] - (np.cumsum(n_shingles) - n_shingles), n_shingles) + np.arange(n_shingles.sum())
    last = first + np.repeat(np.minimum(n_words, width) - 1, n_shingles)
    digest = xxhash.xxh64_intdigest
    spans = zip(begin[first].tolist(), stop[last].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(first)), n_shingles


def fingerprints_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The 64-bit SimHash of each text; zero for a text without words."""
    flat, offsets = flat_bytes(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for first, last in chunks(offsets, _CHUNK):
        low, high = int(offsets[first]), int(offsets[last])
        hashes, counts = shingle_hashes(_lower(flat[low:high]), offsets[first : last + 1] - low, width)
        out[first:last] = _majority(hashes, counts)
    return out


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits set in over half of each text's hashes."""
    sums = np.zeros((len(counts), 64), np.int64)
    edges = np.concatenate(([0], np.cumsum(counts)))
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for i in np.flatnonzero(counts).tolist():
        for a in range(int(edges[i]), int(edges[i + 1]), 1 << 16):
            bits = np.unpackbits(raw[a : min(a + (1 << 16), int(edges[i + 1]))], axis=1, bitorder="little")
            sums[i] += bits.sum(0, dtype=np.int32)
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, width: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fingerprint`` (long) of every document."""

    def run(table: pa.Table) -> pa.Table:
        found = fingerprints_of(table["text"], width)
        return pa.table({"doc_id": table["doc_id"], "text_hash": table["text_hash"], "fingerprint": pa.array(found.view(np.int64))})

    return map_blocks(keyed(docs, id_column, text_column), run, "doc_id long, text_hash long, fingerprint long")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`").cast("string")
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _segments(n: int, bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``n`` nearly equal segments of ``bits`` bits."""
    edges = [round(i * bits / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _rest_bits(max_distance: int) -> list[int]:
    """The numbers of bits that can be left beside two segments."""
    widths = [width for _, width in _segments(max_distance + 2, 64)]
    return sorted({64 - a - b for a, b in combinations(widths, 2)})


def _gathered(code: Column, segments: list[tuple[int, int]], chosen: tuple[int, ...]) -> Column:
    """The chosen segments of ``code`` next to each other, as the low bits of a long."""
    out, used = F.lit(0).cast("long"), 0
    for i in chosen:
        low, width = segments[i]
        part = F.shiftrightunsigned(code, low).bitwiseAND((1 << width) - 1)
        out = out.bitwiseOR(F.shiftleft(part, used))
        used += width
    return out


def _dealt(code: Column, bits: int, max_distance: int) -> Column:
    """The groups of a code: for each pair of segments their bits, and the bits left."""
    segments = _segments(max_distance + 2, bits)
    groups = []
    for k, pair in enumerate(combinations(range(len(segments)), 2)):
        others = tuple(i for i in range(len(segments)) if i not in pair)
        rest_bits = sum(segments[i][1] for i in others)
        groups.append(F.struct(
            F.lit(k).alias("way"),
            _gathered(code, segments, pair).alias("key"),
            _gathered(code, segments, others).alias("rest"),
            F.lit(rest_bits).alias("rest_bits"),
        ))
    return F.explode(F.array(*groups)).alias("g")


def links(codes: DataFrame, max_distance: int) -> DataFrame:
    """Links ``a``, ``b`` that join what lies within ``max_distance`` bits.

    ``codes`` has distinct values in ``fingerprint``. Of the links within a group only as
    many come out as keep it together, at most one for each member.
    """
    rows = codes.select("fingerprint", _dealt(F.col("fingerprint"), 64, max_distance)).select("fingerprint", "g.*")
    rows = rows.withColumn("sub_way", F.lit(0)).withColumn("sub_key", F.lit(0).cast("long"))
    sizes = rows.groupBy("way", "key").count()
    large = stored(sizes.filter(F.col("count") > GROUP_LIMIT).select("way", "key"), "large-groups")
    if not large.isEmpty():
        # Two more segments of the bits left, so that a group shares three quarters of all.
        split = rows.join(large, ["way", "key"]).select("fingerprint", "way", "key", "rest", "rest_bits")
        rows = rows.join(large, ["way", "key"], "left_anti")
        for bits in _rest_bits(max_distance):
            part = split.filter(F.col("rest_bits") == bits)
            part = part.select("fingerprint", "way", "key", _dealt(F.col("rest"), bits, max_distance))
            rows = rows.unionByName(part.select(
                "fingerprint", "way", "key", "g.rest", "g.rest_bits",
                (F.col("g.way") + 1).alias("sub_way"), F.col("g.key").alias("sub_key"),
            ))
    keys = ["way", "key", "sub_way", "sub_key"]
    prepare(codes.sparkSession)
    dealt = rows.select(*keys, "fingerprint").repartition(*keys).sortWithinPartitions(*keys)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, codes in _whole_groups(batches, keys):
            a, b = _spanning(group, codes, max_distance)
            if len(a):
                yield pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.mapInArrow(solve, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Group numbers and codes of runs of whole groups, some hundred thousand rows at a time."""
    held: list[np.ndarray] = []

    def solved(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        changes = (rows[1:, :-1] != rows[:-1, :-1]).any(1)
        return np.concatenate(([0], np.cumsum(changes))), rows[:, -1].view(np.uint64).copy()

    count = 0
    for batch in batches:
        rows = np.stack([np.asarray(batch.column(k).cast(pa.int64())) for k in [*keys, "fingerprint"]], axis=1)
        if not len(rows):
            continue
        held.append(np.ascontiguousarray(rows))
        count += len(rows)
        if count >= 1 << 18:
            rows = np.concatenate(held)
            inner = np.flatnonzero((rows[1:, :-1] != rows[:-1, :-1]).any(1))
            if len(inner):
                cut = int(inner[-1]) + 1
                yield solved(rows[:cut])
                rows = rows[cut:]
            held, count = [rows], len(rows)
    if count:
        yield solved(np.concatenate(held))


class GrayIndex:
    """Nodes over sorted codes: the bits a node's codes share beyond those of its parents."""

    def __init__(self, group: np.ndarray, codes: np.ndarray) -> None:
        mask, pattern, owner = np.full(len(codes), ~np.uint64(0)), codes, group
        #: Levels from the leaves up: mask, pattern, first child, child after the last.
        self.levels = [(mask, pattern, None, None)]
        while (owner[1:] == owner[:-1]).any():
            place = np.arange(len(owner))
            head = np.concatenate(([True], owner[1:] != owner[:-1]))
            within = place - np.maximum.accumulate(np.where(head, place, 0))
            begins = np.flatnonzero(within % FANOUT == 0)
            ends = np.append(begins[1:], len(owner))
            ones = np.bitwise_and.reduceat(pattern, begins)
            shared = ones | np.bitwise_and.reduceat(~pattern & mask, begins)
            above = np.repeat(shared, ends - begins)
            self.levels[-1] = (mask & ~above, pattern & ~above, *self.levels[-1][2:])
            mask, pattern, owner = shared, ones, owner[begins]
            self.levels.append((mask, pattern, begins, ends))
        self.owner = owner

    def search(self, codes: np.ndarray, roots: np.ndarray, limit: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (search, leaf) within ``limit`` bits, of leaves behind ``after``.

        Search i starts at the top node ``roots[i]``.
        """
        which, node = np.arange(len(codes)), roots
        spent = np.zeros(len(codes), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern, begins, stops = self.levels[level]
            spent = spent + np.bitwise_count((codes[which] ^ pattern[node]) & mask[node])
            near = spent <= limit
            which, node, spent = which[near], node[near], spent[near]
            if begins is not None:
                size = stops[node] - begins[node]
                ends = np.cumsum(size)
                child = np.repeat(begins[node] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
                which, spent, node = np.repeat(which, size), np.repeat(spent, size), child
        later = node > after[which]
        return which[later], node[later]


def _spanning(group: np.ndarray, codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep together what is linked in each group."""
    size = np.bincount(group)
    some = size[group] > 1
    group, codes = group[some], codes[some]
    if not len(codes):
        return codes, codes
    order = np.lexsort((gray_rank(codes), group))
    group, codes = group[order], codes[order]
    index = GrayIndex(group, codes)
    roots = np.searchsorted(index.owner, group)
    root = np.arange(len(codes))
    for first in range(0, len(codes), _SEARCHES):
        part = np.arange(first, min(first + _SEARCHES, len(codes)))
        which, leaf = index.search(codes[part], roots[part], limit, part)
        root = merge_labels(root, part[which], leaf)
    linked = np.flatnonzero(root != np.arange(len(codes)))
    return codes[linked], codes[root[linked]]


def merge_labels(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the smallest member of each member's set) after joining a[i] with b[i]."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def simhash_groups(hashed: DataFrame, max_distance: int) -> DataFrame:
    """One row per fingerprint: its component's smallest document and that one's fingerprint.

    Columns ``fingerprint``, ``component_id`` (null if no document of it has an id) and
    ``kept_fingerprint``.
    """
    nodes = stored(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    labels = components(links(nodes, max_distance))
    labels = labels.select(F.col("node").alias("fingerprint"), "label")
    named = nodes.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    named = stored(named, "labelled")
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    joined = named.join(smallest, "label")
    first = joined.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("label").agg(F.min("fingerprint").alias("kept_fingerprint"))
    return joined.join(first, "label").select("fingerprint", "component_id", "kept_fingerprint")


def simhash_dedup(
    docs: DataFrame, width: int = 3, max_distance: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    A null text counts as empty and has fingerprint zero, as any text without words;
    such texts are linked like all others. Repeated rows share a component. A null id
    never names a component; a component without any id has a null name. Other columns
    are ignored, and an empty table gives no rows.
    """
    hashed = stored(fingerprints(docs, width, id_column, text_column), "fingerprints")
    groups = simhash_groups(hashed, max_distance).select("fingerprint", "component_id")
    named = hashed.select("doc_id", "fingerprint").join(groups, "fingerprint")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def simhash_keep(
    docs: DataFrame, width: int = 3, max_distance: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, the one that names it.

    Among rows with the same smallest id, one with the smallest hash of its text stays.
    """
    hashed = stored(fingerprints(docs, width, id_column, text_column), "fingerprints")
    groups = simhash_groups(hashed, max_distance)
    heads = groups.filter(F.col("fingerprint") == F.col("kept_fingerprint")).select("fingerprint", "component_id")
    chosen = hashed.join(heads, (hashed["fingerprint"] == heads["fingerprint"]) & hashed["doc_id"].eqNullSafe(heads["component_id"]))
    chosen = chosen.groupBy("doc_id", hashed["fingerprint"]).agg(F.min("text_hash").alias("text_hash"))
    chosen = chosen.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    id_value, text = docs[f"`{id_column}`"].cast("long"), docs[f"`{text_column}`"].cast("string")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), id_value.alias("id"), F.xxhash64(text).alias("hash"))
    rows = rows.join(chosen, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    one = Window.partitionBy("id", "hash").orderBy("id")
    return rows.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")

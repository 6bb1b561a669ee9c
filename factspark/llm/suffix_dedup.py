"""Removal of long byte strings that occur more than once, by suffix arrays.

Every window of ``length`` bytes has a smallest hash among its short grams. Equal windows
have equal smallest hashes, so runs of neighbouring windows with the same one are dealt
by it, each window to exactly one place. Runs that are alone there are done, and so are
runs with the same bytes as another one. Of the rest, one run of each content meets in
a task, where a suffix array over their phrases (cut at positions that the content
determines) puts equal beginnings side by side; windows at such places are then compared
exactly. Places that gather very many runs of different content are dealt again by longer
grams, and at last by the whole window.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from factspark.llm.blocks import (
    CHUNK_BYTES,
    chunks,
    flat_bytes,
    gather,
    map_blocks,
    mix,
    prefix_hashes,
    prepare,
    span_hashes,
    spread,
)
from factspark.llm.components import stored
from factspark.llm.simhash import keyed
from factspark.llm.suffix_array import suffix_array

#: Runs of different content that one place may gather.
GROUP_LIMIT = 512
#: Bytes of runs that one suffix array covers.
SOLVE_BYTES = 1 << 20
#: Most bytes of the grams whose smallest hash cuts texts into phrases, and of a phrase.
CUT_GRAM = 8
CUT_REACH = 32

_RUN = "h long, c long, doc_id long, text_hash long, lo long, n int, twin boolean"
_OPEN = "(kinds > 1 or twin) and (not whole or head)"
_SPAN = "doc_id long, text_hash long, lo long, hi long"


def sliding(values: np.ndarray, width: int, ufunc: np.ufunc, neutral: int) -> np.ndarray:
    """``ufunc`` over each window of ``width`` values."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, neutral, values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(rows, width)
    ahead = ufunc.accumulate(padded, axis=1).ravel()
    behind = ufunc.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(behind[:count], ahead[width - 1 : width - 1 + count])


def gram_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` bytes at each position."""
    places = np.arange(max(0, len(sums) - width))
    return span_hashes(sums, places, places + width)


def window_runs(flat: np.ndarray, bounds: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same smallest gram.

    Gives the smallest hash, a hash of the content, the part, the start, the number of
    windows, and whether the smallest gram occurs twice, so that the run's own windows
    may be equal. A window lies within one part of ``bounds``; a run has at most as many
    windows as a window has grams.
    """
    reach = length - gram + 1
    sums = prefix_hashes(flat)
    grams = gram_hashes(sums, gram)
    smallest = sliding(grams, reach, np.minimum, np.iinfo(np.uint64).max)
    sizes = np.diff(bounds)
    part = np.flatnonzero(sizes >= length)
    first, last = bounds[part], bounds[part] + sizes[part] - length
    places = spread(first, last - first + 1)
    owner = np.repeat(part, last - first + 1)
    value = smallest[places]
    change = np.ones(len(places), bool)
    change[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(change)
    runs = np.diff(np.append(starts, len(places)))
    if len(runs) and runs.max() > reach:
        pieces = -(-runs // reach)
        starts = spread(np.zeros(len(pieces), np.int64), pieces) * reach + np.repeat(starts, pieces)
        runs = np.diff(np.append(starts, len(places)))
    lo = places[starts]
    content = span_hashes(sums, lo, lo + runs - 1 + length)
    h = value[starts]
    twin = _occurs_twice(grams, h, lo, lo + runs + reach - 1)
    return h, content, owner[starts], lo, runs, twin


def _occurs_twice(grams: np.ndarray, h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether ``grams`` holds h twice between lo and hi, for each row."""
    known = np.unique(h)
    if not len(known):
        return np.zeros(0, bool)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    places = np.flatnonzero(known[at] == grams)
    order = np.lexsort((places, at[places]))
    rank, places = at[places][order], places[order]
    # Positions of all grams that are some run's smallest, ordered by hash and place.
    span = np.int64(len(grams) + 1)
    key = rank * span + places
    row = np.searchsorted(known, h) * span
    return np.searchsorted(key, row + hi) - np.searchsorted(key, row + lo) > 1


def _long_parts(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of parts whose windows are those of the documents, each once."""
    sizes = np.diff(offsets)
    pieces = np.maximum(1, -(-(sizes - length + 1) // CHUNK_BYTES))
    owner = np.repeat(np.arange(len(sizes)), pieces)
    starts = offsets[:-1][owner] + spread(np.zeros(len(pieces), np.int64), pieces) * CHUNK_BYTES
    return starts, np.minimum(starts + CHUNK_BYTES + length - 1, offsets[1:][owner]), owner


def text_runs(docs: DataFrame, gram: int, length: int) -> DataFrame:
    """The runs of all texts of ``keyed`` documents, as _RUN."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        starts, ends, owner = _long_parts(offsets, length)
        found = []
        edges = np.concatenate(([0], np.cumsum(ends - starts)))
        for first, last in chunks(edges):
            view = np.concatenate([flat[a:b] for a, b in zip(starts[first:last].tolist(), ends[first:last].tolist(), strict=True)])
            low = edges[first]
            h, c, part, lo, n, twin = window_runs(view, edges[first : last + 1] - low, gram, length)
            doc = owner[first:last][part]
            found.append((h, c, doc, lo - (edges[first:last][part] - low) + starts[first:last][part] - offsets[doc], n, twin))
        h, c, doc, lo, n, twin = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = table.select(["doc_id", "text_hash"]).take(pa.array(doc))
        return pa.table({
            "h": h.view(np.int64), "c": c.view(np.int64), "doc_id": ids["doc_id"], "text_hash": ids["text_hash"],
            "lo": lo.astype(np.int64), "n": n.astype(np.int32), "twin": twin,
        })

    return map_blocks(docs, run, _RUN)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def judge_runs(runs: DataFrame) -> DataFrame:
    """Runs that are not alone or may repeat themselves.

    Adds ``whole`` (another run has the same content), ``kinds`` (different contents in
    its place) and ``head`` (the one run that stands for its content).
    """
    row = F.xxhash64("doc_id", "text_hash", "lo")
    kinds = runs.withColumn("row", row).groupBy("h", "c")
    kinds = kinds.agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("first"), F.max("twin").alias("any_twin"))
    kinds = stored(kinds, "run-kinds")
    places = kinds.groupBy("h").agg(
        F.sum("copies").alias("runs"), F.count(F.lit(1)).alias("kinds"), F.max("any_twin").alias("any_twin")
    )
    places = places.filter("runs > 1 or any_twin")
    known = stored(kinds.drop("any_twin").join(places.select("h", "kinds"), "h"), "run-places")
    judged = runs.join(known, ["h", "c"])
    return judged.select(
        *runs.columns, (F.col("copies") > 1).alias("whole"), "kinds", (row == F.col("first")).alias("head")
    )


def _spans(runs: DataFrame, length: int) -> DataFrame:
    return runs.select("doc_id", "text_hash", "lo", (F.col("lo") + F.col("n") - 1 + length).alias("hi"))


def _texts_of(docs: DataFrame, per_text: DataFrame) -> DataFrame:
    return docs.join(per_text, same_row(docs, per_text)).select(docs["doc_id"], docs["text_hash"], "text", "runs")


def _with_bytes(runs: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``runs`` (h, doc_id, text_hash, lo, n) with the bytes of their windows, each run once.

    Repeated rows need no second copy: they have the same runs, which the first step
    removes as whole copies. Only their texts are dealt out to be told apart.
    """
    once = runs.groupBy("h", "doc_id", "text_hash", "lo", "n").agg(F.count(F.lit(1)).alias("rows"))
    per_text = once.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("h", "lo", "n")).alias("runs"), F.max("rows").alias("rows")
    )
    per_text = stored(per_text, "runs-of-texts")
    joined = _texts_of(docs, per_text.filter("rows = 1"))
    repeated = per_text.filter("rows > 1")
    if not repeated.isEmpty():
        joined = joined.unionByName(_texts_of(docs, repeated).dropDuplicates(["doc_id", "text_hash"]))
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = (row["text"] or "").encode()
                for first in range(0, len(row["runs"]), 1000):
                    part = row["runs"][first : first + 1000]
                    yield pa.record_batch({
                        "h": pa.array([r["h"] for r in part], pa.int64()),
                        "doc_id": pa.array([row["doc_id"]] * len(part), pa.int64()),
                        "text_hash": pa.array([row["text_hash"]] * len(part), pa.int64()),
                        "lo": pa.array([r["lo"] for r in part], pa.int64()),
                        "n": pa.array([r["n"] for r in part], pa.int32()),
                        "bytes": pa.array([raw[r["lo"] : r["lo"] + r["n"] - 1 + length] for r in part], pa.binary()),
                    })

    return joined.mapInArrow(cut, "h long, doc_id long, text_hash long, lo long, n int, bytes binary")


def _dealt_again(runs: DataFrame, gram: int, length: int) -> DataFrame:
    """Runs with bytes cut into runs by a longer gram, with their bytes; ``h`` joins both places."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["bytes"])
        found = []
        for first, last in chunks(offsets):
            low = int(offsets[first])
            h, c, part, lo, n, twin = window_runs(flat[low : int(offsets[last])], offsets[first : last + 1] - low, gram, length)
            found.append((h, c, part + first, lo + low, n, twin))
        h, c, part, lo, n, twin = (np.concatenate(x) for x in zip(*found, strict=True))
        old = np.asarray(table["h"]).view(np.uint64)[part]
        ids = table.select(["doc_id", "text_hash", "lo"]).take(pa.array(part))
        sizes = n - 1 + length
        edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        content = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(n), [None, pa.py_buffer(edges), pa.py_buffer(flat[spread(lo, sizes)])]
        )
        return pa.table({
            "h": mix(h ^ mix(old + np.uint64(gram))).view(np.int64), "c": c.view(np.int64),
            "doc_id": ids["doc_id"], "text_hash": ids["text_hash"],
            "lo": np.asarray(ids["lo"]) + lo - offsets[part], "n": n.astype(np.int32), "twin": twin,
            "bytes": content.cast(pa.binary()),
        })

    return map_blocks(runs, run, f"{_RUN}, bytes binary")


def repeated_windows(flat: np.ndarray, bounds: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (given by bytes and numbers of windows) and positions of windows that occur twice.

    Phrases are cut where an 8-gram has the smallest hash within reach, so that equal
    windows are cut alike from their smallest gram on; suffixes that begin with as many
    equal bytes as such windows must share from there stand side by side.
    """
    gram, reach = max(1, min(CUT_GRAM, length // 8)), max(1, min(CUT_REACH, length // 8))
    sums = prefix_hashes(flat)
    grams = gram_hashes(sums, gram)
    low = sliding(grams, reach, np.minimum, np.iinfo(np.uint64).max)
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), low, np.zeros(reach - 1, np.uint64)])
    cut = np.zeros(len(flat), bool)
    cut[: len(grams)] = sliding(padded, reach, np.maximum, 0) == grams
    cut[bounds[:-1]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(flat))
    names = np.unique(span_hashes(sums, starts, ends), return_inverse=True)[1] + 2
    # One symbol below all phrases closes each run.
    closing = np.searchsorted(starts, bounds[1:])
    symbols = np.insert(names, closing, 1)
    places = np.insert(starts, closing, -1)
    order = places[suffix_array(symbols)]
    order = order[order >= 0]
    # From a cut in the first ``reach`` bytes to one in the last ``reach + gram``.
    shared = max(1, length - 2 * reach - gram)
    stop = bounds[np.searchsorted(bounds, order, "right")]
    fits = order + shared <= stop
    key = span_hashes(sums, order, np.where(fits, order + shared, order))
    alike = np.zeros(len(order) + 1, bool)
    alike[1:-1] = (key[1:] == key[:-1]) & fits[1:] & fits[:-1]
    places = order[alike[1:] | alike[:-1]]
    near = np.zeros(len(flat) + 1, np.int64)
    np.add.at(near, np.maximum(places - reach + 1, 0), 1)
    np.add.at(near, places + 1, -1)
    windows = spread(bounds[:-1], counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    picked = np.cumsum(near)[windows] > 0
    windows, owner = windows[picked], owner[picked]
    whole = span_hashes(sums, windows, windows + length)
    _, back, times = np.unique(whole, return_inverse=True, return_counts=True)
    twice = times[back] > 1
    return owner[twice], windows[twice]


def _solved(runs: DataFrame, length: int) -> DataFrame:
    """Spans of the repeated windows among runs that meet in the same place."""
    dealt = runs.select("h", "doc_id", "text_hash", "lo", "n", "bytes").repartition("h").sortWithinPartitions("h")
    prepare(runs.sparkSession)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_places(batches):
            flat, bounds = flat_bytes(table["bytes"])
            owner, windows = repeated_windows(flat, bounds, np.asarray(table["n"]).astype(np.int64), length)
            if not len(owner):
                continue
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (windows[1:] - windows[:-1] > length)
            at = np.flatnonzero(first)
            last = np.append(at[1:], len(owner)) - 1
            run = owner[at]
            shift = np.asarray(table["lo"])[run] - bounds[run]
            ids = table.select(["doc_id", "text_hash"]).take(pa.array(run))
            spans = {"doc_id": ids["doc_id"], "text_hash": ids["text_hash"], "lo": windows[at] + shift, "hi": windows[last] + shift + length}
            yield from pa.table(spans).to_batches()

    return dealt.mapInArrow(solve, _SPAN)


def _whole_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``SOLVE_BYTES`` that hold all rows of their places."""
    rest: pa.Table | None = None
    for table in gather(batches, SOLVE_BYTES):
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        h = np.asarray(table["h"])
        changes = np.flatnonzero(h[1:] != h[:-1])
        if not len(changes):
            rest = table
            continue
        cut = int(changes[-1]) + 1
        yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """_SPAN: byte ranges of ``keyed`` documents that repeated strings of ``length`` bytes cover."""
    grams = [min(32, length), length * 3 // 4, length * 19 // 20, length]
    runs = judge_runs(stored(text_runs(docs, grams[0], length), "runs"))
    runs = stored(runs, "judged-runs")
    spans = _spans(runs.filter("whole"), length)
    open_runs = runs.filter(_OPEN)
    if open_runs.isEmpty():
        return spans
    with_bytes = stored(_with_bytes(open_runs.select("h", "doc_id", "text_hash", "lo", "n", "kinds"), docs, length), "open-runs")
    large = stored(open_runs.filter(F.col("kinds") > GROUP_LIMIT).select("h").distinct(), "large-places")
    crowded = not large.isEmpty()
    met = with_bytes.join(large, "h", "left_anti") if crowded else with_bytes
    for gram in grams[1:]:
        if not crowded:
            break
        again = stored(_dealt_again(with_bytes.join(large, "h", "left_semi"), gram, length), "dealt-again")
        judged = stored(judge_runs(again.drop("bytes")), "judged-runs")
        spans = spans.unionByName(_spans(judged.filter("whole"), length))
        open_runs = judged.filter(_OPEN).select("h", "doc_id", "text_hash", "lo", "n", "kinds")
        if gram == length or open_runs.isEmpty():
            break
        keys = open_runs.select("h", "doc_id", "text_hash", "lo").withColumnRenamed("doc_id", "d").withColumnRenamed("lo", "l")
        keys = keys.withColumnRenamed("h", "k").withColumnRenamed("text_hash", "t").distinct()
        same = (
            (again["h"] == keys["k"]) & again["doc_id"].eqNullSafe(keys["d"]) & (again["text_hash"] == keys["t"]) & (again["lo"] == keys["l"])
        )
        with_bytes = stored(again.join(keys, same, "left_semi"), "open-runs")
        large = stored(open_runs.filter(F.col("kinds") > GROUP_LIMIT).select("h").distinct(), "large-places")
        crowded = not large.isEmpty()
        met = met.unionByName((with_bytes.join(large, "h", "left_anti") if crowded else with_bytes).select(*met.columns))
    return spans.unionByName(_solved(met, length))


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], min(s["hi"], size)) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, removed: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in removed:
        out.append(raw[at:lo])
        at = hi
    return b"".join([*out, raw[at:]])


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """``keyed`` documents (and what else they hold) with their spans."""
    spans = repeated_spans(docs.select("doc_id", "text_hash", "text"), length)
    per_text = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return docs.join(per_text, same_row(docs, per_text), "left").select(*[docs[c] for c in docs.columns], "spans")


def _map_rows(
    df: DataFrame,
    fn: Callable[[bytes, list[tuple[int, int]]], tuple],
    kinds: dict[str, pa.DataType],
    keep: str,
    schema: str | StructType,
) -> DataFrame:
    """``keep`` and what ``fn`` makes of each text's bytes and removed runs."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = (text or "").encode()
                rows.append(fn(raw, _merged(spans, len(raw))))
            columns = {keep: batch.column(keep)}
            for k, (name, kind) in enumerate(kinds.items()):
                columns[name] = pa.array([r[k] for r in rows], kind)
            yield pa.record_batch(columns)

    return df.select(keep, "text", "spans").mapInArrow(run, schema)


def suffix_dedup(docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte is removed if a string of ``length`` bytes covers it that also starts anywhere
    else, in the same document or another; all occurrences go, overlaps count, and
    strings are judged on the input. A null text is empty; a text shorter than
    ``length`` keeps all its bytes. Repeated rows are each other's copies. Other columns
    are ignored, and an empty table gives no rows.
    """
    kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}

    def digest(raw: bytes, removed: list[tuple[int, int]]) -> tuple:
        return len(raw), sum(b - a for a, b in removed), len(removed), hashlib.sha256(_kept(raw, removed)).hexdigest()

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _map_rows(_with_spans(keyed(docs, id_column, text_column), length), digest, kinds, "doc_id", schema)


_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _words_within(raw: bytes, lo: int, hi: int) -> int:
    """How many words of the text lie in the range whole."""
    if lo and not _BLANK.match(raw, lo - 1):
        lo = next((m.start() for m in [_BLANK.search(raw, lo, hi)] if m), hi)
    if hi < len(raw) and not _BLANK.match(raw, hi):
        while hi > lo and not _BLANK.match(raw, hi - 1):
            hi -= 1
    return sum(1 for _ in _WORD.finditer(raw, lo, hi))


def without_repeats(
    docs: DataFrame, length: int = 400, over_words: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of their text.

    Of the maximal runs of bytes that repeated strings of ``length`` bytes cover, those go
    that hold more than ``over_words`` whole words, so that ``length`` may be chosen short
    enough for passages of short words. A character of which only some bytes are removed goes
    whole, and a document of which nothing is left is dropped; one that was empty before stays.
    """
    id_value, text = docs[f"`{id_column}`"].cast("long"), docs[f"`{text_column}`"].cast("string")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        id_value.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"),
    )
    found = _with_spans(rows, length)

    def cut(raw: bytes, removed: list[tuple[int, int]]) -> tuple:
        removed = [(lo, hi) for lo, hi in removed if not over_words or _words_within(raw, lo, hi) > over_words]
        return _kept(raw, removed).decode("utf-8", "ignore"), bool(removed)

    schema = StructType([rows.schema["row"], StructField("left_text", StringType()), StructField("changed", BooleanType())])
    mapped = _map_rows(found, cut, {"left_text": pa.string(), "changed": pa.bool_()}, "row", schema)
    mapped = mapped.filter("not changed or left_text != ''")
    value = F.when(F.col("changed"), F.col("left_text")).otherwise(F.col("row")[text_column])
    return mapped.select(*[(value if c == text_column else F.col("row")[c]).alias(c) for c in docs.columns])

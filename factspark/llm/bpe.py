"""BPE encoding and decoding with an index of where each pair occurs.

The distinct pieces of a block are laid end to end. An index maps each pair that has a
merge rank to all its positions; ranks are applied in ascending order, each to all its
positions at once, and the lists of the neighbouring pairs are updated. A table keeps the
ids of pieces already seen, so that each distinct piece is merged once per worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import (
    HashIndex,
    Ragged,
    chunks,
    cut_parts,
    flat_bytes,
    map_blocks,
    prefix_hashes,
    row_sums,
    span_hashes,
    spread,
)
from factspark.llm.segments import byte_level

#: Pieces longer than this are merged each time; the table keeps the shorter ones.
KEPT_BYTES = 64
#: Pieces in a worker's table before it starts anew; a bound on memory only.
KEPT_PIECES = 2_000_000


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary with its merges, read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        text = {i: bytes(symbols[c] for c in token) for token, i in vocab.items() if token not in self.special}
        text |= {i: token.encode() for token, i in self.special.items()}
        self.bytes = [text.get(i, b"") for i in range(max(text) + 1)]
        self.size = len(self.bytes)
        self.start = np.array([vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank = HashIndex(18)
        self.rank.add(self._key(self.left, self.right))

    def _key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) * np.uint64(self.size) + right.astype(np.uint64) + np.uint64(1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 where there is none."""
        return self.rank.find(self._key(left, right))

    def encode(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given spans of ``flat`` end to end, and the number of each span's ids."""
        lengths = ends - starts
        symbol = self.start[flat[spread(starts, lengths)]]
        n = len(symbol)
        following = np.arange(1, n + 1)
        preceding = np.arange(-1, n - 1)
        piece_end = np.cumsum(lengths)
        full = lengths > 0
        following[piece_end[full] - 1] = -1
        preceding[(piece_end - lengths)[full]] = -1
        alive = np.ones(n, bool)

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Add the pairs that start at the given positions to the index."""
            rank = self.ranks(symbol[at], symbol[following[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            edges = np.flatnonzero(np.diff(rank)) + 1
            begins = np.concatenate(([0], edges, [len(at)])).tolist()
            for r, a, b in zip(rank[begins[:-1]].tolist(), begins[:-1], begins[1:], strict=True):
                if r in places:
                    places[r].append(at[a:b])
                else:
                    places[r] = [at[a:b]]
                    heapq.heappush(active, r)

        note(np.flatnonzero(following >= 0))
        while active:
            r = heapq.heappop(active)
            found = places.pop(r)
            at = found[0] if len(found) == 1 else np.concatenate(found)
            left, right = self.left[r], self.right[r]
            if left == right:
                at = np.sort(at)
            partner = following[at]
            valid = alive[at] & (symbol[at] == left) & (partner >= 0)
            at, partner = at[valid], partner[valid]
            valid = symbol[partner] == right
            at, partner = at[valid], partner[valid]
            if left == right and len(at) > 1:
                chained = np.concatenate(([False], partner[:-1] == at[1:]))
                head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                keep = (np.arange(len(at)) - head) % 2 == 0
                at, partner = at[keep], partner[keep]
            if not len(at):
                continue
            symbol[at] = self.merged[r]
            alive[partner] = False
            beyond = following[partner]
            following[at] = beyond
            inner = beyond >= 0
            preceding[beyond[inner]] = at[inner]
            # A pair is noted once: a position before another merged one is in the first part.
            ahead = preceding[at]
            note(np.concatenate([at[inner], ahead[(ahead >= 0) & (symbol[ahead] != self.merged[r])]]))
            doubled = ahead[(ahead >= 0) & (symbol[ahead] == self.merged[r])]
            if len(doubled):
                note(np.setdiff1d(doubled, at[inner]))
        sums = np.zeros(n + 1, np.int64)
        np.cumsum(alive, out=sums[1:])
        return symbol[alive], sums[piece_end] - sums[piece_end - lengths]

    def special_bounds(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """``bounds`` with cuts around special strings; the old part of each part; ids by start."""
        found: dict[int, int] = {}
        raw = flat.tobytes()
        for text, number in self.special.items():
            token = text.encode()
            at = raw.find(token)
            while at >= 0:
                part = int(np.searchsorted(bounds, at, "right")) - 1
                if at + len(token) <= bounds[part + 1]:
                    found[at] = number
                    at = raw.find(token, at + len(token))
                else:
                    at = raw.find(token, at + 1)
        if not found:
            return bounds, np.arange(len(bounds) - 1), found
        length = {i: len(t.encode()) for t, i in self.special.items()}
        # A text may be empty, so its bound is kept however often the position occurs.
        cuts = np.array([x for at, i in found.items() for x in (at, at + length[i])], np.int64)
        cuts = np.setdiff1d(cuts, bounds)
        parts = np.sort(np.concatenate([bounds, cuts]), kind="stable")
        old = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(cuts, bounds)) + 1)
        return parts, old, found


class PieceTable:
    """The ids of the pieces a worker has met, by hash."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.index = HashIndex(16)
        self.ids = Ragged(np.int32)

    def rows(self, flat: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each piece, after merging those that are new."""
        found = self.index.find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            pick = new[first]
            base = self.index.size
            ids, lengths = self.encode(flat, starts[pick], ends[pick])
            self.index.add(keys[pick])
            self.ids.append(ids, lengths)
            found[new] = base + back
        return found


@lru_cache(4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(4)
def _table(path: str) -> PieceTable:
    return PieceTable(load(path).encode)


def encode_texts(column: pa.ChunkedArray, model: ByteBpe, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, and the number of ids of each text."""
    flat, offsets = flat_bytes(column)
    bounds, owner = cut_parts(flat, offsets)
    bounds, part, special = model.special_bounds(flat, bounds)
    owner = owner[part]
    pieces = []
    for first, last in chunks(bounds):
        low, high = int(bounds[first]), int(bounds[last])
        view = flat[low:high]
        starts = byte_level(view, bounds[first : last + 1] - low)
        if special:
            starts = starts[~_inside(starts + low, special, model)]
        ends = np.append(starts[1:], high - low)
        pieces.append((starts + low, span_hashes(prefix_hashes(view), starts, ends)))
    starts = np.concatenate([p[0] for p in pieces]) if pieces else np.zeros(0, np.int64)
    keys = np.concatenate([p[1] for p in pieces]) if pieces else np.zeros(0, np.uint64)
    ends = np.append(starts[1:], len(flat)) if len(starts) else starts
    if table.index.size > KEPT_PIECES:
        table.clear()
    short = ends - starts <= KEPT_BYTES
    if special:
        short &= ~np.isin(starts, list(special))
    ids, counts = _lookup(flat, keys, starts, ends, short, special, model, table)
    rows = owner[np.searchsorted(bounds, starts, "right") - 1] if len(starts) else starts
    return ids, row_sums(counts, rows, len(offsets) - 1)


def _inside(starts: np.ndarray, special: dict[int, int], model: ByteBpe) -> np.ndarray:
    """Which starts lie in a special string, behind its first byte."""
    at = np.array(sorted(special), np.int64)
    size = np.array([len(model.bytes[special[x]]) for x in at.tolist()], np.int64)
    which = np.searchsorted(at, starts, "right") - 1
    behind = starts - at[which]
    return (which >= 0) & (behind > 0) & (behind < size[which])


def _lookup(flat, keys, starts, ends, short, special, model, table) -> tuple[np.ndarray, np.ndarray]:
    if short.all():
        return table.ids.take(table.rows(flat, keys, starts, ends))
    counts = np.zeros(len(starts), np.int64)
    mine = np.flatnonzero(short)
    ids_short, counts[mine] = table.ids.take(table.rows(flat, keys[mine], starts[mine], ends[mine]))
    other = np.flatnonzero(~short)
    values = []
    for k in other.tolist():
        number = special.get(int(starts[k]))
        got = np.array([number], np.int32) if number is not None else model.encode(flat, starts[k : k + 1], ends[k : k + 1])[0]
        values.append(got)
        counts[k] = len(got)
    to = np.cumsum(counts) - counts
    ids = np.empty(int(counts.sum()), np.int32)
    ids[spread(to[mine], counts[mine])] = ids_short
    ids[spread(to[other], counts[other])] = np.concatenate(values)
    return ids, counts


@lru_cache(4)
def _strings(path: str) -> tuple[Ragged, Ragged]:
    """The bytes of each id, and its decimal digits with a comma after them."""
    model = load(path)
    text, digits = Ragged(np.uint8), Ragged(np.uint8)
    for out, rows in ((text, model.bytes), (digits, [f"{i},".encode() for i in range(model.size)])):
        out.append(np.frombuffer(b"".join(rows), np.uint8), np.array([len(r) for r in rows], np.int64))
    return text, digits


def decode_ids(ids: np.ndarray, path: str) -> str:
    """The text of ``ids``; bytes that are no UTF-8 become the replacement character."""
    return _strings(path)[0].take(ids)[0].tobytes().decode("utf-8", "replace")


def _digests(strings: Ragged, ids: np.ndarray, edges: np.ndarray, as_text: bool) -> list[str]:
    """sha256 of each document's strings, made for about a million ids at a time."""
    out: list[str] = []
    for first, last in chunks(edges):
        base = int(edges[first])
        block, lengths = strings.take(ids[base : int(edges[last])])
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        raw = memoryview(block.tobytes())
        for a, b in zip(ends[edges[first:last] - base].tolist(), ends[edges[first + 1 : last + 1] - base].tolist(), strict=True):
            if not as_text:
                out.append(hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest())
                continue
            out.append(hashlib.sha256(bytes(raw[a:b]).decode("utf-8", "replace").encode()).hexdigest())
    return out


def bpe_ids(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text.

    A null or empty text has no ids. Rows are independent: repeated rows and repeated
    ids give repeated results, and other columns are ignored.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, counts = encode_texts(table["text"], load(path), _table(path))
        ends = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=ends[1:])
        return pa.table({"doc_id": table["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))})

    return map_blocks(_input(docs, id_column, text_column), run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; null ids give an empty text."""

    def run(table: pa.Table) -> pa.Table:
        texts = [decode_ids(np.array(x or [], np.int64), path) for x in table["ids"].to_pylist()]
        return pa.table({"doc_id": table["doc_id"], "text": pa.array(texts, pa.string())})

    return map_blocks(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode it again; see ``bpe_ids`` for the edge cases.

    Gives ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (the decoded text in UTF-8).
    """

    def run(table: pa.Table) -> pa.Table:
        ids, counts = encode_texts(table["text"], load(path), _table(path))
        edges = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=edges[1:])
        text, digits = _strings(path)
        return pa.table({
            "doc_id": table["doc_id"],
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(_digests(digits, ids, edges, False), pa.string()),
            "decoded_sha256": pa.array(_digests(text, ids, edges, True), pa.string()),
        })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_blocks(_input(docs, id_column, text_column), run, schema)


def _input(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def named(name: str, alias: str, kind: str) -> Column:
        return F.col(f"`{name}`").cast(kind).alias(alias)

    return docs.select(named(id_column, "doc_id", "long"), named(text_column, "text", "string"))

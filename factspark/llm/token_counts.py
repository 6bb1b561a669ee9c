"""Token counts for a piece vocabulary, with a shortcut for pieces that are one token.

No vocabulary entry holds a blank behind another character, so no merge crosses the
start of a run of blanks; characters that occur in no longer entry never merge at all.
Texts are therefore cut there, and each distinct piece is counted once per worker. Which
vocabulary entries encode alone as one token is established beforehand; pieces equal to
one of them count one, and only the rest are merged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import (
    HashIndex,
    chunks,
    cut_parts,
    flat_bytes,
    map_blocks,
    prefix_hashes,
    row_sums,
    span_hashes,
)
from factspark.llm.segments import blank_led

#: The character that the vocabulary writes for a blank.
BLANK_MARK = "▁"
#: Pieces longer than this are merged each time; the table keeps the shorter ones.
KEPT_BYTES = 64
#: Pieces in a worker's table before it starts anew; a bound on memory only.
KEPT_PIECES = 4_000_000


class PieceCounter:
    """Counts of the pieces a worker has met, by hash."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) for i in range(len(pieces))]
        entries = [p for p, s in zip(pieces, special, strict=True) if not s]
        for entry in entries:
            if BLANK_MARK in entry.lstrip(BLANK_MARK):
                raise ValueError(f"a vocabulary entry joins across a blank: {entry!r}")
        self.joinable = np.zeros(0x110000, bool)
        self.joinable[sorted({ord(c) for p in entries if len(p) > 1 for c in p})] = True
        self.joinable[0x20] = True
        # A character that joins nothing, put before a piece, keeps the blank that the
        # library adds to a text away from it; both cost a fixed number of tokens.
        self.guard = next(c for c in "\n\t\x01" if not self.joinable[ord(c)])
        self.guard_tokens = len(self.model.encode(self.guard))
        self.whole = self._proven_whole(entries)
        self.clear()

    def _proven_whole(self, entries: list[str]) -> list[bytes]:
        """The vocabulary strings that can stand as a piece and encode alone as one token."""
        texts = [p.replace(BLANK_MARK, " ") for p in entries]
        return [t.encode() for t, n in zip(texts, self.merge(texts).tolist(), strict=True) if n == 1]

    def merge(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text as it stands, by the library's merges."""
        got = self.model.encode([self.guard + t for t in texts], num_threads=1)
        return np.array([len(x) for x in got], np.int64) - self.guard_tokens

    def clear(self) -> None:
        lengths = np.array([len(x) for x in self.whole], np.int64)
        flat = np.frombuffer(b"".join(self.whole), np.uint8)
        ends = np.cumsum(lengths)
        self.index = HashIndex(17)
        self.index.add(span_hashes(prefix_hashes(flat), ends - lengths, ends))
        self.counts = np.ones(1 << 17, np.int64)

    def count(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the pieces of ``flat`` and the number of tokens of each."""
        if self.index.size > KEPT_PIECES:
            self.clear()
        all_starts, all_counts = [], []
        for first, last in chunks(bounds):
            low, high = int(bounds[first]), int(bounds[last])
            view = flat[low:high]
            starts = blank_led(view, bounds[first : last + 1] - low, self.joinable)
            ends = np.append(starts[1:], high - low)
            all_starts.append(starts + low)
            all_counts.append(self._look_up(view, starts, ends))
        if not all_starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(all_starts), np.concatenate(all_counts)

    def _look_up(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys = span_hashes(prefix_hashes(flat), starts, ends)
        found = self.index.find(keys).astype(np.int64)
        long = ends - starts > KEPT_BYTES
        new = np.flatnonzero((found < 0) & ~long)
        if len(new):
            _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            pick = new[first]
            base = self.index.size
            self.index.add(keys[pick])
            while self.index.size > len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.counts[base : self.index.size] = self.merge(_texts(flat, starts[pick], ends[pick]))
            found[new] = base + back
        counts = self.counts[found]
        rest = np.flatnonzero(long)
        if len(rest):
            counts[rest] = self.merge(_texts(flat, starts[rest], ends[rest]))
        return counts


def _texts(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = flat.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


@lru_cache(2)
def load(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_texts(column: pa.ChunkedArray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    n_bytes = np.diff(flat_bytes(column)[1])
    filled = pc.fill_null(column, "")
    led = pc.binary_join_element_wise(pc.if_else(pc.equal(filled, ""), "", " "), pc.replace_substring(filled, BLANK_MARK, " "), "")
    flat, offsets = flat_bytes(led)
    bounds, owner = cut_parts(flat, offsets)
    starts, counts = load(path).count(flat, bounds)
    rows = owner[np.searchsorted(bounds, starts, "right") - 1] if len(starts) else starts
    return n_bytes, row_sums(counts, rows, len(n_bytes))


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    A null text counts as empty: no bytes, no tokens, not over the limit. Rows are
    independent, so repeated rows give repeated results; other columns are ignored.
    """

    def run(table: pa.Table) -> pa.Table:
        n_bytes, n_tokens = count_texts(table["text"], path)
        return pa.table({
            "doc_id": table["doc_id"],
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "over_limit": pa.array(n_tokens > limit, pa.bool_()),
        })

    def named(name: str, alias: str, kind: str) -> Column:
        return F.col(f"`{name}`").cast(kind).alias(alias)

    source = docs.select(named(id_column, "doc_id", "long"), named(text_column, "text", "string"))
    return map_blocks(source, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Language identification by unigram models that sum over all segmentations.

Words are written with pieces of a fixed public vocabulary. Each language has its own
probability for each piece, learned by expectation maximisation; the probability of a
word is the sum over all ways to write it, by the forward algorithm. Words are scored
once per worker and looked up by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import HashIndex, chunks, flat_bytes, gather, map_blocks, prefix_hashes, prepare, span_hashes
from factspark.llm.components import stored
from factspark.llm.segments import runs_of

#: Labelled documents to learn from, about; they are chosen by a hash of their id.
TRAIN_DOCS = 20_000
#: Rounds of expectation maximisation, and what each piece is counted extra.
ROUNDS = 3
EXTRA = 0.01
#: The probability of a byte that no piece covers.
FLOOR = 1e-6
#: Words of up to so many bytes are summed as they are; the products of longer ones are
#: scaled at each byte, as they would vanish.
WORD_BYTES = 40
KEPT_WORDS = 1_000_000
#: Bytes of long words that are summed side by side.
_LONG_AT_ONCE = 1 << 18
_WORDS_AT_ONCE = 1 << 14

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray
    #: Probability of each piece (and of none, in the last row) in each language.
    pieces: np.ndarray


@lru_cache(2)
def vocabulary(path: str) -> tuple[HashIndex, int, int]:
    """An index of the pieces that hold only letters (a blank in front marks a word's start),
    their number, and the longest one's bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = (model.id_to_piece(i).replace("▁", " ").lower() for i in range(model.vocab_size()))
    pieces = sorted({t for t in texts if t.strip().isalpha() and t == t.rstrip()})
    raw = [t.encode() for t in pieces]
    sizes = np.array([len(r) for r in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(sizes)
    index = HashIndex(16)
    index.add(span_hashes(prefix_hashes(flat), ends - sizes, ends))
    return index, len(raw), int(sizes.max())


def word_spans(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters; any byte of another script counts as a letter."""
    return runs_of(_INSIDE[flat], bounds)


def piece_table(words: list[bytes], path: str) -> np.ndarray:
    """For words of one length: the piece that ends at each byte with each length, or none.

    Row w, byte t, length m - 1; a blank stands before each word.
    """
    index, none, longest = vocabulary(path)
    size = len(words[0]) + 1
    flat = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    sums = prefix_hashes(flat)
    base = np.arange(len(words))[:, None] * size
    table = np.full((len(words), size + 1, min(longest, size)), none, np.int32)
    for m in range(1, min(longest, size) + 1):
        ends = base + np.arange(m, size + 1)
        found = index.find(span_hashes(sums, (ends - m).ravel(), ends.ravel())).reshape(ends.shape)
        table[:, m:, m - 1] = np.where(found < 0, none, found)
    return table


def forward(table: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """The summed probability of all ways to write the first t bytes: word, t, language."""
    n, size, longest = table.shape
    out = np.zeros((n, size, pieces.shape[1]))
    out[:, 0] = 1
    for t in range(1, size):
        out[:, t] = out[:, t - 1] * FLOOR
        for m in range(1, min(longest, t) + 1):
            out[:, t] += out[:, t - m] * pieces[table[:, t, m - 1]]
    return out


def expected_counts(table: np.ndarray, pieces: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that occur ``counts`` times per language."""
    n, size, longest = table.shape
    ahead = forward(table, pieces)
    behind = np.zeros_like(ahead)
    behind[:, -1] = counts / ahead[:, -1]
    out = np.zeros_like(pieces)
    for t in range(size - 1, 0, -1):
        behind[:, t - 1] += behind[:, t] * FLOOR
        for m in range(1, min(longest, t) + 1):
            piece = table[:, t, m - 1]
            weight = pieces[piece]
            share = ahead[:, t - m] * weight * behind[:, t]
            for k in range(pieces.shape[1]):
                out[:, k] += np.bincount(piece, share[:, k], len(out))
            behind[:, t - m] += weight * behind[:, t]
    out[-1] = 0
    return out


def _pieces_at(index: HashIndex, sums: np.ndarray, places: np.ndarray, lengths: np.ndarray, none: int, ending: bool) -> np.ndarray:
    """The piece of each length (rows) that ends at each place, or that starts there; ``none`` where there is none."""
    starts, ends = (places, places + lengths[:, None]) if not ending else (places - lengths[:, None], places)
    starts, ends = np.broadcast_arrays(starts, ends)
    found = index.find(span_hashes(sums, starts.ravel(), ends.ravel())).reshape(starts.shape)
    return np.where(found < 0, none, found)


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes of all words with a blank before each, and where each begins."""
    flat = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    return prefix_hashes(flat), np.cumsum(sizes) - sizes


def long_word_scores(words: list[bytes], pieces: np.ndarray, path: str) -> np.ndarray:
    """The logarithms of the sums that ``forward`` ends with, for words of any length, the longest first.

    Of each sum only its ratio to the last ``longest`` ones is kept, and the logarithm of
    what was divided out.
    """
    index, none, longest = vocabulary(path)
    sums, base = _joined(words)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    logs = np.zeros((len(words), pieces.shape[1]))
    ratios = np.zeros((longest, *logs.shape))
    ratios[0] = 1
    for t in range(1, int(sizes[0]) + 1):
        n = int(np.searchsorted(-sizes, -t, "right"))
        m = np.arange(1, min(longest, t) + 1)
        found = _pieces_at(index, sums, base[:n] + t, m, none, True)
        new = ratios[0, :n] * FLOOR + (pieces[found] * ratios[: len(m), :n]).sum(0)
        logs[:n] += np.log(new)
        ratios[1:, :n] = np.minimum(ratios[:-1, :n] / new, 1e300)
        ratios[0, :n] = 1
    return logs


def long_word_counts(words: list[bytes], pieces: np.ndarray, counts: np.ndarray, path: str) -> np.ndarray:
    """``expected_counts`` of words of one length, whatever it is."""
    index, none, longest = vocabulary(path)
    sums, base = _joined(words)
    size, shape = len(words[0]) + 1, (len(words), pieces.shape[1])
    ahead = np.zeros((size + 1, *shape))
    behind = np.zeros((size + 1, *shape))
    ratios = np.zeros((longest, *shape))
    ratios[0] = 1
    for t in range(1, size + 1):
        m = np.arange(1, min(longest, t) + 1)
        found = _pieces_at(index, sums, base + t, m, none, True)
        new = ratios[0] * FLOOR + (pieces[found] * ratios[: len(m)]).sum(0)
        ahead[t] = ahead[t - 1] + np.log(new)
        ratios[1:] = np.minimum(ratios[:-1] / new, 1e300)
        ratios[0] = 1
    out = np.zeros_like(pieces)
    ratios[:] = 0
    ratios[0] = 1
    for t in range(size - 1, -1, -1):
        m = np.arange(1, min(longest, size - t) + 1)
        found = _pieces_at(index, sums, base + t, m, none, False)
        weights = pieces[found]
        # Of all segmentations, the share in which the piece stands here.
        share = weights * np.exp(ahead[t] + behind[t + m] - ahead[size]) * counts
        for k in range(pieces.shape[1]):
            out[:, k] += np.bincount(found.ravel(), share[:, :, k].ravel(), len(out))
        new = ratios[0] * FLOOR + (weights * ratios[: len(m)]).sum(0)
        behind[t] = behind[t + 1] + np.log(new)
        ratios[1:] = np.minimum(ratios[:-1] / new, 1e300)
        ratios[0] = 1
    out[-1] = 0
    return out


def _by_size(words: list[bytes]) -> Iterator[np.ndarray]:
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = _WORDS_AT_ONCE if size <= WORD_BYTES else max(1, _LONG_AT_ONCE // int(size + 1))
        for first in range(0, len(rows), step):
            yield rows[first : first + step]


def summed_counts(words: list[bytes], pieces: np.ndarray, counts: np.ndarray, path: str) -> np.ndarray:
    """How often each piece is expected in words that occur ``counts`` times per language."""
    out = np.zeros_like(pieces)
    for part in _by_size(words):
        some = [words[i] for i in part.tolist()]
        if len(some[0]) > WORD_BYTES:
            out += long_word_counts(some, pieces, counts[part], path)
        else:
            out += expected_counts(piece_table(some, path), pieces, counts[part])
    return out


def word_scores(words: list[bytes], model: Model, path: str) -> np.ndarray:
    """The logarithm of each word's probability in each language."""
    out = np.zeros((len(words), len(model.languages)))
    short = [w if len(w) <= WORD_BYTES else b"" for w in words]
    for rows in _by_size(short):
        if short[rows[0]]:
            table = piece_table([words[i] for i in rows.tolist()], path)
            out[rows] = np.log(np.maximum(forward(table, model.pieces)[:, -1], 1e-300))
    long = sorted((i for i, w in enumerate(words) if len(w) > WORD_BYTES), key=lambda i: -len(words[i]))
    while long:
        part = long[: max(1, _LONG_AT_ONCE // len(words[long[0]]))]
        long = long[len(part) :]
        out[part] = long_word_scores([words[i] for i in part], model.pieces, path)
    return out


def _lowered(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return flat_bytes(pc.utf8_lower(pc.fill_null(column, "")))


def is_held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id, as text, leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _training_words(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` of labelled documents."""

    def count(table: pa.Table) -> pa.Table:
        flat, offsets = _lowered(table["text"])
        label = table["lang"].combine_chunks().dictionary_encode()
        if isinstance(label, pa.ChunkedArray):
            label = label.combine_chunks()
        starts, ends = word_spans(flat, offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        language = np.asarray(label.indices)[owner]
        keys = span_hashes(prefix_hashes(flat), starts, ends)
        order = np.lexsort((keys, language))
        keys, language = keys[order], language[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (language[1:] != language[:-1])
        at = np.flatnonzero(new)
        raw = flat.tobytes()
        first = order[at]
        return pa.table({
            "lang": label.dictionary.take(pa.array(language[at])),
            "word": pa.array([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.binary()),
            "n": pa.array(np.diff(np.append(at, len(keys))), pa.int64()),
        })

    counted = map_blocks(docs.select("text", "lang"), count, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, path: str, rounds: int = ROUNDS, train_docs: int = TRAIN_DOCS) -> Model | None:
    """A model from ``doc_id, text, lang``; None if there is nothing to learn from.

    What comes to the driver is one number per piece and language, and the number of
    documents of each language.
    """
    prepare(docs.sparkSession)
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    total = labelled.select("lang").count()
    share = min(1.0, train_docs / max(total, 1))
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    prior = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = stored(_training_words(sample), "language-words")
    languages = sorted(prior, key=lambda x: x.encode())
    if not languages:
        return None
    place = {x: k for k, x in enumerate(languages)}
    n_pieces = vocabulary(path)[1]
    pieces = np.full((n_pieces + 1, len(languages)), 1.0 / n_pieces)
    pieces[-1] = 0
    for _ in range(rounds):
        current = pieces

        def expect(batches: Iterator[pa.RecordBatch], current: np.ndarray = current) -> Iterator[pa.RecordBatch]:
            sums = np.zeros_like(current)
            for table in gather(batches, 4 << 20):
                found = table["word"].combine_chunks().dictionary_encode()
                found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
                rows = found.dictionary.to_pylist()
                counts = np.zeros((len(rows), len(languages)))
                column = np.array([place[x] for x in table["lang"].to_pylist()], np.int64)
                counts[np.asarray(found.indices), column] = np.asarray(table["n"])
                sums += summed_counts(rows, current, counts, path)
            piece, language = np.nonzero(sums)
            yield pa.record_batch({
                "piece": pa.array(piece.astype(np.int32)), "language": pa.array(language.astype(np.int32)), "n": pa.array(sums[piece, language])
            })

        expected = words.mapInArrow(expect, "piece int, language int, n double")
        sums = np.full_like(pieces, EXTRA)
        for r in expected.groupBy("piece", "language").agg(F.sum("n").alias("n")).toLocalIterator():
            sums[r["piece"], r["language"]] += r["n"]
        sums[-1] = 0
        pieces = sums / sums.sum(0)
    counts = np.array([prior[x] for x in languages], float)
    return Model(languages, np.log(counts / counts.sum()), pieces)


class _Scores:
    """Scores of the words a worker has met, by hash."""

    def __init__(self, model: Model, path: str) -> None:
        self.model, self.path = model, path
        self.clear()

    def clear(self) -> None:
        self.index = HashIndex(16)
        self.scores = np.zeros((1 << 15, len(self.model.languages)))
        self.letters = np.zeros(1 << 15, bool)

    def rows(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys = span_hashes(prefix_hashes(flat), starts, ends)
        found = self.index.find(keys).astype(np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            pick = new[first]
            base = self.index.size
            self.index.add(keys[pick])
            while self.index.size > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            raw = flat.tobytes()
            words = [raw[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)]
            self.scores[base : self.index.size] = word_scores(words, self.model, self.path)
            self.letters[base : self.index.size] = [_has_letter(w) for w in words]
            found[new] = base + back
        return found

    def texts(self, column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores of each text, and whether it holds a letter."""
        flat, offsets = _lowered(column)
        sums = np.zeros((len(offsets) - 1, len(self.model.languages)))
        letters = np.zeros(len(offsets) - 1, bool)
        for first, last in chunks(offsets):
            if self.index.size > KEPT_WORDS:
                self.clear()
            low = int(offsets[first])
            bounds = offsets[first : last + 1] - low
            view = flat[low : int(offsets[last])]
            starts, ends = word_spans(view, bounds)
            if not len(starts):
                continue
            rows = self.rows(view, starts, ends)
            edges = np.searchsorted(starts, bounds)
            some = np.flatnonzero(np.diff(edges)) + first
            sums[some] = np.add.reduceat(self.scores[rows], edges[some - first], axis=0)
            letters[some] = np.logical_or.reduceat(self.letters[rows], edges[some - first])
        return sums, letters


def _has_letter(word: bytes) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word.decode("utf-8", "ignore"))


_loaded: dict[str, _Scores] = {}


def _scores(token: str, model: Model, path: str) -> _Scores:
    """The worker's table for the model with this name; an older model's is dropped."""
    if token not in _loaded:
        _loaded.clear()
        _loaded[token] = _Scores(model, path)
    return _loaded[token]


def predict(docs: DataFrame, model: Model | None, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` from the text alone.

    ``und`` with score 0 for a text that is null or has no letter, and for any text if
    nothing was learned. The score is the share of the best language among all, each
    weighed by its probability of the text; ties go to the smaller name.
    """
    token = str(hash(model.pieces.tobytes())) if model else ""

    def run(table: pa.Table) -> pa.Table:
        if model is None:
            best, score = ["und"] * len(table), np.zeros(len(table))
        else:
            sums, letters = _scores(token, model, path).texts(table["text"])
            sums = sums + model.prior
            top = sums.argmax(1)
            score = np.where(letters, 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1), 0.0)
            best = [model.languages[k] if found else "und" for k, found in zip(top.tolist(), letters.tolist(), strict=True)]
        return pa.table({"doc_id": table["doc_id"], "lang_pred": pa.array(best, pa.string()), "score": pa.array(score)})

    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return map_blocks(source, run, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document of ``doc_id, text, lang``.

    The model learns from labelled documents whose crc32 of the id is not 2 modulo 4.
    Repeated rows give repeated results; a null id is never held out; an empty table
    gives no rows; other columns are ignored.
    """
    held_out = is_held_out(F.col("doc_id"), 4, 2)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(named.filter(~held_out), path, train_docs=train_docs)
    return predict(named, model, path).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

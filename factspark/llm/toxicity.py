"""Toxicity by boosted trees over a few dense features of a text.

A lexicon of word beginnings and whole words is learned from labelled documents: those
that stand in toxic texts far more often than in others. What a text shows of it (how
dense, how strong, how close to a word for "you", how disguised) is measured together with
its capitals and punctuation. Trees are boosted on these features, each row measured by a
lexicon that has not seen it, and rows that neither has seen turn their margin into a
probability by isotonic regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.llm.blocks import chunks, flat_bytes, map_blocks, mix, prefix_hashes, span_hashes, spread
from factspark.llm.components import stored
from factspark.llm.langid import is_held_out
from factspark.llm.segments import runs_of, words

#: Labelled rows to learn from, about; they are chosen by a hash of their id.
TRAIN_ROWS = 30_000
#: Parts of these rows, and how many of them the lexicon and the trees learn from; the rest calibrates.
PARTS, LEARN_PARTS = 16, 12
TREES = 20
DEPTH = 3
THRESHOLD = 0.7
#: Bytes of the beginnings of words that the lexicon may hold, besides whole words.
STEMS = range(3, 11)
#: Entries of the lexicon, toxic documents an entry must stand in, and how many standard
#: errors its log odds must lie above even.
LEXICON = 4000
SUPPORT = 4
CERTAINTY = 3.0
#: Words to either side of a lexicon word in which a word for "you" counts as near.
NEAR = 5
#: Words in which lexicon words are counted together.
BURST = 50

# Words for "you" and "your" in English, German, French and Spanish.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "yourselves", "u", "ur", "du", "dich", "dir", "dein", "deine", "deinen", "deinem", "deiner",
    "ihr", "euch", "euer", "eure", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "tuyo", "usted",
    "ustedes", "vosotros", "os",
)
# Signs that stand for letters in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t"}

FEATURES = (
    "log_words", "hit_density", "log_hits", "hit_kinds", "strongest", "weight_density", "burst", "near_you", "you_density",
    "disguised_hits", "obfuscation", "stretched", "capitals", "shouted", "exclamations", "questions", "marks", "symbols",
)

_WHOLE = np.uint64(0x9E3779B97F4A7C15)


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_LETTER = _flags(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
_CAPITAL = _flags(bytes(range(0x41, 0x5B)))
_SMALL = _flags(bytes(range(0x61, 0x7B)))
_DIGIT = _flags(b"0123456789")
_SYMBOL = _flags(b"#*$%&|<>@^~")
_MARK = _flags(b"!\"'(),-./:;?[]_`{}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
for _sign, _letter in DISGUISES.items():
    _FOLD[ord(_sign)] = ord(_letter)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _count(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[edges])


def _whole_key(keys: np.ndarray) -> np.ndarray:
    """A word's key as a whole, apart from the key of words that begin with it."""
    return mix(keys ^ _WHOLE)


def entry_keys(entries: list[bytes]) -> np.ndarray:
    """The keys of lexicon entries; a blank at the end marks a whole word."""
    out = np.zeros(len(entries), np.uint64)
    for k, entry in enumerate(entries):
        flat = np.frombuffer(entry.rstrip(b" "), np.uint8)
        key = span_hashes(prefix_hashes(flat), np.array([0]), np.array([len(flat)]))
        out[k] = (_whole_key(key) if entry.endswith(b" ") else key)[0]
    return out


def _begins(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number below 2 ** 16 from the first bytes of each word."""
    first, second, third = (flat[np.minimum(starts + i, len(flat) - 1)].astype(np.int64) for i in range(3))
    return (first * 961 + second * 31 + third) & 0xFFFF


class Entries:
    """Weights of beginnings and whole words by key, made for looking up whole arrays."""

    def __init__(self, entries: tuple[bytes, ...], weights: tuple[float, ...]) -> None:
        keys = entry_keys(list(entries))
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], np.array(weights, np.float64)[order]
        #: Which words can be in here at all, by their first bytes; those of fewer always can.
        self.possible = np.zeros(1 << 16, bool)
        long = [np.frombuffer(e[:3], np.uint8) for e in entries if len(e.rstrip(b" ")) >= 3]
        if long:
            self.possible[_begins(np.concatenate(long), np.arange(0, 3 * len(long), 3))] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The weight of each key, 0 where there is none."""
        if not len(self.keys) or not len(keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)

    def strongest(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The largest weight of any entry that each word of ``flat`` begins with or is."""
        out = np.zeros(len(starts))
        if not len(self.keys) or not len(starts):
            return out
        some = np.flatnonzero(self.possible[_begins(flat, starts)] | ((ends - starts < 3) & (ends > starts)))
        sums = prefix_hashes(flat)
        keys = span_hashes(sums, starts[some], ends[some])
        _, first, back = np.unique(keys, return_index=True, return_inverse=True)
        a, b = starts[some][first], ends[some][first]
        best = self.find(_whole_key(keys[first]))
        for size in STEMS:
            long = np.flatnonzero(b - a >= size)
            best[long] = np.maximum(best[long], self.find(span_hashes(sums, a[long], a[long] + size)))
        out[some] = best[back]
        return out


@dataclass(frozen=True)
class Lexicon:
    entries: tuple[bytes, ...]
    weights: tuple[float, ...]

    def plain(self) -> Entries:
        return Entries(self.entries, self.weights)

    def squeezed(self) -> Entries:
        """With each run of one letter as one letter; what becomes too short to tell words by is left out."""
        kept: dict[bytes, float] = {}
        for entry, weight in zip(self.entries, self.weights, strict=True):
            flat = np.frombuffer(entry, np.uint8)
            new = np.ones(len(flat), bool)
            new[1:] = flat[1:] != flat[:-1]
            short = flat[new].tobytes()
            if len(short) >= STEMS[0]:
                kept[short] = max(weight, kept.get(short, 0.0))
        return Entries(tuple(kept), tuple(kept.values()))


def _lowered(flat: np.ndarray) -> np.ndarray:
    return np.where(_CAPITAL[flat], flat + 32, flat).astype(np.uint8)


def _disguised(
    flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: Entries
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words between white space: which mix letters with signs inside, which stretch a
    letter, and which of these are lexicon words once signs become letters or go and
    repeats are one. Signs other than digits at either end do not count."""
    letter = _LETTER[flat]
    letters = np.concatenate(([0], np.cumsum(letter)))
    place, core = np.arange(len(flat)), letter | _DIGIT[flat]
    forward = np.minimum.accumulate(np.where(core, place, len(flat))[::-1])[::-1] if len(flat) else place
    backward = np.maximum.accumulate(np.where(core, place, -1)) if len(flat) else place
    some = letters[ends] > letters[starts]
    first = np.where(some, forward[np.minimum(starts, max(len(flat) - 1, 0))], starts)
    last = np.where(some, backward[np.maximum(ends - 1, 0)] + 1, starts)
    inside = (letters[last] - letters[first]) < (last - first)
    same = np.zeros(len(flat), np.int64)
    low = _lowered(flat)
    same[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[2:]
    runs = np.concatenate(([0], np.cumsum(same)))
    stretched = (last - first > 2) & (runs[last] > runs[np.minimum(first + 2, last)])
    hits = np.zeros(len(starts), bool)
    odd = np.flatnonzero(inside | stretched)
    sizes = last[odd] - first[odd]
    word = np.repeat(np.arange(len(odd)), sizes)
    at = spread(first[odd], sizes)
    for text in (_FOLD[flat[at]], low[at]):
        # With signs read as letters, and with signs left out; a letter like the one before it goes.
        held = np.flatnonzero(_LETTER[text])
        text, owner = text[held], word[held]
        new = np.ones(len(held), bool)
        new[1:] = (text[1:] != text[:-1]) | (owner[1:] != owner[:-1])
        text, owner = text[new], owner[new]
        bounds = np.searchsorted(owner, np.arange(len(odd) + 1))
        hits[odd] |= lexicon.strongest(text, bounds[:-1], bounds[1:]) > 0
    return inside, stretched, hits


_YOU = np.sort(entry_keys([w.encode() for w in SECOND_PERSON]))


def block_features(flat: np.ndarray, bounds: np.ndarray, plain: Entries, squeezed: Entries) -> np.ndarray:
    """FEATURES of each text of a block, as rows; all zero for a text without words."""
    n = len(bounds) - 1
    low = _lowered(flat)
    sums = prefix_hashes(low)
    starts, ends = runs_of(_LETTER[flat], bounds)
    edges = np.searchsorted(starts, bounds)
    n_words = np.diff(edges)
    owner = np.repeat(np.arange(n), n_words)
    weight = plain.strongest(low, starts, ends)
    hit = weight > 0
    keys = span_hashes(sums, starts, ends)
    at = np.minimum(np.searchsorted(_YOU, keys), len(_YOU) - 1)
    you = _YOU[at] == keys
    hits = np.bincount(owner[hit], minlength=n)
    pairs = np.unique(mix(keys[hit] + _WHOLE * owner[hit].astype(np.uint64)), return_index=True)[1]
    kinds = np.bincount(owner[hit][pairs], minlength=n)
    strongest = np.zeros(n)
    np.maximum.at(strongest, owner[hit], weight[hit])
    so_far = np.concatenate(([0], np.cumsum(hit)))
    place = np.flatnonzero(hit)
    burst = np.zeros(n)
    if len(place):
        end = np.minimum(place + BURST, edges[1:][owner[place]])
        np.maximum.at(burst, owner[place], (so_far[end] - so_far[place]).astype(float))
    yous = np.concatenate(([0], np.cumsum(you)))
    left = np.maximum(place - NEAR, edges[:-1][owner[place]])
    right = np.minimum(place + NEAR + 1, edges[1:][owner[place]])
    near = np.bincount(owner[place][yous[right] > yous[left]], minlength=n)
    token_starts, token_ends = words(flat, bounds)
    token_edges = np.searchsorted(token_starts, bounds)
    n_tokens = np.diff(token_edges)
    inside, stretched, disguised = _disguised(flat, token_starts, token_ends, squeezed)
    token_owner = np.repeat(np.arange(n), n_tokens)
    letters = _count(_LETTER[flat], bounds)
    capital = np.concatenate(([0], np.cumsum(_CAPITAL[flat])))
    small = np.concatenate(([0], np.cumsum(_SMALL[flat])))
    shouted = (capital[ends] - capital[starts] >= 3) & (small[ends] == small[starts])
    out = np.stack([
        np.log1p(n_tokens),
        _share(hits, n_words),
        np.log1p(hits),
        np.log1p(kinds),
        strongest,
        _share(np.bincount(owner, weight, n), n_words),
        burst,
        _share(near, hits),
        _share(np.bincount(owner[you], minlength=n), n_words),
        _share(np.bincount(token_owner[disguised], minlength=n), n_tokens),
        _share(np.bincount(token_owner[inside], minlength=n), n_tokens),
        _share(np.bincount(token_owner[stretched], minlength=n), n_tokens),
        _share(_count(_CAPITAL[flat], bounds), letters),
        _share(np.bincount(owner[shouted], minlength=n), n_words),
        _share(_count(flat == 0x21, bounds), n_tokens),
        _share(_count(flat == 0x3F, bounds), n_tokens),
        _share(_count(_MARK[flat], bounds), n_tokens),
        _share(_count(_SYMBOL[flat], bounds), n_tokens),
    ], axis=1).astype(np.float64)
    out[n_tokens == 0] = 0
    return out


def features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id`` and FEATURES of ``doc_id, text``; a null text counts as empty."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        entries = lexicon.plain(), lexicon.squeezed()
        rows = [
            block_features(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], *entries) for a, b in chunks(offsets)
        ]
        values = np.concatenate(rows)
        return pa.table({"doc_id": table["doc_id"]} | {name: pa.array(values[:, k]) for k, name in enumerate(FEATURES)})

    schema = ", ".join(["doc_id long", *(f"{name} double" for name in FEATURES)])
    return map_blocks(docs.select("doc_id", "text"), run, schema)


def _entries(low: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, starts, ends and texts of all whole words and then of all beginnings of each size, each once a text."""
    starts, ends = runs_of(_LETTER[low], bounds)
    sums, owner = prefix_hashes(low), np.searchsorted(bounds, starts, "right") - 1
    for size in (0, *STEMS):
        long = np.flatnonzero(ends - starts >= max(size, 1))
        a, doc = starts[long], owner[long]
        b = a + size if size else ends[long]
        keys = span_hashes(sums, a, b)
        keys = keys if size else _whole_key(keys)
        order = np.lexsort((doc, keys))
        k, d = keys[order], doc[order]
        once = np.ones(len(k), bool)
        once[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        order = order[once]
        yield keys[order], a[order], b[order], doc[order]


#: Columns of ``entry_counts``: label and fold of the texts counted.
_COUNTS = ("clean0", "toxic0", "clean1", "toxic1")


def entry_counts(train: DataFrame) -> DataFrame:
    """``key`` and _COUNTS: in how many texts of each label and fold each entry stands."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        low = _lowered(flat)
        kind = np.asarray(table["label"]).astype(np.int64) + 2 * np.asarray(table["fold"]).astype(np.int64)
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros((0, 4), np.int64)]
        for first, last in chunks(offsets):
            base = int(offsets[first])
            for key, _, _, doc in _entries(low[base : int(offsets[last])], offsets[first : last + 1] - base):
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                edges = np.flatnonzero(new)
                if len(edges):
                    keys.append(key[edges])
                    mine = kind[first + doc]
                    counts.append(np.stack([np.add.reduceat((mine == c).astype(np.int64), edges) for c in range(4)], 1))
        found, values = np.concatenate(keys), np.concatenate(counts)
        return pa.table({"key": pa.array(found.view(np.int64))} | {name: pa.array(values[:, c]) for c, name in enumerate(_COUNTS)})

    counted = map_blocks(train.select("text", "label", "fold"), run, "key long, " + ", ".join(f"{c} long" for c in _COUNTS))
    return counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def entry_texts(train: DataFrame, keys: np.ndarray) -> dict[int, bytes]:
    """What the entries with these keys are; a blank at the end marks a whole word."""
    known = np.sort(keys)

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        low = _lowered(flat)
        found: dict[int, bytes] = {}
        for first, last in chunks(offsets):
            base = int(offsets[first])
            view = low[base : int(offsets[last])]
            raw = view.tobytes()
            for k, (key, a, b, _) in enumerate(_entries(view, offsets[first : last + 1] - base)):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                for i in np.flatnonzero(known[at] == key).tolist():
                    found.setdefault(int(key[i]), raw[a[i] : b[i]] + (b"" if k else b" "))
        return pa.table({"key": pa.array(np.array(list(found), np.uint64).view(np.int64)), "entry": pa.array(list(found.values()), pa.binary())})

    if not len(known):
        return {}
    rows = map_blocks(train.select("text"), run, "key long, entry binary").groupBy("key").agg(F.min("entry").alias("entry")).collect()
    return {r["key"]: bytes(r["entry"]) for r in rows}


def learn_lexicons(train: DataFrame) -> list[Lexicon]:
    """Lexicons from ``text, label, fold`` (0 or 1): from fold 0, from fold 1, and from both.

    Each holds the entries that speak most clearly for label 1; an entry's weight is its
    log odds less one and a half standard errors. What comes to the driver is at most
    LEXICON entries for each.
    """
    totals = {(int(r["label"]), r["fold"]): r["n"] for r in train.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    often = stored(entry_counts(train).filter(F.col("toxic0") + F.col("toxic1") >= SUPPORT), "toxicity-entries")
    chosen = []
    for folds in ((0,), (1,), (0, 1)):
        toxic, clean = (sum(totals.get((label, f), 0) for f in folds) for label in (1, 0))
        a, b = (sum((F.col(f"{name}{f}") for f in folds), F.lit(0)) for name in ("toxic", "clean"))
        lead = F.log((a + 0.5) / (toxic - a + 0.5)) - F.log((b + 0.5) / (clean - b + 0.5))
        error = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        speaking = often.filter(a >= SUPPORT).select("key", (lead / error).alias("certainty"), (lead - 1.5 * error).alias("weight"))
        speaking = speaking.filter((F.col("certainty") >= CERTAINTY) & (F.col("weight") > 0))
        chosen.append(speaking.orderBy(F.col("certainty").desc(), "key").limit(LEXICON).collect() if toxic and clean else [])
    keys = np.array(sorted({r["key"] for rows in chosen for r in rows}), np.int64).view(np.uint64)
    texts = entry_texts(train.filter("label = 1"), keys)
    return [Lexicon(tuple(texts[r["key"]] for r in rows), tuple(float(r["weight"]) for r in rows)) for rows in chosen]


def _sketches(train: DataFrame) -> DataFrame:
    """Adds ``sketch``: the smallest hash of four neighbouring words, which near copies mostly share."""

    def run(table: pa.Table) -> pa.Table:
        flat, offsets = flat_bytes(table["text"])
        out = np.full(len(table), np.iinfo(np.uint64).max, np.uint64)
        for first, last in chunks(offsets):
            base = int(offsets[first])
            view, bounds = flat[base : int(offsets[last])], offsets[first : last + 1] - base
            starts, ends = words(view, bounds)
            owner = np.searchsorted(bounds, starts, "right") - 1
            keys = span_hashes(prefix_hashes(view), starts, ends)
            four = np.flatnonzero(owner[3:] == owner[:-3]) if len(keys) > 3 else np.zeros(0, np.int64)
            mixed = mix(sum(keys[four + i] * np.uint64(2 * i + 3) for i in range(4))) if len(four) else np.zeros(0, np.uint64)
            np.minimum.at(out, first + owner[four], mixed)
        return table.append_column("sketch", pa.array(out.view(np.int64)))

    return map_blocks(train.select("text", "label"), run, "text string, label double, sketch long")


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    prior: float
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None

    def score(self, measured: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and ``score``, the calibrated probability of label 1, from FEATURES."""
        if self.trees is None:
            return measured.select(*keep, F.lit(self.prior).alias("score"))
        found = margins(self.trees, measured, *keep)
        if self.calibration is None:
            return found.select(*keep, (1 / (1 + F.exp(-2 * F.col("margin")))).alias("score"))
        score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
        return self.calibration.transform(found).select(*keep, score.alias("score"))


def margins(trees: GBTClassificationModel, measured: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the trees' ``margin``, above 0 where label 1 is likelier."""
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measured)
    margin = vector_to_array("rawPrediction")[1]
    return trees.transform(vectors).select(*keep, margin.alias("margin"))


def learn(train: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 1) -> ToxicityModel:
    """A model from ``text, label`` (label 0.0 or 1.0).

    Of copies and near copies with the same label one counts. The rows fall into parts by
    a hash of their text: the trees learn from features of a lexicon that has not seen
    the row's fold, the isotonic regression from parts that neither has seen. A part with
    one label only leaves its step out: without trees the score is the share of label 1,
    with one row more of each label.
    """
    once = _sketches(train).withColumn("short", F.when(F.col("sketch") == -1, F.xxhash64("text")))
    once = once.groupBy("sketch", "short", "label").agg(F.min("text").alias("text"))
    once = once.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int"))
    once = once.select(F.monotonically_increasing_id().alias("doc_id"), "text", "label", "part", (F.col("part") % 2).alias("fold"))
    once = stored(once, "toxicity-training")
    counts = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    prior = (toxic + 1) / (toxic + clean + 2)
    seen, unseen = once.filter(F.col("part") < LEARN_PARTS), once.filter(F.col("part") >= LEARN_PARTS)
    from_first, from_second, lexicon = learn_lexicons(seen)

    def measured(rows: DataFrame, entries: Lexicon) -> DataFrame:
        return features(rows, entries).join(rows.select("doc_id", "label"), "doc_id")

    for_trees = measured(seen.filter("fold = 0"), from_second).unionByName(measured(seen.filter("fold = 1"), from_first))
    for_trees = stored(for_trees, "toxicity-features")
    if for_trees.select("label").distinct().count() < 2:
        return ToxicityModel(lexicon, prior, None, None)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(for_trees).select("label", "features")
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=3, seed=seed).fit(vectors)
    for_scale = stored(measured(unseen, lexicon), "toxicity-features")
    if for_scale.select("label").distinct().count() < 2:
        return ToxicityModel(lexicon, prior, boosted, None)
    regression = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score")
    return ToxicityModel(lexicon, prior, boosted, regression.fit(margins(boosted, for_scale, "label")))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    ``docs`` has an id and a text, ``labels`` has ``doc_id`` and a label of 0 or 1. The
    model learns from labels of documents whose crc32 of the id is not 1 modulo 3; a null
    id is not held out and never labelled. Null and empty texts have all features zero and
    get the score that follows. Repeated rows give repeated results; an empty table gives
    no rows; other columns are ignored.
    """
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    held_out = is_held_out(F.col("doc_id"), 3, 1)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label_column}`").cast("double").alias("label"))
    usable = usable.filter("label IN (0.0, 1.0)").filter(~held_out)
    share = min(1.0, train_rows / max(usable.count(), 1))
    usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    model = learn(named.filter("text IS NOT NULL").join(usable, "doc_id"))
    scored = model.score(features(named, model.lexicon), "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

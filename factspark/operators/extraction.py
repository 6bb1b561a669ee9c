"""Tagged facts from text, by dictionary and lexicon.

A language model's rules are replaced by rules on words, so the facts approximate
what such a model would give:

* a dictionary phrase gives ``LABEL:canonical`` (the words as written where the
  dictionary has no canonical form); matches do not overlap, the longest wins,
  then the leftmost;
* a place phrase gives ``ORIGIN:<words as written>``, unless it overlaps a match
  of the dictionary proper;
* an adjective right before a head word, or before another adjective and a head
  word, gives ``FEATURE:<head lemma>=<adjective>``;
* a subject (a subject word, or a dictionary match with a subject label), a copula
  among the next three words and an adjective among the two words after the copula
  give ``CHARACTER:<adjective>``.

How it runs: each word becomes one row that carries the few words after it. Lookups
are joins on the word or phrase, so nothing but words that start a rule leaves the
scan stage, and the only shuffle moves those hits to their document. A phrase of more
than ``PHRASE_WINDOW`` words is looked up in pieces, so that no dictionary widens the
rows of the corpus. Words that start nothing do not become rows where the first words of the
rules are few enough to be listed, or too many to broadcast: then a Bloom filter over them and
over the first two words of phrases stands for the list. A phrase of one word that no longer one
can cover is settled where it stands, and words of a document that give the same facts become one
row. Running maxima find the runs of other hits that overlap one another, and only within such
a run hits are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspark.functions.markup import html_to_text, without_markup
from factspark.functions.strings import feature_tag, let, sorted_set, tag
from factspark.operators.joins import fits_broadcast, lookup_join
from factspark.session import cut_lineage, literal_table

# ASCII stands first because it is tested first; the classes behind it hold it too.
TOKEN = r"[a-zA-Z0-9\p{L}\p{N}]+"

# A copula stands among the next COPULA_REACH words, its adjective in the PREDICATE_REACH after.
COPULA_REACH = 3
PREDICATE_REACH = 2

# Words of a phrase that are looked up at once; longer phrases are looked up in pieces.
PHRASE_WINDOW = 8

# The words the rules are about.
HEADS = {
    **{lemma: lemma for lemma in ("fur", "coat", "ear", "tail", "body", "size", "eye")},
    **{"furs": "fur", "coats": "coat", "ears": "ear", "tails": "tail"},
    **{"bodies": "body", "sizes": "size", "eyes": "eye"},
}
SUBJECTS = ("cat", "cats", "breed", "breeds", "animal", "animals")
COPULAS = ("be", "am", "is", "are", "was", "were", "been", "being", "seem", "seems", "seemed",
           "become", "becomes", "became", "remain", "remains", "remained", "look", "looks",
           "looked")


@dataclass(frozen=True)
class Rules:
    """What to look for. Only the dictionary and the adjectives may be large.

    ``dictionary``: rows of ``label, canonical, alias``; ``adjectives``: rows of
    ``token``, or None to leave out the feature and character rules.
    """

    dictionary: DataFrame | None = None
    adjectives: DataFrame | None = None
    place_labels: Sequence[str] = ("ORIGIN",)
    heads: dict[str, str] = field(default_factory=lambda: dict(HEADS))
    subjects: Sequence[str] = SUBJECTS
    subject_labels: Sequence[str] = ("BREED",)
    copulas: Sequence[str] = COPULAS


def guarded_text(c: Column) -> Column:
    """Text to look at: NULL for a missing or empty text."""
    return F.nullif(c, F.lit(""))


def tokens(c: Column) -> Column:
    """The words of a text as written: runs of letters and digits."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def lower_tokens(c: Column) -> Column:
    return F.transform(tokens(c), F.lower)


def phrase(c: Column) -> Column:
    """The match form of a phrase: its lower-cased words, one blank between."""
    return F.array_join(lower_tokens(c), " ")


def phrase_table(dictionary: DataFrame, place_labels: Sequence[str] = ("ORIGIN",)) -> DataFrame:
    """One row per label, canonical form and phrase; ``tier`` 1 is the places."""
    is_place = F.col("label").isin(list(place_labels))
    return (
        dictionary.select(
            phrase(F.col("alias")).alias("phrase"),
            F.when(is_place, 1).otherwise(0).alias("tier"),
            "label",
            "canonical",
        )
        .filter(F.col("phrase") != "")
        .distinct()
    )


def preferred_phrases(phrases: DataFrame) -> DataFrame:
    """One row per phrase: the dictionary proper before places, then by label and name."""
    best = F.min(F.struct("tier", "label", "canonical")).alias("best")
    return phrases.groupBy("phrase").agg(best).select("phrase", "best.*")


# Words, or beginnings of phrases, that an expression may list.
LISTED = 2000

# What a word can start. P: a phrase of n words; A and B: an adjective with a head n
# words on; C: a subject of n words; D: no word, the row that stands for the document.
PHRASE, NEAR, NEXT_NEAR, SUBJECT, DOCUMENT = "P", "A", "B", "C", "D"
SUBJECT_PHRASE = "S"
FACT = "F"  # a finished fact, whatever rule gave it

# A slot numbers a copula's place behind a subject and its adjective's place behind that.
SLOTS = COPULA_REACH * PREDICATE_REACH
NO_SLOT = -1


@dataclass(frozen=True)
class _Lists:
    """What expressions look up in place, in lower case."""

    openings: list[str]  # first two words of phrases of several words
    subjects: list[str]  # words that are subjects, by themselves or as phrases
    adjectives: list[str]


@dataclass(frozen=True)
class _Lexicon:
    """The lookup tables of one set of rules, each with whether it fits a broadcast."""

    starts: DataFrame  # first word -> what it can start: rule, n, slot
    starts_fit: bool
    entries: DataFrame  # phrase or piece of one -> dictionary entry
    entries_fit: bool
    adjectives: DataFrame | None
    adjectives_fit: bool
    longest: int  # words of the longest piece
    pieces: bool  # whether any phrase is looked up in pieces
    prefilter: Callable[[Column], Column] | None  # words of a text -> which may start a rule
    lists: _Lists | None  # None where not all are short enough to be listed


_ENTRY = (
    "phrase string, tier int, label string, canonical string, whole string, piece int, pieces int"
)


def _entries(phrases: DataFrame) -> DataFrame:
    """Phrases as ``_ENTRY``: ``whole`` is the phrase that a piece belongs to."""
    words = F.split("phrase", " ")
    n_pieces = F.ceil(F.size(words) / PHRASE_WINDOW).cast("int")
    piece = F.array_join(
        F.slice(words, F.col("piece") * PHRASE_WINDOW + 1, F.lit(PHRASE_WINDOW)), " "
    )
    return phrases.select(
        "phrase", "tier", "label", "canonical", n_pieces.alias("pieces"),
        F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece"),
    ).select(
        piece.alias("phrase"), "tier", "label", "canonical", F.col("phrase").alias("whole"),
        "piece", "pieces",
    )


def _lexicon(spark: SparkSession, phrases: DataFrame | None, rules: Rules) -> _Lexicon:
    literal = [("", DOCUMENT, 0, NO_SLOT)]
    adjectives, longest, pieces = None, 1, False
    tables, openings, subjects, listed_adjectives = [], [], [], []
    entries = literal_table(spark, [], _ENTRY)
    if phrases is not None:
        # Stored once: it is measured and joined, and its own lineage may be long.
        entries = cut_lineage(_entries(phrases))
        n_words = F.size(F.split("phrase", " "))
        longest, most = entries.agg(F.max(n_words), F.max("pieces")).first()
        longest, pieces = longest or 1, (most or 1) > 1
        openings = _listed(entries.filter(n_words > 1).select(_first_two().alias("key")))
        named = (n_words == 1) & F.col("label").isin(list(rules.subject_labels))
        subjects = _listed(entries.filter(named).select(F.col("phrase").alias("key")))
        first_word = F.element_at(F.split("phrase", " "), 1)
        tables.append(
            entries.select(
                first_word.alias("first_word"),
                F.lit(PHRASE).alias("rule"),
                n_words.alias("n"),
                F.lit(NO_SLOT).alias("slot"),
            ).distinct()
        )
    if rules.adjectives is not None:
        words = rules.adjectives.select(F.lower("token").alias("check_word")).distinct()
        adjectives = cut_lineage(words.withColumn("is_adjective", F.lit(True)))
        listed_adjectives = _listed(adjectives.select(F.col("check_word").alias("key")))
        pair = [
            F.struct(F.lit(r).alias("rule"), F.lit(n).alias("n"), F.lit(NO_SLOT).alias("slot"))
            for r, n in ((NEAR, 1), (NEXT_NEAR, 2))
        ]
        tables.append(
            adjectives.select(
                F.col("check_word").alias("first_word"), F.explode(F.array(*pair)).alias("r")
            ).select("first_word", "r.*")
        )
        literal += [(w, SUBJECT, 1, slot) for w in rules.subjects for slot in range(SLOTS)]
    starts = literal_table(spark, literal, "first_word string, rule string, n int, slot int")
    for other in tables:
        starts = starts.unionByName(other)
    starts = cut_lineage(starts) if tables else starts
    starts_fit, prefilter, lists = fits_broadcast(starts), None, None
    if starts_fit:
        first_words = _listed(starts.filter(F.col("rule") != DOCUMENT).select(F.col("first_word").alias("key")))
        if first_words is not None:
            prefilter = _word_list(first_words)
        if not pieces and None not in (first_words, openings, subjects, listed_adjectives):
            lists = _Lists(openings, sorted({*subjects, *rules.subjects}), listed_adjectives)
    else:
        single = starts.filter(F.col("rule") != PHRASE).select(F.col("first_word").alias("key"))
        prefilter = word_filter(single.unionByName(entries.select(_first_two().alias("key"))))
    return _Lexicon(
        starts, starts_fit, entries, phrases is None or fits_broadcast(entries),
        adjectives, adjectives is None or fits_broadcast(adjectives), longest, pieces, prefilter, lists,
    )


def _first_two() -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), 1, 2), " ")


def _listed(keys: DataFrame) -> list[str] | None:
    """The different values of ``key``, or None where they are more than ``LISTED``."""
    found = [row["key"] for row in keys.filter("key IS NOT NULL").distinct().limit(LISTED + 1).collect()]
    return None if len(found) > LISTED else sorted(found)


def _word_list(words: Sequence[str]) -> Callable[[Column], Column]:
    """What ``word_filter`` returns, for words few enough to list: true for no other word."""
    return lambda text: F.transform(text, lambda w: w.isNull() | F.lower(w).isin(list(words)))


# Bits of a filter for each key it holds, and the fewest and the most bits of a filter (8 MB).
FILTER_BITS_PER_KEY = 12
FILTER_BITS = 1 << 16, 1 << 26
_FILTER_SHIFTS = (0, 19, 38)


def word_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """A Bloom filter over ``key``: single words, and the first two words of phrases.

    What it returns maps the words of a text to an array that is false for words that
    start nothing, neither alone nor with the next word. It may be true for others, more
    of them beyond its largest size. NULL, which stands for the document, passes. The
    filter is one array of at most 2 ** 20 numbers, whatever the number of keys.
    """
    hashes = keys.select(F.xxhash64("key").alias("hash")).distinct()
    wanted = FILTER_BITS_PER_KEY * hashes.count()
    bits = min(max(1 << wanted.bit_length(), FILTER_BITS[0]), FILTER_BITS[1])

    def places(code: Column) -> list[Column]:
        return [F.shiftrightunsigned(code, n).bitwiseAND(bits - 1) for n in _FILTER_SHIFTS]

    set_bits = hashes.select(F.explode(F.array(*places(F.col("hash")))).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    numbers = set_bits.groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(F.bit_or(one).alias("bits"))
    held = [0] * (bits // 64)
    for row in numbers.toLocalIterator():
        held[row["at"]] = row["bits"]
    table = F.split(F.lit(",".join(map(str, held))), ",").cast("array<long>")

    def holds(code: Column) -> Column:
        tests = [
            F.getbit(F.get(table, F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).cast("int")) == 1
            for place in places(code)
        ]
        return tests[0] & tests[1] & tests[2]

    def passes(words: Column) -> Column:
        lowered = F.transform(words, F.lower)
        alone = F.transform(lowered, lambda w: w.isNull() | holds(F.xxhash64(w)))
        # The last word has none behind it, for which zip_with gives NULL.
        pairs = F.zip_with(
            lowered, F.slice(lowered, F.lit(2), F.size(lowered)),
            lambda a, b: F.coalesce(holds(F.xxhash64(F.concat(a, F.lit(" "), b))) & a.isNotNull() & b.isNotNull(), F.lit(False)),
        )
        return F.zip_with(alone, pairs, lambda a, b: a | b)

    return passes


def _wanted_places(docs: DataFrame, text: str, keep: Sequence[str],
                   passing: Callable[[Column], Column] | None) -> tuple[DataFrame, Column]:
    """Documents with the words of their text in ``_w``, NULL first, and the places of wanted ones."""
    listed = F.concat(
        F.array(F.lit(None).cast("string")),
        F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")),
    )
    worded = docs.select(*keep, listed.alias("_w"))
    places = F.sequence(F.lit(0), F.size("_w") - 1)
    if passing is None:
        return worded, places
    worded = worded.withColumn("_wanted", passing(F.col("_w")))
    return worded, F.filter(places, lambda place: F.get(F.col("_wanted"), place))


def token_rows(docs: DataFrame, text: str, keep: Sequence[str], lookahead: int,
               passing: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per word: ``pos`` from 1 and ``context``, the word as written and the next ones.

    ``passing`` tells of the words of a text which ones are wanted; others never become rows.

    Position 0 is a row without a word, one per document, also for an empty text.
    ``context`` is cut out of the row's own array before words become rows, which costs no
    shuffle and no copy of the array. It is shorter at the end of a text.
    """
    worded, places = _wanted_places(docs, text, keep, passing)

    def row(place: Column) -> Column:
        return F.struct(place.alias("pos"), F.slice("_w", place + 1, F.lit(lookahead + 1)).alias("context"))

    return worded.select(*keep, F.explode(F.transform(places, row)).alias("_t")).select(*keep, "_t.*")


def distinct_rows(docs: DataFrame, text: str, keep: Sequence[str], lookahead: int,
                  passing: Callable[[Column], Column], enough: Callable[[Column, Column], Column]) -> DataFrame:
    """As ``token_rows``, but words that give the same facts anywhere in a text stand there once.

    ``enough``: from the words of a text and a place, how many words from there decide its
    facts, or NULL where the place itself matters. ``sure`` is true for rows that stand for all
    equal ones; they have no ``pos``.
    """
    worded, places = _wanted_places(docs, text, keep, passing)

    def coded(place: Column) -> Column:
        """The place, or nothing, and the words; no word holds a blank."""
        def joined(n: Column) -> Column:
            words = F.array_join(F.slice("_w", place + 1, F.coalesce(n, F.lit(lookahead + 1))), " ")
            return F.concat(F.when(n.isNull(), place.cast("string")).otherwise(""), F.lit(" "), words)

        return F.when(place == 0, "0 ").otherwise(let(enough(F.col("_w"), place), joined))

    rows = worded.select(*keep, F.explode(F.array_distinct(F.transform(places, coded))).alias("_code"))
    rows = rows.select(*keep, F.split("_code", " ").alias("_parts"))
    return rows.select(
        *keep, F.nullif(F.get("_parts", F.lit(0)), F.lit("")).cast("int").alias("pos"),
        F.slice("_parts", F.lit(2), F.size("_parts")).alias("context"),
        (F.get("_parts", F.lit(0)) == "").alias("sure"),
    )


def _word(k: Column | int) -> Column:
    """The lower-cased word ``k`` words on; NULL past the end of the text."""
    return F.get("low", F.lit(k) if isinstance(k, int) else k)


def _copula_place(slot: str) -> Column:
    """Where a slot's copula stands behind a subject of ``n`` words."""
    return F.col("n") + F.floor(F.col(slot) / PREDICATE_REACH).cast("int")


def _predicate(slot: str) -> Column:
    """The word at a slot's adjective place behind a subject of ``n`` words."""
    return _word(_copula_place(slot) + 1 + F.col(slot) % PREDICATE_REACH)


def _enough(rules: Rules, lists: _Lists, longest: int) -> Callable[[Column, Column], Column]:
    """How many words from a place on decide the facts there; NULL where a phrase may cover it."""
    firsts = sorted({opening.split(" ")[0] for opening in lists.openings})
    heads, copulas = list(rules.heads), list(rules.copulas)

    def enough(words: Column, place: Column) -> Column:
        def word(k: int) -> Column:
            return F.lower(F.get(words, place + k))

        def opens(k: int) -> Column:
            """Whether a phrase of several words may begin ``k`` words on."""
            pair = F.concat(word(k), F.lit(" "), word(k + 1))
            return F.coalesce(word(k).isin(firsts) & pair.isin(lists.openings), F.lit(False))

        n = F.when(reduce(or_, [opens(-k) for k in range(longest)]), None) if firsts else F
        subject = word(0).isin(lists.subjects) & reduce(or_, [word(k).isin(copulas) for k in range(1, COPULA_REACH + 1)])
        adjective = word(0).isin(lists.adjectives) & (word(1).isin(heads) | word(2).isin(heads))
        return n.when(subject, 1 + COPULA_REACH + PREDICATE_REACH).when(adjective, 3).otherwise(1)

    return enough


def _events(
    docs: DataFrame, key: Sequence[str], text: str, carry: Sequence[str], rules: Rules,
    phrases: DataFrame | None, once: bool = False,
) -> tuple[DataFrame, _Lexicon]:
    """Rows that a rule found, still with overlaps, and one DOCUMENT row per document.

    Columns: the key, ``carry`` (DOCUMENT rows only), rule, start, end, tier, n, label,
    canonical, surface, fact, whole, piece, pieces, copies (1). PHRASE rows are hits with an end, or
    pieces of one; SUBJECT_PHRASE rows are facts that hold if the hit at their span
    does; the others have no end, and their facts are finished.

    ``once``: only different facts of a document are wanted. Where the rules' words are listed,
    rows without a place (``sure``) then stand for all equal ones that no phrase of several
    words can cover: their hits are alone, so nothing needs to know where they are.

    Which rules a word can start, which entry a phrase is and which words are
    adjectives are three lookup joins; the rules in between are plain expressions.
    """
    lexicon = _lexicon(docs.sparkSession, phrases, rules)
    with_words = rules.adjectives is not None
    reach = COPULA_REACH + PREDICATE_REACH
    lookahead = lexicon.longest - 1 + (reach if with_words else 0)
    rule, n = F.col("rule"), F.col("n")
    nothing = F.lit(None).cast("string")

    lists = lexicon.lists if once else None
    first_word = F.when(F.col("pos") == 0, "").otherwise(F.lower(F.get("context", F.lit(0))))
    if lists is None:
        rows = token_rows(docs, text, [*key, *carry], lookahead, lexicon.prefilter).withColumn("sure", F.lit(False))
    else:
        enough = _enough(rules, lists, lexicon.longest)
        rows = distinct_rows(docs, text, [*key, *carry], lookahead, lexicon.prefilter, enough)
    started = lookup_join(
        rows.withColumn("first_word", first_word),
        lexicon.starts, ["first_word"], spread_by=[*key, "pos"], small=lexicon.starts_fit,
    )

    lemma = check = nothing
    if with_words:
        is_head = rule.isin(NEAR, NEXT_NEAR)
        copulas = list(rules.copulas)
        # The word a rule hangs on: a head for an adjective, a copula for a subject.
        pivot = F.lower(F.get("context", F.when(is_head, n).otherwise(_copula_place("slot"))))
        started = started.filter(
            rule.isin(PHRASE, DOCUMENT)
            | (is_head & pivot.isin(list(rules.heads)))
            | ((rule == SUBJECT) & pivot.isin(copulas))
        )
    started = started.withColumn("low", F.transform("context", F.lower))

    # A phrase that would run past the end of the text is NULL and matches nothing.
    complete = _word(n - 1).isNotNull()
    phrase_text = F.array_join(F.slice("low", F.lit(1), n), " ")
    if with_words:
        lemmas = F.create_map(*[F.lit(part) for pair in rules.heads.items() for part in pair])
        lemma = F.when(is_head, lemmas[_word(n)])
        # Words to check are never NULL: past the end of the text no adjective matches.
        check = F.when(rule == NEXT_NEAR, _word(1)).when(
            rule == SUBJECT, F.coalesce(_predicate("slot"), F.lit(""))
        )
    found = started.withColumns(
        {
            "phrase": F.when((rule == PHRASE) & complete, phrase_text),
            "lemma": lemma,
            "check_word": check,
        }
    )
    if phrases is not None:
        found = lookup_join(
            found, lexicon.entries, ["phrase"], "left",
            spread_by=[*key, "pos", "n"], small=lexicon.entries_fit,
        ).filter((rule != PHRASE) | F.col("tier").isNotNull())
    else:
        found = found.withColumns(
            {c: F.lit(None).cast(t) for c, t in lexicon.entries.dtypes if c != "phrase"}
        )
    if with_words:
        # A subject phrase is looked at once more for each slot, from its last piece.
        no_slot, every_slot = F.array(F.lit(NO_SLOT)), F.sequence(F.lit(NO_SLOT), F.lit(SLOTS - 1))
        is_subject = F.col("label").isin(list(rules.subject_labels))
        is_subject = (rule == PHRASE) & is_subject & (F.col("piece") == F.col("pieces") - 1)
        slots = F.when(is_subject, every_slot).otherwise(no_slot)
        found = found.withColumn("phrase_slot", F.explode(slots))
        in_slot, copula = F.col("phrase_slot") >= 0, _word(_copula_place("phrase_slot"))
        predicate = F.coalesce(_predicate("phrase_slot"), F.lit(""))
        found = (
            found.filter(~in_slot | copula.isin(copulas))
            .withColumn("check_word", F.when(in_slot, predicate).otherwise(F.col("check_word")))
            .withColumn("rule", F.when(in_slot, SUBJECT_PHRASE).otherwise(rule))
        )
        found = lookup_join(
            found, lexicon.adjectives, ["check_word"], "left",
            spread_by=[*key, "pos", "n"], small=lexicon.adjectives_fit,
        ).filter(F.col("check_word").isNull() | F.col("is_adjective"))

    is_phrase = rule == PHRASE
    begin = F.col("pos") - F.when(rule == SUBJECT_PHRASE, F.col("piece") * PHRASE_WINDOW).otherwise(0)
    surface = F.array_join(F.slice("context", F.lit(1), n), " ")
    named = F.when(F.col("tier") == 0, F.col("canonical"))
    fact = (
        F.when(is_phrase, tag(F.col("label"), F.coalesce(named, surface)))
        .when(rule.isin(NEAR, NEXT_NEAR), feature_tag(F.col("lemma"), F.col("first_word")))
        .when(rule.isin(SUBJECT, SUBJECT_PHRASE), tag("CHARACTER", F.col("check_word")))
    )
    rows = found.select(
        *key,
        *[F.when(rule == DOCUMENT, F.col(c)).alias(c) for c in carry],
        "rule",
        begin.alias("start"),
        F.when(rule.isin(PHRASE, SUBJECT_PHRASE), F.col("pos") + n).alias("end"),
        "tier",
        "n",
        "label",
        "canonical",
        F.when(is_phrase, surface).alias("surface"),
        fact.alias("fact"),
        "whole",
        "piece",
        "pieces",
        F.lit(1).alias("copies"),
        "sure",
    )
    return rows, lexicon


def _settled(events: DataFrame, key: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Events in which what is sure to stay, and what is no hit, has no place; no row is lost.

    Equal facts are not grouped here: that would shuffle them once more than their document.
    """
    rule = F.col("rule")
    finished = rule.isin(NEAR, NEXT_NEAR, SUBJECT) | (rule.isin(PHRASE, SUBJECT_PHRASE) & F.col("sure"))
    own = [c for c in ("start", "end", "tier", "n", "label", "canonical", "surface")]
    return events.select(
        *key, *carry, F.when(finished, FACT).otherwise(rule).alias("rule"),
        *[F.when(~finished, F.col(c)).alias(c) for c in own], "fact", "copies",
    )


def _whole_phrases(events: DataFrame, key: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Events in which the pieces of a phrase that stand one behind the other are one hit."""
    in_pieces = (F.col("rule") == PHRASE) & (F.col("pieces") > 1)
    begin = F.col("start") - F.when(in_pieces, F.col("piece") * PHRASE_WINDOW).otherwise(0)
    own = [F.when(~in_pieces, F.col(c)).alias(c) for c in ("end", "n", "surface", "fact")]
    part = F.when(in_pieces, F.struct("piece", "n", "surface")).alias("part")
    same = [*key, *carry, "rule", "in_pieces", "tier", "label", "canonical", "whole", "pieces"]
    grouped = (
        events.withColumn("in_pieces", in_pieces)
        .select(*same, "copies", begin.alias("start"), *own, part)
        .groupBy(*same, "start", "end", "n", "surface", "fact")
        .agg(F.sum("copies").alias("copies"), F.array_sort(F.collect_set("part")).alias("parts"))
        .filter(~F.col("in_pieces") | (F.size("parts") == F.col("pieces")))
    )
    n = F.aggregate("parts", F.lit(0), lambda total, p: total + p["n"])
    surface = F.array_join(F.transform("parts", lambda p: p["surface"]), " ")
    name = F.coalesce(F.when(F.col("tier") == 0, F.col("canonical")), surface)
    found = {"n": n, "surface": surface, "end": F.col("start") + n, "fact": tag(F.col("label"), name)}
    return grouped.withColumns(
        {c: F.when(F.col("in_pieces"), value).otherwise(F.col(c)) for c, value in found.items()}
    ).drop("in_pieces", "parts")


# Bytes of a word's number in a list of spans, and of a span: its start and its end.
_NUMBER, _SPAN = 8, 16


def _number(c: Column) -> Column:
    """A word's number as bytes that sort as the numbers do."""
    return F.lpad(F.hex(c), _NUMBER, "0").cast("binary")


def _searched(spans: Column, end: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of how many of ``spans`` start before ``end``.

    The spans are the bytes of disjoint ones in order, so that a step of the search reads a
    few bytes, and adding a span copies bytes instead of values.
    """
    n = (F.octet_length(spans) / _SPAN).cast("int")

    def halve(bounds: Column, _: Column) -> Column:
        middle = F.floor((bounds["low"] + bounds["high"]) / 2).cast("int")
        before = F.substr(spans, middle * _SPAN + 1, F.lit(_NUMBER)) < end
        low = F.when(before, middle + 1).otherwise(bounds["low"])
        high = F.when(before, bounds["high"]).otherwise(middle)
        narrowed = F.struct(low.alias("low"), high.alias("high"))
        return F.when(bounds["low"] < bounds["high"], narrowed).otherwise(bounds)

    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))
    bounds = F.struct(F.lit(0).alias("low"), n.alias("high"))
    return F.aggregate(steps, bounds, halve, lambda bounds: use(bounds["low"]))


def _free_spans(hits: Column) -> Column:
    """The spans of those of ``hits``, the best first, that overlap no better one that stays.

    The spans that stay are disjoint, so that a binary search finds the only one that the
    next hit may overlap.
    """

    def merge(spans: Column, hit: Column) -> Column:
        def added(place: Column) -> Column:
            at = place * _SPAN
            fits = (place == 0) | (F.substr(spans, at - _NUMBER + 1, F.lit(_NUMBER)) <= hit["begin"])
            rest = F.substr(spans, at + 1, F.octet_length(spans) - at)
            whole = F.concat(F.substr(spans, F.lit(1), at), hit["begin"], hit["end"], rest)
            return F.when(fits, whole).otherwise(spans)

        return _searched(spans, hit["end"], added)

    coded = F.transform(
        hits,
        lambda h: F.struct(_number(h["start"]).alias("begin"), _number(h["start"] + h["n"]).alias("end")),
    )
    return F.aggregate(coded, F.lit(bytearray()), merge)


def _among(hits: Column, spans: Column) -> Column:
    """Those of ``hits`` whose span is one of ``spans``, which are read from the row once."""

    def found(spans: Column, hit: Column) -> Column:
        begin, end = _number(hit["start"]), _number(hit["start"] + hit["n"])

        def same(place: Column) -> Column:
            last = F.substr(spans, (place - 1) * _SPAN + 1, F.lit(_SPAN))
            return (place > 0) & (last == F.concat(begin, end))

        return _searched(spans, end, same)

    return let(spans, lambda spans: F.filter(hits, lambda hit: found(spans, hit)))


def _runs(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Adds ``run``: the number of the run of overlapping hits that a row belongs to, or 0.

    A run is what hits connect that overlap one another; it ends where no hit before
    reaches the next one's start. Rows in run 0 are settled: a hit alone in its run, what
    waits for such a hit, and all rows that are no hits.
    """
    rule, start, end = F.col("rule"), F.col("start"), F.col("end")
    is_hit, waits = F.col("is_hit"), rule == SUBJECT_PHRASE
    # What waits for a hit stands right behind it.
    order = Window.partitionBy(*key).orderBy("is_hit", "start", "end", "rule")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(is_hit & ~waits, end)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    next_start = F.expr("lead(hit_start) IGNORE NULLS").over(order)
    opens = F.when(is_hit & ~waits, reach.isNull() | (start >= reach))
    alone = opens & (next_start.isNull() | (next_start >= end))
    run = F.sum(F.col("opens").cast("int")).over(so_far)
    settled = ~is_hit | F.last("alone", ignorenulls=True).over(so_far)
    return (
        events.withColumn("is_hit", rule.isin(PHRASE, SUBJECT_PHRASE))
        .withColumn("hit_start", F.when(rule == PHRASE, start))
        .withColumns({"opens": opens, "alone": alone})
        .withColumn("run", F.when(settled, 0).otherwise(run))
    )


# The order of hits is that of their first fields; no two have the same place and length.
_HIT = ("tier", "minus_n", "start", "n", "label", "canonical", "surface", "fact")


def _resolved(events: DataFrame, key: Sequence[str], settled: dict[str, Column], carry: Sequence[str] = ()) -> DataFrame:
    """Events by run: the key, ``settled`` (aggregates of the rows of run 0), ``carry``, and
    in ``kept`` and ``waiting`` the hits of other runs that stay, and what waits for hits.

    Of the hits of a run those go that overlap a better one: by tier, the longest first,
    then the leftmost. A key that stands for more than one document ends the job with an
    error.
    """
    rule, open_ = F.col("rule"), F.col("run") > 0
    hit = F.struct(*[(-F.col("n")).alias(c) if c == "minus_n" else F.col(c) for c in _HIT])
    waiting = F.struct("start", "end", "fact")
    grouped = (
        _runs(events, key)
        .groupBy(*key, "run")
        .agg(
            *[c.alias(name) for name, c in settled.items()],
            F.collect_list(F.when(open_ & (rule == PHRASE), hit)).alias("hits"),
            F.collect_list(F.when(open_ & (rule == SUBJECT_PHRASE), waiting)).alias("waiting"),
            F.sum(F.when(rule == DOCUMENT, F.col("copies"))).alias("documents"),
            *[F.first(c, ignorenulls=True).alias(c) for c in carry],
        )
    )
    repeated = F.concat(F.lit("the key "), F.to_json(F.struct(*key)), F.lit(" stands for more than one document"))
    sound = grouped.filter(F.when(F.col("documents") > 1, F.raise_error(repeated).cast("boolean")).otherwise(True))
    spans = F.when(F.col("run") > 0, _free_spans(F.array_sort("hits")))
    kept = F.when(F.col("run") > 0, _among(F.col("hits"), F.col("spans"))).otherwise(F.col("hits"))
    return sound.withColumn("spans", spans).withColumn("kept", kept).drop("spans", "hits", "documents")


def gazetteer_hits(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Every place a dictionary phrase stands, overlaps included.

    Columns: the key, start (word number from 1), n (words), label, canonical, surface.
    ``key`` must tell documents apart. Without long phrases nothing is shuffled.
    """
    rules = Rules(dictionary)
    events, lexicon = _events(docs, [key], text, [], rules, phrase_table(dictionary))
    hits = events.filter(F.col("rule") == PHRASE)
    if lexicon.pieces:
        hits = _whole_phrases(hits, [key], [])
    return hits.select(key, "start", "n", "label", "canonical", "surface")


def gazetteer_match(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id",
                    text: str = "text", place_labels: Sequence[str] = ("ORIGIN",)) -> DataFrame:
    """The dictionary matches that remain when overlaps are resolved, with their facts.

    ``key`` must tell documents apart; a key that repeats ends the job with an error.
    """
    rules = Rules(dictionary, place_labels=place_labels)
    phrases = preferred_phrases(phrase_table(dictionary, place_labels))
    events, lexicon = _events(docs, [key], text, [], rules, phrases)
    events = events.filter(F.col("rule").isin(PHRASE, DOCUMENT))
    if lexicon.pieces:
        events = _whole_phrases(events, [key], [])
    columns = ("n", "start", "label", "canonical", "surface", "fact")
    alone = (F.col("run") == 0) & (F.col("rule") == PHRASE)
    found = _resolved(events, [key], {"settled": F.collect_list(F.when(alone, F.struct(*columns)))})
    kept = F.transform("kept", lambda k: F.struct(*[k[c].alias(c) for c in columns]))
    hit = F.explode(F.when(F.col("run") == 0, F.col("settled")).otherwise(kept))
    return found.select(key, hit.alias("hit")).select(key, "hit.*")


def word_facts(docs: DataFrame, rules: Rules, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Feature and character facts of subject words: the key and ``fact``, with repeats.

    Subjects found by phrase need the resolved matches and come from ``extract_facts``.
    """
    events, _ = _events(docs, [key], text, [], replace(rules, dictionary=None), None)
    return events.filter(F.col("rule") != DOCUMENT).select(key, "rule", "start", "fact")


def document_facts(docs: DataFrame, rules: Rules, key: Sequence[str], text: str,
                   carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: the key, ``carry`` and the sorted distinct facts.

    ``key`` must tell documents apart; a key that repeats ends the job with an error. A
    document without facts has an empty array.
    """
    phrases = None
    if rules.dictionary is not None:
        phrases = preferred_phrases(phrase_table(rules.dictionary, rules.place_labels))
    events, lexicon = _events(docs, key, text, carry, rules, phrases, once=True)
    events = _whole_phrases(events, key, carry) if lexicon.pieces else _settled(events, key, carry)
    settled = {"settled": F.collect_set(F.when(F.col("run") == 0, F.col("fact")))}
    held = F.filter(
        "waiting",
        lambda w: F.exists("kept", lambda k: (k["start"] == w["start"]) & (k["start"] + k["n"] == w["end"])),
    )
    kept = F.concat(F.transform("kept", lambda k: k["fact"]), F.transform(held, lambda w: w["fact"]))
    facts = F.when(F.col("run") == 0, F.col("settled")).otherwise(kept)
    found = _resolved(events, key, settled, carry).withColumn("facts", facts)
    listed = F.filter(F.array_distinct(F.flatten(F.collect_list("facts"))), lambda f: f.isNotNull())
    return found.groupBy(*key).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in carry], F.array_sort(listed).alias("extracted_facts")
    )


RECORD = "_record"


def extract_facts(
    docs: DataFrame,
    rules: Rules,
    key: Sequence[str] | None = None,
    text: str = "text",
    extra_extractors: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> DataFrame:
    """Documents to ``title, source_file, extracted_facts``; markup is removed first.

    One row per input record. ``key`` names columns that tell records apart; if it
    repeats, the job ends with an error. Without a key the records are stored once
    under numbers of their own, so that a task that runs again meets the same ones: a
    file may hold many records. An extra extractor maps the documents (the key and text
    without markup) to rows of the key and ``fact``, for instance a ``mapInPandas`` over
    a model; its facts join the others.
    """
    if key is None:
        docs = cut_lineage(docs.withColumn(RECORD, F.monotonically_increasing_id()))
        key = [RECORD]
    key = list(key)
    carry = [c for c in ("title", "source_file") if c not in key]
    plain = docs.withColumn(text, html_to_text(guarded_text(F.col(text))))
    # Facts are made of words, between which white space may be of any length.
    worded = docs.withColumn(text, without_markup(guarded_text(F.col(text))))
    result = document_facts(worded, rules, key, text, carry)
    for extractor in extra_extractors:
        more = extractor(plain.select(*key, text)).select(*key, "fact")
        more = more.distinct().groupBy(*key).agg(F.collect_list("fact").alias("_more"))
        added = F.coalesce("_more", F.array().cast("array<string>"))
        result = result.join(more, key, "left").withColumn(
            "extracted_facts", sorted_set(F.concat("extracted_facts", added))
        )
    return result.select("title", "source_file", "extracted_facts")

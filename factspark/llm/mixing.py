"""Mixing sources to target weights with whole blocks of words, on column expressions alone.

Sources get target sizes by weight, none above twice its own size. Each source is dealt
into shards by a seeded hash, and the shards' documents stand in seeded order. All blocks
hold equally many words; shards get blocks by the Sainte-Laguë rule: the highest quotients
target / 1, target / 3, target / 5, ... win. A shard that gets q of its m blocks takes all
of them q // m times and a seeded run of q % m blocks once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.llm.components import stored
from factspark.llm.quality_rules import WORD

#: Words in a block. A shard's blocks are taken in runs, so that a small block cuts no
#: more documents than a large one, and rounds less.
BLOCK_WORDS = 1
#: Shards of all sources together, besides one for each source, and documents in a shard:
#: more shards than these where a shard would hold more than ``LARGEST_SHARD`` documents.
SHARDS = 2048
SHARD_DOCS = 64
LARGEST_SHARD = 2_000_000
#: The white space between words, as a class of characters.
SPACE = r"\x20\x09-\x0D"


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row per source).

    Sources by code point, null last, weigh ``weights`` in turn. They divide ``share`` of
    all words; what would lift a source above ``most`` times its size goes to the others
    by weight. That is one level per weight, ``least(cap, weight * level)``, found by
    running sums over the sources in the order of cap / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    named = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    everything = by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all_words") * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = named.withColumn("all_words", F.sum("source_size").over(everything))
    level = level.withColumn("all_weight", F.sum("weight").over(everything)).withColumn("level", left / weight_left)
    # The level falls no further once a source takes less than its cap.
    final = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct(F.col("cap") / F.col("weight"), "level")))
    level = level.withColumn("final", final.over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("final"), F.col("cap")))
    return level.select("source", "source_size", target.alias("target"))


def shard_quotas(shards: DataFrame, block: int, most: float) -> DataFrame:
    """Adds ``blocks`` and ``quota`` to rows with ``words`` and ``share`` (words wanted).

    The last seat goes to a quotient close to block / 2 words: with n shards, seats that
    any divisor between N + n / 2 and N - n / 2 would give are certain, and only the few
    between them are ranked. Shares are summed in the order of source and shard, so that
    the last bit of the sum, and with it the number of seats, is the same in every run.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last(), "shard")
    everything = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = shards.withColumn("wanted", F.sum("share").over(everything)).withColumn("n", F.count(F.lit(1)).over(everything))
    totals = totals.withColumn("seats", F.round(F.col("wanted") / block).cast("long"))

    def seats_at(total: Column) -> Column:
        value = F.floor(F.col("share") * F.greatest(total, F.lit(0.0)) / F.col("wanted") + 0.5)
        return F.when(F.col("wanted") > 0, value).otherwise(0).cast("long")

    half = F.col("n") / 2.0 + 1
    bounds = totals.withColumn("sure", seats_at(F.col("seats") - half)).withColumn("possible", seats_at(F.col("seats") + half))
    bounds = bounds.withColumn("left", F.col("seats") - F.sum("sure").over(everything))
    contested = bounds.filter("possible > sure").select(
        "source", "shard", "share", "left", F.explode(F.sequence(F.col("sure"), F.col("possible") - 1)).alias("seat")
    )
    quotient = F.col("share") / (2 * F.col("seat") + 1)
    rank = F.row_number().over(Window.orderBy(quotient.desc(), F.col("source").asc_nulls_last(), "shard", "seat"))
    won = contested.withColumn("rank", rank).filter("rank <= left")
    won = won.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("won"))
    won = won.select(F.col("source").alias("won_source"), F.col("shard").alias("won_shard"), "won")
    same = F.col("source").eqNullSafe(F.col("won_source")) & (F.col("shard") == F.col("won_shard"))
    quota = F.col("sure") + F.coalesce("won", F.lit(0))
    blocks = F.ceil(F.col("words") / block)
    return bounds.join(won, same, "left").select(
        *shards.columns, blocks.alias("blocks"), F.least(quota, (blocks * int(most))).alias("quota")
    )


def _chosen_before(place: Column, start: Column, run: Column, blocks: Column) -> Column:
    """How many of the blocks before ``place`` lie in the run of ``run`` blocks from ``start``, around the end."""
    wrapped = F.greatest(start + run - blocks, F.lit(0))
    return F.greatest(F.least(place, start + run) - start, F.lit(0)) + F.least(place, wrapped)


def _measured(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> list[Column]:
    """What the mix needs of each row: no text, but a hash that tells texts apart."""
    text = F.col(f"`{text_column}`").cast("string")
    return [
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    ]


def _chosen(
    sized: DataFrame, weights: Sequence[float], share: float, most: float, seed: int, block: int, shards: int
) -> DataFrame:
    """Stored rows of ``doc_id, source, size, text_hash`` (and more) with what the mix takes of each.

    Adds ``source_size, target, taken`` and which words are taken: all of them ``times``
    times, and once more the first ``head`` and those from ``first`` up to ``last`` (two
    parts where the run goes around the end within the document).
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per_source = stored(per_source, "source-sizes")
    targets = source_targets(per_source.select("source", "source_size"), weights, share, most)
    all_docs = F.sum("n_docs").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy())
    in_all = F.greatest(F.lit(shards), F.ceil(all_docs / LARGEST_SHARD))
    n_shards = F.least(F.ceil(in_all * F.col("n_docs") / all_docs), F.ceil(F.col("n_docs") / SHARD_DOCS)).cast("int")
    names = per_source.select(F.col("source").alias("name"), n_shards.alias("n_shards"))
    targets = targets.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    targets = stored(targets, "targets")
    named = targets.select(F.col("source").alias("name"), "n_shards")
    spread = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("n_shards")).cast("int")
    dealt = sized.join(named, F.col("source").eqNullSafe(F.col("name"))).withColumn("shard", spread).drop("name", "n_shards")
    per_shard = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    known = targets.select(F.col("source").alias("name"), "source_size", "target")
    per_shard = per_shard.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("words") / F.col("source_size")).otherwise(0.0)
    quotas = stored(shard_quotas(per_shard.withColumn("share", wanted), block, most), "quotas")

    quotas = quotas.select(
        F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "source_size", "target", "blocks", "quota"
    )
    same = F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard"))
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size", "text_hash")
    rows = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(quotas, same).withColumn("begin", F.col("end") - F.col("size"))
    full = F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0)
    rows = rows.withColumn("times", full).withColumn("run", F.col("quota") - F.col("times") * F.col("blocks"))
    first_block = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.greatest("blocks", F.lit(1)))
    rows = rows.withColumn("start", first_block)

    def chosen(place: Column) -> Column:
        """Words of the run before the given place in the shard."""
        whole_blocks = F.floor(place / block)
        inside = _chosen_before(whole_blocks + 1, *run) - _chosen_before(whole_blocks, *run)
        return _chosen_before(whole_blocks, *run) * block + inside * (place - whole_blocks * block)

    def words_before(blocks: Column) -> Column:
        """Words of the document in the shard's first ``blocks`` blocks."""
        return F.greatest(F.least(blocks * block - F.col("begin"), F.col("size")), F.lit(0)).cast("int")

    run = (F.col("start"), F.col("run"), F.col("blocks"))
    stop = F.col("start") + F.col("run")
    taken = F.col("size") * F.col("times") + chosen(F.col("end")) - chosen(F.col("begin"))
    return rows.select(
        *sized.columns,
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.col("times").cast("int").alias("times"),
        words_before(F.greatest(stop - F.col("blocks"), F.lit(0))).alias("head"),
        words_before(F.col("start")).alias("first"),
        words_before(F.least(stop, F.col("blocks"))).alias("last"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    seed: int = 1,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document.

    ``size`` counts words (null: none), ``taken`` those that the mix takes, repeats
    counted. Null is a source of its own. Rows with the same id and text are
    interchangeable: reruns give the same rows. A source without words gets nothing,
    an empty table gives no rows. Other columns are ignored.
    """
    sized = stored(docs.select(*_measured(docs, id_column, text_column, source_column)), "sizes")
    rows = _chosen(sized, weights, share, most, seed, block, shards)
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    seed: int = 1,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows that the mix takes, with the columns of ``docs``.

    A document that is taken r times and k words more gives r rows with its whole text and
    one with those k words, or two where the run goes around its shard's end within the
    document; one of which nothing is taken gives none. The rows are stored once under
    numbers of their own: only sizes are sorted within shards, and texts meet their
    quotas by number.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = _measured(docs, id_column, text_column, source_column)
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("number"), *measured, row), "numbered-rows")
    chosen = _chosen(numbered.drop("row"), weights, share, most, seed, block, shards).filter("taken > 0")

    def part(first: Column, last: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))

    none, size = F.lit(0), F.col("size")
    once_more = F.array(part(none, F.col("head")), part(F.col("first"), F.col("last")))
    parts = F.concat(F.array_repeat(part(none, size), F.col("times")), F.filter(once_more, lambda x: x["last"] > x["first"]))
    chosen = chosen.select("number", "size", parts.alias("parts"))
    rows = numbered.select("number", "row").join(chosen, "number").withColumn("part", F.explode("parts"))
    text, first, last = F.col("row")[text_column], F.col("part")["first"], F.col("part")["last"]
    # Each word with the white space before it, so that what is cut off is all that changes.
    spaced = F.regexp_extract_all(text, F.lit(rf"([{SPACE}]*{WORD})"), F.lit(1))
    joined = F.array_join(F.slice(spaced, first + 1, last - first), "")
    joined = F.when(first > 0, F.regexp_replace(joined, rf"\A[{SPACE}]+", "")).otherwise(joined)
    cut = F.when(last - first < size, joined).otherwise(text)
    return rows.withColumn("cut", cut).select(
        *[(F.col("cut") if c == text_column else F.col("row")[c]).alias(c) for c in docs.columns]
    )

"""Full-text search over facts, for a batch of queries at a time.

Words are lower-cased runs of letters and digits, without stemming or stop words; a
hyphenated compound is indexed by its parts only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspark.functions.strings import concat_or_empty
from factspark.operators.extraction import lower_tokens
from factspark.operators.fusion import FACT
from factspark.operators.joins import lookup_join
from factspark.session import cut_lineage

SEARCHED = ("breed", "fact_type", "fact_value", "source_list")

# The ranking constants of the public text-search definition.
POSITION_WEIGHT = 0.1
SERIES_LIMIT = 1.64493406685
FAR_APART = 100


def postings(facts: DataFrame, key: Sequence[str] = FACT,
             searched: Sequence[str] = SEARCHED) -> DataFrame:
    """The key, ``lexeme`` and its sorted ``positions`` (from 1) in the searched text."""
    text = concat_or_empty(*[F.col(c) for c in searched])
    return (
        facts.select(*key, F.posexplode(lower_tokens(text)).alias("pos", "lexeme"))
        .groupBy(*key, "lexeme")
        .agg(F.array_sort(F.collect_list(F.col("pos") + 1)).alias("positions"))
    )


# Fixed by the stored form: postings lie in partitions by a hash of a word's beginning.
BUCKETS = 128
BUCKET_CHARS = 2


def bucket_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.substr(word, F.lit(1), F.lit(BUCKET_CHARS))), F.lit(BUCKETS)).cast("int")


def write_postings(rows: DataFrame, path: str, key: Sequence[str] = FACT) -> None:
    """Store postings by ``bucket``, so that a search reads only those of its words.

    The key takes part in the range, which spreads a frequent word over several files.
    """
    dealt = rows.withColumn("bucket", bucket_of(F.col("lexeme")))
    dealt = dealt.repartitionByRange("bucket", "lexeme", *key)
    dealt.sortWithinPartitions("bucket", "lexeme", *key).write.mode("overwrite").partitionBy(
        "bucket"
    ).parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


TERM_KINDS = ("all_of", "any_of", "none_of", "prefix")


def query_terms(queries: DataFrame) -> DataFrame:
    """``query_id, query`` to one row per distinct word, with the query's ``n_terms``."""
    terms = F.array_distinct(lower_tokens(F.col("query")))
    return queries.select("query_id", terms.alias("terms")).select(
        "query_id", F.explode("terms").alias("term"), F.size("terms").alias("n_terms")
    )


def search_terms(queries: DataFrame) -> DataFrame:
    """Queries to rows of words: what each one asks for, part by part.

    ``queries`` has ``query_id`` and any of ``query`` (plain words, all required) and the
    arrays ``all_of, any_of, none_of, prefix``. An item of an array is split into words
    as indexed text is; an item of several words stands for all of them, and the last
    word of a prefix item is the prefix. Items without a word ask for nothing.

    Columns: query_id, kind, item, n_parts, part, is_prefix, term, n_required, n_any, n_none.
    """

    def entry(kind: str, words: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), words.alias("words"))

    def entries(kind: str) -> Column:
        listed = F.coalesce(F.col(kind), F.array().cast("array<string>"))
        return F.transform(listed, lambda x: entry(kind, lower_tokens(x)))

    lists = []
    if "query" in queries.columns:
        plain = F.array_distinct(F.coalesce(lower_tokens(F.col("query")), F.array().cast("array<string>")))
        lists.append(F.transform(plain, lambda w: entry("all_of", F.array(w))))
    lists += [entries(kind) for kind in TERM_KINDS if kind in queries.columns]
    items = F.array_distinct(F.filter(F.concat(*lists), lambda x: F.size(x["words"]) > 0))

    def number(*kinds: str) -> Column:
        return F.size(F.filter("items", lambda x: x["kind"].isin(*kinds)))

    return (
        queries.select("query_id", items.alias("items"))
        .select(
            "query_id",
            number("all_of", "prefix").alias("n_required"),
            number("any_of").alias("n_any"),
            number("none_of").alias("n_none"),
            F.posexplode("items").alias("item", "asked"),
        )
        .select(
            "query_id", "n_required", "n_any", "n_none", "item", F.col("asked")["kind"].alias("kind"),
            F.size(F.col("asked")["words"]).alias("n_parts"),
            F.posexplode(F.col("asked")["words"]).alias("part", "term"),
        )
        .withColumn("is_prefix", (F.col("kind") == "prefix") & (F.col("part") == F.col("n_parts") - 1))
    )


def _with_buckets(rows: DataFrame) -> DataFrame:
    return rows if "bucket" in rows.columns else rows.withColumn("bucket", bucket_of(F.col("lexeme")))


def matching_postings(rows: DataFrame, terms: DataFrame, key: Sequence[str] = FACT) -> DataFrame:
    """Postings of the words in ``term``, read from the buckets that may hold them."""
    wanted = terms.withColumnRenamed("term", "lexeme").filter(F.col("lexeme") != "")
    wanted = wanted.withColumn("bucket", bucket_of(F.col("lexeme")))
    found = lookup_join(
        _with_buckets(rows), wanted, ["bucket", "lexeme"], spread_by=[*key, "lexeme"]
    )
    return found.drop("bucket")


def prefix_postings(rows: DataFrame, terms: DataFrame, key: Sequence[str] = FACT) -> DataFrame:
    """Postings of the words that begin with ``term``.

    Found by equality: each word offers its beginnings of the lengths that occur among
    the prefixes. A prefix of one character may lie in any bucket.
    """
    short = F.length("term") < BUCKET_CHARS
    buckets = F.when(short, F.sequence(F.lit(0), F.lit(BUCKETS - 1))).otherwise(
        F.array(bucket_of(F.col("term")))
    )
    wanted = terms.filter(F.col("term") != "").withColumn("bucket", F.explode(buckets))
    lengths = terms.agg(F.collect_set(F.length("term"))).scalar()
    beginnings = F.transform(
        F.filter("_lengths", lambda n: n <= F.length("lexeme")),
        lambda n: F.substr(F.col("lexeme"), F.lit(1), n),
    )
    offered = _with_buckets(rows).withColumn("_lengths", lengths)
    offered = offered.select(
        *key, "lexeme", "positions", "bucket", F.explode(beginnings).alias("term")
    )
    return lookup_join(offered, wanted, ["bucket", "term"], spread_by=[*key, "lexeme"]).drop("bucket")


def match(facts: DataFrame, rows: DataFrame, queries: DataFrame,
          key: Sequence[str] = FACT) -> DataFrame:
    """Facts that each query asks for: ``query_id``, the key and ``rank``.

    A fact holds all of ``query``, ``all_of`` and ``prefix``, one of ``any_of`` (if any
    are given), and nothing of ``none_of``. The rank counts the words that were asked
    for and found. A query of ``none_of`` alone starts from all facts and has rank 0.
    """
    terms = cut_lineage(search_terms(queries))
    columns = ["query_id", *key, "kind", "item", "n_parts", "part", "n_required", "n_any", "lexeme", "positions"]
    exact = matching_postings(rows, terms.filter(~F.col("is_prefix")), key)
    hits = exact.select(*columns)
    if not terms.filter("is_prefix").isEmpty():
        hits = hits.unionByName(
            prefix_postings(rows, terms.filter("is_prefix"), key).select(*columns)
        )
    part = F.struct("kind", "item", "n_parts", "part")
    asked_for = F.when(F.col("kind") != "none_of", F.struct("lexeme", "positions"))
    found = hits.groupBy("query_id", *key).agg(
        F.collect_set(part).alias("parts"),
        F.array_sort(F.collect_set(asked_for)).alias("words"),
        F.max("n_required").alias("n_required"),
        F.max("n_any").alias("n_any"),
    )

    def satisfied(*kinds: str) -> Column:
        """How many items have all their parts."""
        mine = F.filter("parts", lambda p: p["kind"].isin(*kinds))
        whole = F.filter(
            mine,
            lambda p: F.size(F.filter("parts", lambda q: q["item"] == p["item"])) == p["n_parts"],
        )
        return F.size(F.array_distinct(F.transform(whole, lambda p: p["item"])))

    positive = found.filter(
        (F.col("n_required") + F.col("n_any") > 0)
        & (satisfied("all_of", "prefix") == F.col("n_required"))
        & ((F.col("n_any") == 0) | (satisfied("any_of") > 0))
        & (satisfied("none_of") == 0)
    ).select("query_id", *key, rank(F.col("words")).alias("rank"))
    only_none = terms.filter("n_required + n_any = 0").select("query_id").distinct()
    if only_none.isEmpty():
        return positive
    excluded = found.filter(satisfied("none_of") > 0).select("query_id", *key)
    others = _all_facts(facts.select(*key), only_none).join(excluded, ["query_id", *key], "left_anti")
    return positive.unionByName(others.select("query_id", *key, F.lit(0.0).alias("rank")))


#: Queries that one fact meets at a time where all facts are wanted.
QUERY_BLOCK = 1000


def _all_facts(facts: DataFrame, queries: DataFrame) -> DataFrame:
    """Every fact for each of the queries, which come in blocks of about ``QUERY_BLOCK``."""
    blocks = -(-queries.count() // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    asked = queries.select("query_id", block).groupBy("block").agg(F.collect_list("query_id").alias("ids"))
    copies = facts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = lookup_join(copies, asked, ["block"], spread_by=facts.columns)
    return met.select(*facts.columns, F.explode("ids").alias("query_id"))


def rank(words: Column) -> Column:
    """How well a fact fits: higher for words that stand often and close together.

    ``words`` holds ``lexeme, positions`` of each matched word. One word scores a
    series over its occurrences; several score every pair of positions of two
    different words by distance.
    """
    series = F.reduce(
        words[0]["positions"],
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("j")),
        lambda acc, _: F.struct(
            (acc["sum"] + POSITION_WEIGHT / (acc["j"] * acc["j"])).alias("sum"),
            (acc["j"] + 1.0).alias("j"),
        ),
        lambda acc: acc["sum"] / SERIES_LIMIT,
    )
    placed = F.flatten(
        F.transform(
            words,
            lambda w, i: F.transform(
                w["positions"], lambda p: F.struct(i.alias("i"), p.alias("p"))
            ),
        )
    )
    unlikely = F.reduce(
        placed,
        F.lit(1.0),
        lambda acc, x: acc
        * F.reduce(
            F.filter(placed, lambda y: y["i"] < x["i"]),
            F.lit(1.0),
            lambda inner, y: inner * (1.0 - _closeness(F.abs(x["p"] - y["p"]))),
        ),
    )
    return F.when(F.size(words) == 1, series).otherwise(1.0 - unlikely)


def _closeness(distance: Column) -> Column:
    near = 1.0 / (1.005 + 0.05 * F.exp(distance / 1.5 - 2.0))
    by_distance = F.when(distance > FAR_APART, F.lit(1e-30)).otherwise(near)
    return F.sqrt(F.lit(POSITION_WEIGHT * POSITION_WEIGHT) * by_distance)


def search(facts: DataFrame, rows: DataFrame, queries: DataFrame,
           limit: int | None = None, key: Sequence[str] = FACT) -> DataFrame:
    """What each query finds, the best score first, then the best rank.

    ``queries`` as for ``search_terms``; ``rows`` are postings of the facts, stored or
    not. ``limit`` keeps the first facts of each query.
    """
    found = match(facts, rows, queries, key)
    order = [F.col("final_score").desc(), F.col("rank").desc(), *key]
    listed = facts.join(found, list(key)).select(
        "query_id", "breed", "fact_type", "fact_value", "source_list", "mentions_count", "final_score", "rank"
    )
    if limit is not None:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
        listed = listed.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")
    return listed.orderBy("query_id", *order)

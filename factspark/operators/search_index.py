"""A stored search index: score bands for limited searches, segments for refreshes.

Facts and their postings lie in bands of falling final score, so that all postings of a
fact are in one band and every fact of a band scores higher than all facts of later ones.
A limited search reads the best band first and ends for a query once it has its facts. A
table of words knows the bands that hold each word; a query skips those that lack one of
its required words.

A refresh adds a segment: the rows of facts that are new or differ, and the keys of facts
that it replaces or removes. Each row carries the number of the snapshot that brought it
(``_seq``). A fact's row counts until a later snapshot names its key. Words are matched
within one version of a fact only; versions that are gone leave the matches, not the
postings, so no refresh touches a stored posting. Compaction writes one segment anew.

Snapshots are published by manifest: a search pins one and is not disturbed by refreshes.
Facts need a non-null key that is theirs alone.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from factspark.operators.fusion import FACT
from factspark.operators.joins import lookup_join
from factspark.operators.search import (
    BUCKET_CHARS,
    BUCKETS,
    bucket_of,
    match,
    postings,
    search_terms,
)
from factspark.session import cut_lineage
from factspark.sources.snapshots import Snapshot, new_folder, pin, publish

STORED = [*FACT, "source_list", "mentions_count", "final_score"]
VERSION = [*FACT, "_seq"]

#: The shares of facts above the lower bound of each band but the last.
SHARES = (1 / 512, 1 / 64, 1 / 8)
#: A refresh that would leave more segments compacts.
MAX_SEGMENTS = 8


def band_of(score: Column, bounds: Sequence[float]) -> Column:
    """The band of a score, 0 the best; missing scores are in the last, as in the order."""
    band = F.lit(0)
    for bound in bounds:
        band = band + F.coalesce(score < F.lit(bound), F.lit(True)).cast("int")
    return band


def _bounds(facts: DataFrame) -> list[float]:
    """Scores that cut the facts into bands, from the highest down; equal ones count once."""
    shares = F.array(*[F.lit(1 - s) for s in SHARES])
    score = F.when(~F.isnan("final_score"), F.col("final_score"))
    found = facts.agg(F.percentile_approx(score, shares, 100_000)).first()[0]
    return sorted(set(found or []), reverse=True)


PARTS = ("facts", "postings", "words", "gone")


def segments(at: Snapshot) -> int:
    return len(at.paths("facts"))


def _write_segment(facts: DataFrame, gone: DataFrame, root: str, bounds: Sequence[float], number: int) -> list[str]:
    """Write a segment's parts and return their folders.

    The folders are named as partitions, so that one scan reads a part of all segments.
    Rows lie by bucket and word, so the statistics of row groups tell which a search may
    skip, and there are about as many files as tasks that write, not one per bucket.
    """
    spark, name = facts.sparkSession, new_folder("segment=s")
    folders = {part: f"{root}/{part}/{name}" for part in PARTS}
    placed = facts.select(*STORED).withColumns(
        {"_seq": F.lit(number), "band": band_of(F.col("final_score"), bounds)}
    )
    placed.repartitionByRange("band", *FACT).write.partitionBy("band").parquet(folders["facts"])
    kept = spark.read.schema(placed.schema).parquet(folders["facts"])
    rows = postings(kept, [*VERSION, "band"]).withColumn("bucket", bucket_of(F.col("lexeme")))
    order = ["band", "bucket", "lexeme", *FACT]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("band").parquet(
        folders["postings"]
    )
    words = (
        spark.read.schema(rows.schema).parquet(folders["postings"])
        .groupBy("bucket", "lexeme")
        .agg(F.bit_or(F.expr("shiftleft(1L, band)")).alias("bands"))
    )
    by_bucket = words.repartitionByRange("bucket", "lexeme").sortWithinPartitions("bucket", "lexeme")
    by_bucket.write.parquet(folders["words"])
    gone.select(*FACT).distinct().withColumn("_seq", F.lit(number)).write.parquet(folders["gone"])
    return [f"{part}/{name}" for part in PARTS]


def _read(spark: SparkSession, at: Snapshot, part: str, schema: str | StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", f"{at.root}/{part}")
    return reader.parquet(*at.paths(part)).drop("segment")


def _facts(spark: SparkSession, at: Snapshot) -> DataFrame:
    stored = StructType.fromJson(json.loads(at.properties["schema"]))
    return _read(spark, at, "facts", stored.add("_seq", IntegerType()).add("band", IntegerType()))


def _key_types(at: Snapshot) -> str:
    stored = StructType.fromJson(json.loads(at.properties["schema"]))
    return ", ".join(f"`{k}` {stored[k].dataType.simpleString()}" for k in FACT)


def _postings(spark: SparkSession, at: Snapshot) -> DataFrame:
    schema = f"{_key_types(at)}, _seq int, lexeme string, positions array<int>, bucket int, band int"
    return _read(spark, at, "postings", schema)


def _live(rows: DataFrame, at: Snapshot) -> DataFrame:
    """Rows (with the key and ``_seq``) whose version of the fact still counts."""
    if segments(at) == 1:
        return rows
    gone = _read(rows.sparkSession, at, "gone", f"{_key_types(at)}, _seq int")
    last = gone.groupBy(*FACT).agg(F.max("_seq").alias("_gone"))
    marked = lookup_join(rows, last, FACT, "left", spread_by=rows.columns)
    return marked.filter(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_seq"))).select(*rows.columns)


def live_facts(spark: SparkSession, at: Snapshot) -> DataFrame:
    """The facts that a snapshot of the index holds."""
    return _live(_facts(spark, at), at).select(*STORED)


def build_index(facts: DataFrame, root: str) -> Snapshot:
    """Store ``facts`` as one segment, in place of whatever the index held.

    They are computed twice, for the bands' bounds and for the rows: pass stored ones.
    """
    return _build(facts, root, pin(facts.sparkSession, root))


def _build(facts: DataFrame, root: str, before: Snapshot | None) -> Snapshot:
    spark, root = facts.sparkSession, root.rstrip("/")
    facts = facts.select(*STORED)
    bounds = _bounds(facts)
    folders = _write_segment(facts, facts.limit(0), root, bounds, before.number + 1 if before else 1)
    return publish(spark, root, folders, {"schema": facts.schema.json(), "bounds": bounds}, before)


def add_segment(changed: DataFrame, root: str, removed: DataFrame | None = None) -> Snapshot:
    """Put the rows of ``changed`` in, in place of facts of the same key, and take out ``removed``.

    ``removed`` needs the key only. A key in both is changed.
    """
    return _add(changed, removed, root, pin(changed.sparkSession, root))


def _add(changed: DataFrame, removed: DataFrame | None, root: str, before: Snapshot | None) -> Snapshot:
    if before is None:
        raise ValueError(f"there is no index in {root}")
    spark, root = changed.sparkSession, root.rstrip("/")
    stored = StructType.fromJson(json.loads(before.properties["schema"]))
    changed = cut_lineage(changed.select(*[F.col(f.name).cast(f.dataType) for f in stored]))
    gone = changed.select(*FACT)
    if removed is not None:
        gone = gone.unionByName(removed.select(*FACT))
    folders = _write_segment(changed, gone, root, before.properties["bounds"], before.number + 1)
    after = publish(spark, root, [*before.folders, *folders], before.properties, before)
    return compact_index(spark, root) if segments(after) > MAX_SEGMENTS else after


def refresh_index(facts: DataFrame, root: str) -> Snapshot:
    """Make the index hold exactly ``facts``, by a segment of what differs.

    The rows of both are compared by key; postings are neither read nor written but for
    facts that differ. Without a difference the snapshot stays as it is.
    """
    spark = facts.sparkSession
    before = pin(spark, root)
    if before is None:
        return build_index(facts, root)
    rest = [c for c in STORED if c not in FACT]
    new = facts.select(*FACT, F.struct(*rest).alias("_new"))
    old = live_facts(spark, before).select(*FACT, F.struct(*rest).alias("_old"))
    differ = cut_lineage(new.join(old, FACT, "full").filter(~F.col("_new").eqNullSafe(F.col("_old"))))
    if differ.isEmpty():
        return before
    changed = differ.filter("_new IS NOT NULL").select(*FACT, "_new.*")
    return _add(changed, differ.filter("_new IS NULL"), root, before)


def compact_index(spark: SparkSession, root: str) -> Snapshot:
    """Write all live facts as one segment, with bands of their own."""
    before = pin(spark, root)
    return _build(live_facts(spark, before), root, before)


def _found(facts: DataFrame, rows: DataFrame, queries: DataFrame, at: Snapshot) -> DataFrame:
    hits = _live(match(facts, rows, queries, VERSION), at)
    return facts.join(hits, VERSION).select("query_id", *STORED, "rank")


def _bands_to_read(spark: SparkSession, at: Snapshot, terms: DataFrame) -> DataFrame:
    """``query_id, bands``: bits of the bands that hold all the words a query requires."""
    asked = terms.filter((F.col("kind") == "all_of") & ~F.col("is_prefix"))
    asked = asked.select("query_id", F.col("term").alias("lexeme"), bucket_of(F.col("term")).alias("bucket"))
    words, _ = _blocks(_read(spark, at, "words", "lexeme string, bands bigint, bucket int"), terms)
    found = lookup_join(words, asked.distinct(), ["bucket", "lexeme"])
    found = found.groupBy("query_id", "lexeme").agg(F.bit_or("bands").alias("bands"))
    every = F.lit((1 << (len(at.properties["bounds"]) + 1)) - 1)
    needed = asked.groupBy("query_id").agg(F.count_distinct("lexeme").alias("n"))
    held = found.groupBy("query_id").agg(F.count("*").alias("m"), F.bit_and("bands").alias("bands"))
    return (
        terms.select("query_id").distinct()
        .join(needed, "query_id", "left").join(held, "query_id", "left")
        .select("query_id", F.when(F.col("n").isNull(), every)
                .when(F.col("n") == F.col("m"), F.col("bands")).otherwise(F.lit(0)).cast("bigint").alias("bands"))
    )


def _blocks(rows: DataFrame, terms: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` of the buckets where the words may lie, as a filter the scan can use, and their number."""
    short = F.col("is_prefix") & (F.length("term") < BUCKET_CHARS)
    every = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    place = F.when(short, every).otherwise(F.array(bucket_of(F.col("term"))))
    # At most BUCKETS numbers come to the driver.
    buckets = sorted(terms.agg(F.array_distinct(F.flatten(F.collect_set(place)))).first()[0])
    return rows.filter(F.col("bucket").isin(buckets)), len(buckets)


def search_index(spark: SparkSession, at: Snapshot, queries: DataFrame, limit: int | None = None,
                 report: list | None = None) -> DataFrame:
    """As ``search`` over the facts of a snapshot, in the same order.

    With ``limit`` the bands are read from the best down, each for the queries that still
    lack facts and whose required words it holds. That is exact: a fact of a later band
    scores lower than all found before. There are at most ``len(SHARES) + 1`` bands.
    ``report`` receives, per band read, the numbers of queries and of blocks (a bucket's
    postings in a band) they may read.
    """
    facts, rows = _facts(spark, at), _postings(spark, at)
    order = [F.col("final_score").desc(), F.col("rank").desc(), *FACT]
    terms = cut_lineage(search_terms(queries))
    if limit is None:
        rows, _ = _blocks(rows, terms)
        return _found(facts, rows, queries, at).orderBy("query_id", *order)
    if limit < 1:
        raise ValueError("a limit is at least 1")
    # A query without words asks for nothing and has no row here.
    lacking = _bands_to_read(spark, at, terms).withColumn("need", F.lit(limit).cast("bigint"))
    lacking = cut_lineage(lacking)
    parts = []
    for band in range(len(at.properties["bounds"]) + 1):
        here = lacking.filter(F.col("bands").bitwiseAND(F.lit(1 << band)) != 0)
        if here.isEmpty():
            continue
        mine = queries.join(here.select("query_id"), "query_id", "left_semi")
        near, blocks = _blocks(rows, terms.join(here.select("query_id"), "query_id", "left_semi"))
        if report is not None:
            report.append({"band": band, "queries": here.count(), "blocks": blocks})
        found = _found(facts.filter(F.col("band") == band), near.filter(F.col("band") == band), mine, at)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
        first = found.withColumn("_place", place).filter(F.col("_place") <= limit)
        first = first.join(here.select("query_id", "need"), "query_id").filter("_place <= need")
        part = cut_lineage(first.select("query_id", *STORED, "rank"))
        parts.append(part)
        had = part.groupBy("query_id").agg(F.count("*").alias("had"))
        need = F.col("need") - F.coalesce("had", F.lit(0))
        lacking = lacking.join(had, "query_id", "left").withColumn("need", need).drop("had")
        lacking = cut_lineage(lacking.filter("need > 0"))
    listed = parts[0] if parts else _found(facts, rows, queries.limit(0), at)
    for part in parts[1:]:
        listed = listed.unionByName(part)
    return listed.orderBy("query_id", *order)

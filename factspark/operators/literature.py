"""Search responses: who was searched for, how often, and which articles were found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.functions.markup import first_count, xml_id_texts
from factspark.functions.paths import article_url, decode_blanks, parent_dir
from factspark.functions.strings import strip

# Fixed value: search responses lie in one folder per entity.
LIST_FOLDER = r"/raw/pubmed/article_list/([^/]+)/"


def article_list(raw: DataFrame, path: str = "source_file") -> DataFrame:
    """Search responses with ``breed`` taken from the folder they lie in."""
    folder = F.regexp_extract(path, LIST_FOLDER, 1)
    return raw.withColumn("breed", decode_blanks(folder)).drop(path)


def popularity(lists: DataFrame, source: str) -> DataFrame:
    """The summed hit counts of each entity; responses without a count add nothing."""
    return (
        lists.select("breed", first_count(F.col("payload")).alias("count"))
        .groupBy("breed")
        .agg(F.sum("count").alias("count"))
        .withColumn("source", F.lit(source))
    )


def article_ids(raw: DataFrame, path: str = "source_file") -> DataFrame:
    """One row per folder and found id, repeats kept: ``breed_group, article_id``."""
    # Plain explode would also filter on the array's size, which computes it again.
    found = F.explode_outer(xml_id_texts(F.col("payload"))).alias("article_id")
    return (
        raw.select(path, found)
        .filter(F.col("article_id").isNotNull())
        .select(
            parent_dir(F.col(path)).alias("breed_group"),
            strip(F.col("article_id")).alias("article_id"),
        )
    )


def article_requests(raw: DataFrame, out: str, path: str = "source_file") -> DataFrame:
    """The articles to fetch, one row per file they will be stored in."""
    return (
        article_ids(raw, path)
        .distinct()
        .select(
            "breed_group",
            "article_id",
            article_url(F.col("article_id")).alias("url"),
            F.concat(F.lit(out + "/"), "breed_group", F.lit("/"), "article_id", F.lit(".json"))
            .alias("target_path"),
        )
    )

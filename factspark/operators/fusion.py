"""Candidate facts and source weights to scored facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspark.operators.facts import normalize_columns
from factspark.operators.joins import lookup_join
from factspark.session import literal_table

FACT = ["breed", "fact_type", "fact_value"]

# How far each public source is trusted.
DEFAULT_WEIGHTS = [("wikipedia", 0.6), ("petmd", 0.8), ("pubmed", 0.7), ("cat-api", 0.99)]


def default_weights(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DEFAULT_WEIGHTS, "source string, weight double")


def weighted_facts(candidates: DataFrame, weights: DataFrame) -> DataFrame:
    """Candidates with their source's weight; sources without one drop out."""
    return lookup_join(candidates, weights.select("source", "weight"), ["source"]).select(
        *FACT, "weight", "source"
    )


def mentions_by_source(candidates: DataFrame, weights: DataFrame) -> DataFrame:
    """Mentions of each fact in each source."""
    return (
        weighted_facts(candidates, weights)
        .groupBy(*FACT, "source", "weight")
        .agg(F.count("*").alias("mentions_count"))
    )


def score(max_weight: Column, sources: Column, total_sources: Column, mentions: Column,
          a: float = 0.4, b: float = 0.4, c: float = 0.2) -> Column:
    """Trust in the best source, the share of sources, and a term that grows with mentions."""
    spread = 1.0 / (F.sqrt(mentions.cast("double")) + 1.0)
    return (
        F.lit(a) * max_weight
        + F.lit(b) * sources.cast("double") / total_sources
        + F.lit(c) * (F.lit(1.0) - spread)
    )


def score_facts(candidates: DataFrame, weights: DataFrame,
                a: float = 0.4, b: float = 0.4, c: float = 0.2) -> DataFrame:
    """One scored row per fact.

    After the first level a source stands once per fact, so the second level counts
    rows and needs no distinct; its lists are bounded by the number of weighted sources.
    """
    total = weights.agg(F.count("*")).scalar()
    return (
        mentions_by_source(candidates, weights)
        .groupBy(*FACT)
        .agg(
            F.sum("mentions_count").alias("mentions_count"),
            F.count("*").alias("sources_count"),
            F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("source_list"),
            F.max("weight").alias("_max_weight"),
        )
        .withColumn(
            "final_score",
            score(F.col("_max_weight"), F.col("sources_count"), total, F.col("mentions_count"),
                  a, b, c),
        )
        .drop("_max_weight")
    )


def ranked(scored: DataFrame, k: int | None = None) -> DataFrame:
    """Number the facts of each entity and type by score, ties by value; keep the first ``k``.

    With ``k`` each task keeps its own first ``k`` rows of a group before the shuffle.
    """
    best_first = Window.partitionBy("breed", "fact_type").orderBy(
        F.col("final_score").desc(), F.col("fact_value").asc()
    )
    numbered = scored.withColumn("rn", F.row_number().over(best_first))
    return numbered if k is None else numbered.filter(F.col("rn") <= k)


def fuse_facts(candidates: DataFrame, weights: DataFrame, k: int = 10, normalize: bool = False,
               a: float = 0.4, b: float = 0.4, c: float = 0.2) -> DataFrame:
    """The best ``k`` facts of each entity and type."""
    if normalize:
        candidates = normalize_columns(candidates)
    return ranked(score_facts(candidates, weights, a, b, c), k).drop("rn")

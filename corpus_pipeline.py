"""Documents to training tokens, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factspark.llm.bpe import bpe_round_trip
from factspark.llm.components import stored
from factspark.llm.mixing import mixed_rows
from factspark.llm.quality_rules import quality_filter
from factspark.llm.queries import BYTE_BPE
from factspark.llm.simhash import simhash_keep
from factspark.llm.suffix_dedup import without_repeats

#: SQL cannot express hashes, suffix arrays and merges as these stages use them.
ORACLE_SQL = None

REPEAT_BYTES, REPEAT_WORDS = 240, 50


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, two bits."""
    return simhash_keep(docs, width=3, max_distance=2)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words that occur more than once.

    240 bytes: on the tables at hand the shortest passages of 51 words have 248.
    """
    return without_repeats(docs, length=REPEAT_BYTES, over_words=REPEAT_WORDS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often, and as far, as the mix of sources takes it."""
    return mixed_rows(docs, weights=(5, 2, 1), share=1.5, most=2)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every text that is left, and the decoded text's digest."""
    return bpe_round_trip(docs, BYTE_BPE)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", near_dedup_stage),
    ("suffix_dedup", repeats_stage),
    ("source_mix", mix_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

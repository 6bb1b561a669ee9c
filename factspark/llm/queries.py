"""The llm operators over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factspark.llm.bpe import bpe_round_trip
from factspark.llm.langid import identify_languages
from factspark.llm.mixing import mix_sources
from factspark.llm.quality_classifier import classify
from factspark.llm.quality_rules import quality_verdicts
from factspark.llm.resampling import importance_resample
from factspark.llm.simhash import simhash_dedup
from factspark.llm.suffix_dedup import suffix_dedup
from factspark.llm.token_counts import token_counts
from factspark.llm.token_files import token_file_digests
from factspark.llm.topk import top_k
from factspark.llm.toxicity import score_toxicity
from factspark.llm.whitening import whiten
from factspark.plans.registry import query

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=400)


_TOPK_SQL = """
WITH e AS (SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
      FROM e q JOIN e d ON q.place <> d.place AND len(q.v) = len(d.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query(_TOPK_SQL)
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


_QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM l GROUP BY doc_id),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
places AS (SELECT DISTINCT doc_id, i + k AS p FROM again, range(0, 3) r(k)),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM places GROUP BY doc_id),
s AS (SELECT w.doc_id, t, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_capitals,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 100 * n_dup_lines <= 40 * n_lines
       AND word_chars <= 12 * n_words AND 2 * word_chars >= 5 * n_words
       AND 100 * n_capitals <= 40 * word_chars AS kept
FROM b
"""


@query(_QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"), PIECE_BPE)


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECE_BPE, limit=4096)


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)


@query()
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), width=3, max_distance=2)


@query()
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2)


@query()
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, min_words=20)


@query()
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), count=4, scale=256)

"""Queries over joins, aggregates, windows and the fact operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from factspark.operators.dictionary import name_lines
from factspark.operators.extraction import extract_facts
from factspark.operators.facts import (
    candidate_facts,
    entity_of_doc,
    normalize_candidates,
    parse_facts,
    structured_facts,
)
from factspark.operators.fusion import (
    FACT,
    fuse_facts,
    mentions_by_source,
    ranked,
    score_facts,
    weighted_facts,
)
from factspark.operators.literature import article_list, popularity
from factspark.plans import inputs as I
from factspark.plans.inputs import STRIP, oracle
from factspark.plans.registry import query
from factspark.sources.readers import flatten_breeds
from factspark.sources.writers import text_payloads

KEYS = ", ".join(FACT)


def _scored(spark, sf_dir):
    return score_facts(I.candidates(spark, sf_dir), I.weights(spark, sf_dir))


@query(oracle("cand weights", f"""
    SELECT {KEYS}, weight, source FROM cand JOIN weights USING (source)"""))
def join_weights_inner(spark, sf_dir):
    return weighted_facts(I.candidates(spark, sf_dir), I.weights(spark, sf_dir))


@query(oracle("by_source weights", """
    SELECT source, CAST(sum(mentions_count) AS BIGINT) AS mentions,
           round(sum(mentions_count) / (SELECT count(*) FROM weights), 9) AS per_source
    FROM by_source GROUP BY source"""))
def join_scalar_subquery(spark, sf_dir):
    weights = I.weights(spark, sf_dir)
    total = weights.agg(F.count("*")).scalar()
    return (
        mentions_by_source(I.candidates(spark, sf_dir), weights)
        .groupBy("source")
        .agg(F.sum("mentions_count").alias("mentions"))
        .withColumn("per_source", F.round(F.col("mentions") / total, 9))
    )


@query(oracle("by_source", f"SELECT {KEYS}, source, weight, mentions_count FROM by_source"))
def agg_mentions_by_source(spark, sf_dir):
    return mentions_by_source(I.candidates(spark, sf_dir), I.weights(spark, sf_dir))


@query(oracle("scored", f"SELECT {KEYS}, mentions_count FROM scored"))
def agg_mentions_total(spark, sf_dir):
    return _scored(spark, sf_dir).select(*FACT, "mentions_count")


@query(oracle("scored", f"SELECT {KEYS}, sources_count FROM scored"))
def agg_sources_distinct(spark, sf_dir):
    return _scored(spark, sf_dir).select(*FACT, "sources_count")


@query(oracle("scored", f"SELECT {KEYS}, source_list FROM scored"))
def agg_source_list(spark, sf_dir):
    return _scored(spark, sf_dir).select(*FACT, "source_list")


@query(oracle("scored", f"SELECT {KEYS}, max_weight FROM scored"))
def agg_max_weight(spark, sf_dir):
    by_source = mentions_by_source(I.candidates(spark, sf_dir), I.weights(spark, sf_dir))
    return by_source.groupBy(*FACT).agg(F.max("weight").alias("max_weight"))


@query(oracle("scored", f"SELECT {KEYS}, round(final_score, 9) AS final_score FROM scored"))
def agg_final_score(spark, sf_dir):
    return _scored(spark, sf_dir).select(*FACT, F.round("final_score", 9).alias("final_score"))


@query(oracle("weights", "SELECT count(*) AS n_sources FROM weights"))
def agg_source_count(spark, sf_dir):
    return I.weights(spark, sf_dir).agg(F.count("*").alias("n_sources"))


@query(oracle("lines", """
    SELECT CAST((rn - 1) // 500 AS BIGINT) AS record_no, count(*) AS n_lines,
           string_agg(line, chr(10) ORDER BY rn) AS payload
    FROM (SELECT line, row_number() OVER (ORDER BY line) AS rn FROM lines) GROUP BY ALL"""))
def agg_lines_to_payload(spark, sf_dir):
    return text_payloads(name_lines(I.breeds(spark, sf_dir)), per_record=500)


_POPULARITY = oracle("esearch_raw", """
    SELECT regexp_extract(replace(source_file, '%20', ' '), '([^/]+)/[^/]+$', 1) AS breed,
           CAST(sum(TRY_CAST(regexp_extract(payload, '<Count>(\\d+)</Count>', 1) AS BIGINT)) AS BIGINT)
               AS "count", '/processed/lists' AS source
    FROM esearch_raw GROUP BY 1""")


@query(_POPULARITY.replace(", '/processed/lists' AS source", ""))
def agg_popularity_sum(spark, sf_dir):
    return popularity(article_list(I.esearch_raw(spark, sf_dir)), "").drop("source")


@query(_POPULARITY)
def op_popularity(spark, sf_dir):
    return popularity(article_list(I.esearch_raw(spark, sf_dir)), "/processed/lists")


@query(oracle("esearch_raw", """
    SELECT payload, regexp_replace(regexp_extract(source_file,
        '/raw/pubmed/article_list/([^/]+)/', 1), '%20', ' ', 'g') AS breed FROM esearch_raw"""))
def op_article_list(spark, sf_dir):
    return article_list(I.esearch_raw(spark, sf_dir))


@query(oracle("ranked", f"SELECT {KEYS}, rn FROM ranked WHERE rn <= 10"))
def win_row_number_topk(spark, sf_dir):
    return ranked(_scored(spark, sf_dir), 10).select(*FACT, F.col("rn").cast("bigint").alias("rn"))


@query(oracle("ranked", f"""
    SELECT {KEYS}, round(final_score, 9) AS final_score FROM ranked WHERE rn <= 3"""))
def flt_rank_cut(spark, sf_dir):
    top = ranked(_scored(spark, sf_dir), 3)
    return top.select(*FACT, F.round("final_score", 9).alias("final_score"))


@query(oracle("breeds", """
    SELECT name, alt_names, origin, temperament, '/raw/parts' AS source FROM breeds"""))
def op_flatten_breeds(spark, sf_dir):
    return flatten_breeds(I.breeds_raw(spark, sf_dir), "/raw/parts").drop("generated_at")


@query(oracle("lines", "SELECT line FROM lines"))
def op_name_lines(spark, sf_dir):
    return name_lines(I.breeds(spark, sf_dir))


@query(oracle("fact_lists", """
    SELECT part_no, name AS title, array_to_string(facts, '|') AS facts FROM fact_lists"""))
def op_structured_facts(spark, sf_dir):
    docs = structured_facts(I.breeds(spark, sf_dir), F.col("part_no").cast("string"))
    return docs.select(
        F.col("source_file").cast("bigint").alias("part_no"),
        "title",
        F.array_join("extracted_facts", "|").alias("facts"),
    )


def _fact_arrays(spark, sf_dir):
    """Fact arrays whose entity stands first, late, blank, in lower case or not at all."""
    late = F.array(F.lit("ORIGIN:a"), F.concat(F.lit("BREED: "), "name", F.lit(" ")),
                   F.lit("BREED:A"))
    kind = F.col("part_no") % 5
    facts = (
        F.when(kind == 0, late)
        .when(kind == 1, F.array(F.lit("BREED: "), F.lit("BREED:A")))
        .when(kind == 2, F.array(F.concat(F.lit("breed:"), "name")))
        .when(kind == 3, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("BREED:"), "name", F.lit(":x"))))
    )
    return I.breeds(spark, sf_dir).select("part_no", facts.alias("facts"))


@query(oracle("breeds", """
    SELECT part_no, CASE part_no % 5 WHEN 0 THEN trim(name) WHEN 1 THEN ''
                                     WHEN 4 THEN trim(name || ':x') END AS entity FROM breeds"""))
def op_entity_of_doc(spark, sf_dir):
    return _fact_arrays(spark, sf_dir).select("part_no", entity_of_doc(F.col("facts")).alias("entity"))


_CANDIDATES = """
    , entity AS (SELECT doc_id, min(substr(fact, 7)) AS breed FROM doc_facts
                 WHERE fact LIKE 'BREED:%' GROUP BY doc_id),
    candidate AS (
        SELECT DISTINCT breed,
               CASE WHEN strpos(fact, '=') > 0
                    THEN 'feature_' || split_part(split_part(fact, '=', 1), ':', 2)
                    ELSE lower(split_part(fact, ':', 1)) END AS fact_type,
               CASE WHEN strpos(fact, '=') > 0 THEN split_part(fact, '=', 2)
                    ELSE split_part(fact, ':', 2) END AS fact_value,
               d.source, '{raw}/' || d.source || '/' || doc_id || '.json' AS hdfs_path
        FROM doc_facts JOIN entity USING (doc_id) JOIN documents d USING (doc_id)
        WHERE fact NOT LIKE 'BREED:%')""".replace("{raw}", I.RAW)


def extracted(spark, sf_dir):
    docs = I.doc_raw(spark, sf_dir)
    return extract_facts(docs, I.rules(spark), ["doc_id"])


@query(oracle("doc_facts", _CANDIDATES + " SELECT * FROM candidate"))
def op_candidate_facts(spark, sf_dir):
    return candidate_facts(extracted(spark, sf_dir))


_FUSED = _CANDIDATES + """,
    w AS (SELECT breed, fact_type, fact_value, source, weight, count(*) AS m
          FROM candidate JOIN weights USING (source) GROUP BY ALL),
    f AS (SELECT breed, fact_type, fact_value, CAST(sum(m) AS BIGINT) AS mentions_count,
                 count(*) AS sources_count, string_agg(source, '; ' ORDER BY source) AS source_list,
                 0.4 * max(weight) + 0.4 * count(*)::DOUBLE / (SELECT count(*) FROM weights)
                 + 0.2 * (1 - 1.0 / (sqrt(sum(m)) + 1)) AS final_score
          FROM w GROUP BY breed, fact_type, fact_value)
    SELECT breed, fact_type, fact_value, mentions_count, sources_count, source_list,
           round(final_score, 9) AS final_score FROM f
    QUALIFY row_number() OVER (PARTITION BY breed, fact_type
                               ORDER BY final_score DESC, fact_value) <= 10"""


@query(oracle("doc_facts weights", _FUSED))
def op_fuse_facts(spark, sf_dir):
    """Documents to final facts: extraction, candidates, fusion."""
    candidates = candidate_facts(extracted(spark, sf_dir))
    fused = fuse_facts(candidates, I.weights(spark, sf_dir))
    return fused.withColumn("final_score", F.round("final_score", 9))


@query(oracle("cand", f"""
    , norm AS (SELECT array_to_string(list_transform(regexp_extract_all({STRIP("breed")},
                      '([A-Za-z]+|[^A-Za-z]+)'), lambda x: upper(x[1]) || lower(x[2:])), '') AS breed,
                      upper({STRIP("fact_type")}) AS fact_type, lower({STRIP("fact_value")}) AS fact_value,
                      coalesce(lower({STRIP("source")}), 'unknown') AS source, hdfs_path FROM cand)
    SELECT breed, fact_type, fact_value, source, min(hdfs_path) AS hdfs_path
    FROM norm GROUP BY ALL"""))
def op_normalize_candidates(spark, sf_dir):
    return normalize_candidates(I.candidates(spark, sf_dir), ["hdfs_path"])


@query(oracle("structured", f"""
    , entity AS (SELECT part_no, name AS breed FROM structured WHERE fact LIKE 'BREED:%' GROUP BY ALL)
    SELECT part_no, breed, lower(split_part(fact, ':', 1)) AS fact_type,
           {STRIP("split_part(fact, ':', 2)")} AS fact_value
    FROM structured JOIN entity USING (part_no) WHERE fact NOT LIKE 'BREED:%'
    AND {STRIP("split_part(fact, ':', 2)")} <> ''"""))
def udtf_row_to_facts(spark, sf_dir):
    docs = structured_facts(I.breeds(spark, sf_dir), F.col("part_no").cast("string"))
    rows = docs.select(
        F.col("source_file").cast("bigint").alias("part_no"),
        entity_of_doc(F.col("extracted_facts")).alias("breed"),
        F.explode("extracted_facts").alias("fact"),
    ).filter(F.length("breed") > 0)
    return parse_facts(rows).drop("fact")

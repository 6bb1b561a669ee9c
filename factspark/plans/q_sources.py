"""Queries over readers and writers: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from factspark.functions.paths import decode_blanks, parent_dir
from factspark.operators.dictionary import name_lines, payload_lines
from factspark.operators.facts import candidate_facts, structured_facts
from factspark.operators.fusion import DEFAULT_WEIGHTS, default_weights, fuse_facts
from factspark.operators.quality import duplicate_keys, null_counts
from factspark.plans import inputs as I
from factspark.plans.inputs import oracle, table
from factspark.plans.registry import query
from factspark.schemas import (
    ARTICLE_RAW,
    BREEDS_RAW,
    EXTRACTED,
    NAMES_RAW,
    PAGE_RAW,
)
from factspark.session import fresh_path
from factspark.sources.readers import (
    flatten_payload,
    read_json,
    read_parquet,
    read_table,
    require_columns,
)
from factspark.sources.snapshots import publish_rows, read_rows
from factspark.sources.writers import (
    dense_ids,
    overwrite_json,
    overwrite_parquet,
    replace_folder,
    write_counted,
    write_json_lists,
    write_text_envelopes,
)

BREED_FIELDS = "name, alt_names, origin, temperament"


@query(oracle("breeds", f"SELECT {BREED_FIELDS} FROM breeds"))
def src_json_lines(spark, sf_dir):
    path = fresh_path(spark, "breeds")
    overwrite_json(I.breeds_raw(spark, sf_dir), path)
    return flatten_payload(read_json(spark, path, BREEDS_RAW))


@query("SELECT url, md5(html) AS content_hash FROM pages")
def src_json_multiline(spark, sf_dir):
    path = fresh_path(spark, "pages")
    write_json_lists(table(spark, sf_dir, "pages").select(F.col("html").alias("content"), "url"), path)
    pages = read_json(spark, path, PAGE_RAW, multiline=True)
    return pages.select("url", F.md5("content").alias("content_hash"))


@query("""
    SELECT 'doc-' || doc_id AS title, CAST(NULL AS VARCHAR) AS url,
           CAST(NULL AS VARCHAR) AS content_hash, md5(text) AS payload_hash FROM documents
    UNION ALL SELECT NULL, url, md5(html), NULL FROM pages""")
def src_multi_glob_merge(spark, sf_dir):
    base = fresh_path(spark, "mixed")
    docs = I.doc_raw(spark, sf_dir).select("title", F.col("text").alias("payload"))
    overwrite_json(docs, f"{base}/api/docs")
    overwrite_json(I.page_raw(spark, sf_dir).select("content", "url"), f"{base}/web/pages")
    both = read_json(spark, [f"{base}/api/*/*.json", f"{base}/web/*/*.json"], ARTICLE_RAW)
    return both.select(
        "title",
        "url",
        F.md5("content").alias("content_hash"),
        F.md5("payload").alias("payload_hash"),
    )


@query("""
    SELECT 'o_orderpriority=' || o_orderpriority AS folder, count(*) AS n_records
    FROM orders GROUP BY ALL""")
def src_dir_glob(spark, sf_dir):
    path = fresh_path(spark, "lists")
    table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey").write.partitionBy(
        "o_orderpriority"
    ).json(path)
    found = read_json(spark, f"{path}/*/*.json", "o_orderkey bigint", provenance="source_file")
    folder = decode_blanks(parent_dir(F.col("source_file")))
    return found.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_records"))


@query("""
    SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS n_records,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM orders GROUP BY ALL""")
def src_recursive_json(spark, sf_dir):
    path = fresh_path(spark, "tree")
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    orders.write.partitionBy("o_orderpriority", "o_orderstatus").json(path)
    orders.select("o_orderstatus").write.text(f"{path}/notes")  # not .json, so not read
    found = read_json(
        spark, path, "o_orderkey bigint", recursive=True, provenance="source_file"
    )
    return found.groupBy(parent_dir(F.col("source_file")).alias("folder")).agg(
        F.count("*").alias("n_records"), F.sum("o_orderkey").alias("key_sum")
    )


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/customer.parquet")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_table(spark, sf_dir):
    table(spark, sf_dir, "supplier").createOrReplaceTempView("factspark_supplier_rows")
    return read_table(spark, "factspark_supplier_rows")


_NAMED_SOURCE = f"([{', '.join(repr(s) for s, _ in DEFAULT_WEIGHTS)}])"


@query(f"""
    SELECT w.source, w.weight, count(*) AS n_documents
    FROM documents JOIN ({I._values([(s, '#') for s, _ in DEFAULT_WEIGHTS])}) AS v(source, mark)
        ON v.source = {_NAMED_SOURCE}[doc_id % 4 + 1]
    JOIN (VALUES {', '.join(f"('{s}', CAST({w} AS DOUBLE))" for s, w in DEFAULT_WEIGHTS)})
        AS w(source, weight) ON w.source = v.source
    GROUP BY ALL""")
def src_literal_values(spark, sf_dir):
    names = F.array(*[F.lit(s) for s, _ in DEFAULT_WEIGHTS])
    source = F.get(names, (F.col("doc_id") % 4).cast("int"))
    counted = (
        table(spark, sf_dir, "documents")
        .groupBy(source.alias("source"))
        .agg(F.count("*").alias("n_documents"))
    )
    return default_weights(spark).join(counted, "source")


@query("SELECT doc_id, 'source=' || source AS folder FROM documents")
def src_file_provenance(spark, sf_dir):
    path = fresh_path(spark, "by-source")
    overwrite_parquet(
        table(spark, sf_dir, "documents").select("doc_id", "source"), path, ["source"]
    )
    found = read_parquet(spark, path, provenance="source_file")
    return found.select("doc_id", parent_dir(F.col("source_file")).alias("folder"))


@query("SELECT page_id, url FROM pages")
def src_input_guard(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumnRenamed("html", "content")
    checked = require_columns(pages, all_of=["url"], any_of=["content", "payload"])
    return checked.select("page_id", "url")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_parquet_overwrite(spark, sf_dir):
    path = fresh_path(spark, "replaced")
    overwrite_parquet(table(spark, sf_dir, "customer"), path)
    overwrite_parquet(table(spark, sf_dir, "supplier"), path)
    return read_parquet(spark, path)


@query(oracle("fact_lists", """
    SELECT name AS title, 'breeds.json' AS source_file, array_to_string(facts, '|') AS facts,
           len(facts) AS n_facts FROM fact_lists"""))
def sink_json_overwrite(spark, sf_dir):
    path = fresh_path(spark, "extracted")
    overwrite_json(structured_facts(I.breeds(spark, sf_dir), "breeds.json"), path)
    back = read_json(spark, path, EXTRACTED)
    return back.select(
        "title",
        "source_file",
        F.array_join("extracted_facts", "|").alias("facts"),
        F.size("extracted_facts").cast("bigint").alias("n_facts"),
    )


@query(oracle("lines", """
    SELECT 'parts' AS source, 'txt' AS content_type, CAST((rn - 1) // 500 AS BIGINT) AS record_no,
           CAST((rn - 1) % 500 AS BIGINT) AS place, line
    FROM (SELECT line, row_number() OVER (ORDER BY line) AS rn FROM lines)"""))
def sink_text_envelope(spark, sf_dir):
    path = fresh_path(spark, "names")
    write_text_envelopes(name_lines(I.breeds(spark, sf_dir)), path, "parts", per_record=500)
    back = read_json(spark, path, NAMES_RAW)
    lines = back.select("source", "content_type", "record_no", F.posexplode(F.split("payload", "\n")))
    return lines.select(
        "source", "content_type", "record_no", F.col("pos").cast("bigint").alias("place"),
        F.col("col").alias("line"),
    )


_API_CANDIDATES = oracle("structured", """
    , entity AS (SELECT part_no, name AS breed FROM structured
                 WHERE fact LIKE 'BREED:%' GROUP BY ALL)
    SELECT DISTINCT breed, lower(split_part(fact, ':', 1)) AS fact_type,
           trim(substr(fact, strpos(fact, ':') + 1)) AS fact_value,
           'cat-api' AS source, 'hdfs://nn:9000/raw/cat-api/breeds.json' AS hdfs_path
    FROM structured JOIN entity USING (part_no)
    WHERE fact NOT LIKE 'BREED:%' AND trim(substr(fact, strpos(fact, ':') + 1)) <> ''""")


def _api_facts(spark, sf_dir):
    return structured_facts(I.breeds(spark, sf_dir), f"{I.RAW}/cat-api/breeds.json")


@query(_API_CANDIDATES)
def sink_truncate_insert(spark, sf_dir):
    path = fresh_path(spark, "candidates")
    replace_folder(table(spark, sf_dir, "nation"), path)
    replace_folder(candidate_facts(_api_facts(spark, sf_dir)), path)
    return read_parquet(spark, path)


@query(_API_CANDIDATES)
def sink_snapshot_refresh(spark, sf_dir):
    """A whole refresh by manifest, over older rows that a pinned reader still sees."""
    path = fresh_path(spark, "candidates")
    older = publish_rows(table(spark, sf_dir, "nation"), path)
    publish_rows(candidate_facts(_api_facts(spark, sf_dir)), path)
    assert read_rows(spark, older).columns == table(spark, sf_dir, "nation").columns
    return read_rows(spark, path)


@query(oracle("fused", """
    SELECT breed, fact_type, fact_value, mentions_count, sources_count, source_list,
           round(final_score, 9) AS final_score FROM fused"""))
def sink_insert_select(spark, sf_dir):
    path = fresh_path(spark, "final")
    fuse_facts(I.candidates(spark, sf_dir), I.weights(spark, sf_dir)).createOrReplaceTempView(
        "factspark_new_facts"
    )
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet SELECT * FROM factspark_new_facts")
    return read_parquet(spark, path).withColumn("final_score", F.round("final_score", 9))


@query("SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id, o_orderkey FROM orders")
def sink_surrogate_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return dense_ids(orders, ["o_custkey", "o_orderkey"]).select("id", "o_orderkey")


@query(oracle("breeds", """
    SELECT count_if(name IS NULL) AS name, count_if(alt_names IS NULL) AS alt_names,
           count_if(origin IS NULL) AS origin, count_if(temperament IS NULL) AS temperament
    FROM breeds"""))
def chk_not_null(spark, sf_dir):
    return null_counts(I.breeds(spark, sf_dir), ["name", "alt_names", "origin", "temperament"])


@query("""
    SELECT event_type, user_id, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1""")
def chk_unique_key(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query("""
    SELECT event_type, count(*) AS n_rows, (SELECT count(*) FROM events) AS n_written
    FROM events GROUP BY ALL""")
def act_preview_count(spark, sf_dir):
    path = fresh_path(spark, "events")
    written, _ = write_counted(table(spark, sf_dir, "events"), path, preview=20)
    return (
        read_parquet(spark, path)
        .groupBy("event_type")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("n_written", F.lit(written).cast("bigint"))
    )

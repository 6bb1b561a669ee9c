"""Queries over projections, filters, dedup, unions and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from factspark.functions import markup as M
from factspark.functions import paths as P
from factspark.functions import strings as S
from factspark.operators.crawl import CATEGORY_TALK, TALK, listing_items
from factspark.operators.dedup import keep_first, last_write_wins
from factspark.operators.dictionary import (
    STATIC_PATTERNS,
    all_patterns,
    build_dictionary,
    name_lines,
    payload_lines,
    static_patterns,
    usable_lines,
)
from factspark.operators.extraction import gazetteer_match, lower_tokens
from factspark.operators.facts import (
    CANDIDATE_COLUMNS,
    document_entities,
    has_text,
    parse_facts,
    structured_facts,
)
from factspark.operators.fusion import score
from factspark.plans import inputs as I
from factspark.plans.inputs import STRIP, TOKENS, oracle, table
from factspark.plans.registry import query
from factspark.sources.readers import (
    flatten_breeds,
    flatten_payload,
    title_or_url,
    unify_text,
    union_corpora,
)
from factspark.sources.writers import preview

BREED_FIELDS = "name, alt_names, origin, temperament"


# Projections and filters


@query(oracle("breeds", f"SELECT {BREED_FIELDS} FROM breeds"))
def prj_explode_struct(spark, sf_dir):
    return flatten_payload(I.breeds_raw(spark, sf_dir))


@query(oracle("breeds", f"SELECT {BREED_FIELDS}, '/raw/parts' AS source, 1 AS stamped FROM breeds"))
def prj_lineage_cols(spark, sf_dir):
    flat = flatten_breeds(I.breeds_raw(spark, sf_dir), "/raw/parts")
    return flat.withColumn("stamped", F.col("generated_at").isNotNull().cast("int")).drop(
        "generated_at"
    )


@query(oracle("doc_raw", "SELECT title, source_file FROM doc_raw"))
def prj_select(spark, sf_dir):
    return I.doc_raw(spark, sf_dir).select("title", "source_file")


def _mixed(spark, sf_dir):
    docs = I.doc_raw(spark, sf_dir).select(
        "title", F.col("text").alias("payload"), "source_file"
    )
    return union_corpora(docs, I.page_raw(spark, sf_dir))


@query(oracle("doc_raw page_raw", """
    SELECT source_file, md5(text) AS text_hash FROM doc_raw
    UNION ALL SELECT source_file, md5(content) FROM page_raw"""))
def prj_unify_text(spark, sf_dir):
    unified = unify_text(_mixed(spark, sf_dir))
    return unified.select("source_file", F.md5("text").alias("text_hash"))


@query(oracle("doc_raw page_raw", """
    SELECT source_file, title AS kept, title AS filled, CAST(NULL AS VARCHAR) AS renamed FROM doc_raw
    UNION ALL SELECT source_file, NULL, url, url FROM page_raw"""))
def prj_title_fallback(spark, sf_dir):
    mixed = _mixed(spark, sf_dir)
    kept = title_or_url(mixed).select("*", F.col("title").alias("kept"))
    filled = title_or_url(kept, row_level=True).withColumnRenamed("title", "filled")
    no_title = title_or_url(filled.drop("title"))
    return no_title.select("source_file", "kept", "filled", F.col("title").alias("renamed"))


@query(oracle("lines", f"""
    SELECT line FROM lines WHERE {STRIP("line")} <> ''
    AND {STRIP("split_part(line, ',', 1)")} <> ''"""))
def flt_nonempty_lines(spark, sf_dir):
    return usable_lines(name_lines(I.breeds(spark, sf_dir)))


@query(oracle("breeds", """
    SELECT part_no, name, alt_names, origin FROM breeds
    WHERE name IS NOT NULL AND alt_names IS NOT NULL AND origin IS NOT NULL"""))
def flt_dropna_subset(spark, sf_dir):
    kept = I.breeds(spark, sf_dir).na.drop(subset=["name", "alt_names", "origin"])
    return kept.select("part_no", "name", "alt_names", "origin")


@query(oracle("breeds", f"""
    SELECT part_no, coalesce(lower({STRIP("origin")}), 'unknown') AS source FROM breeds"""))
def prj_fill_unknown(spark, sf_dir):
    source = F.coalesce(F.lower(S.strip(F.col("origin"))), F.lit(P.UNKNOWN_SOURCE))
    return I.breeds(spark, sf_dir).select("part_no", source.alias("source"))


@query(oracle("breeds", """
    SELECT part_no, concat_ws('|', CASE WHEN name <> '' THEN 'BREED:' || name END,
                              CASE WHEN alt_names <> '' THEN 'ALSO:' || alt_names END) AS facts
    FROM breeds"""))
def flt_falsy_guard(spark, sf_dir):
    name, other = F.col("name"), F.col("alt_names")
    facts = S.array_where(
        (has_text(name), S.tag("BREED", name)), (has_text(other), S.tag("ALSO", other))
    )
    return I.breeds(spark, sf_dir).select("part_no", F.array_join(facts, "|").alias("facts"))


@query(oracle("breeds", """
    SELECT name AS breed, 'parts' AS source, '/raw/parts/' || part_no AS hdfs_path
    FROM breeds WHERE name <> ''"""))
def flt_has_entity(spark, sf_dir):
    path = F.concat(F.lit("/raw/parts/"), "part_no")
    docs = structured_facts(I.breeds(spark, sf_dir), path)
    return document_entities(docs).drop("extracted_facts")


_PARSED = f"""
    , split AS (SELECT p_partkey, fact, upper({STRIP("split_part(fact, ':', 1)")}) AS prefix,
                       {STRIP("substr(fact, strpos(fact, ':') + 1)")} AS value
                FROM raw_facts WHERE strpos(fact, ':') > 0),
    parsed AS (SELECT p_partkey, fact,
        CASE WHEN prefix = 'FEATURE' AND strpos(value, '=') > 0
             THEN 'feature_' || lower({STRIP("split_part(value, '=', 1)")})
             ELSE lower(prefix) END AS fact_type,
        CASE WHEN prefix = 'FEATURE' AND strpos(value, '=') > 0
             THEN {STRIP("substr(value, strpos(value, '=') + 1)")} ELSE value END AS fact_value
        FROM split WHERE prefix <> 'BREED')"""


@query(oracle("raw_facts", _PARSED + " SELECT p_partkey, fact FROM parsed WHERE fact_value <> ''"))
def flt_valid_fact(spark, sf_dir):
    return parse_facts(I.raw_facts(spark, sf_dir)).select("p_partkey", "fact")


@query(oracle("raw_facts", _PARSED + """
    SELECT p_partkey, fact_type, fact_value FROM parsed WHERE fact_value <> ''"""))
def op_parse_fact(spark, sf_dir):
    return parse_facts(I.raw_facts(spark, sf_dir)).drop("fact")


@query(oracle("members", f"""
    SELECT title, CAST(ns = {CATEGORY_TALK} AS INT) AS is_category FROM members
    WHERE ns = {TALK} OR ns = {CATEGORY_TALK}"""))
def flt_namespace(spark, sf_dir):
    talk = I.members_raw(spark, sf_dir).filter(F.col("ns").isin(TALK, CATEGORY_TALK))
    return talk.select("title", (F.col("ns") == CATEGORY_TALK).cast("int").alias("is_category"))


# Dedup


@query(oracle("cand", f"SELECT DISTINCT {', '.join(CANDIDATE_COLUMNS)} FROM cand"))
def ddp_all_columns(spark, sf_dir):
    return I.candidates(spark, sf_dir).dropDuplicates(CANDIDATE_COLUMNS)


@query("""
    SELECT event_type, user_id, event_id, value FROM
    (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn
     FROM events) WHERE rn = 1""")
def ddp_subset_keep_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "value")
    return keep_first(events, ["event_type", "user_id"], ["event_id"])


@query(oracle("refetch_log", """
    SELECT path, event_id, payload FROM
    (SELECT *, row_number() OVER (PARTITION BY path ORDER BY fetched_at DESC, event_id DESC) AS rn
     FROM refetch_log) WHERE rn = 1"""))
def ddp_last_write_wins(spark, sf_dir):
    log = I.refetch_log(spark, sf_dir)
    return last_write_wins(log, ["path"], ["fetched_at", "event_id"]).drop("fetched_at")


@query(f"""
    SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_transform(
        {TOKENS("text")}, lambda x: lower(x)))), ' ') AS words FROM conversations""")
def ddp_array_set(spark, sf_dir):
    words = S.sorted_set(lower_tokens(F.col("text")))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(words, " ").alias("words")
    )


# Limits and unions


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20")
def lim_preview(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return preview(customers, ["c_acctbal", "c_custkey"], 20)


@query(oracle("doc_raw page_raw", """
    SELECT title, md5(text) AS payload_hash, NULL AS content_hash, source_file FROM doc_raw
    UNION ALL SELECT NULL, NULL, md5(content), source_file FROM page_raw"""))
def set_union_corpora(spark, sf_dir):
    return _mixed(spark, sf_dir).select(
        "title",
        F.md5("payload").alias("payload_hash"),
        F.md5("content").alias("content_hash"),
        "source_file",
    )


@query(oracle("structured matched", """
    SELECT 'BREED:' || canonical AS fact, 'text' AS feed, count(*) AS n FROM matched
    WHERE label = 'BREED' GROUP BY ALL
    UNION ALL SELECT fact, 'api', count(*) FROM structured GROUP BY ALL"""))
def set_union_fact_feeds(spark, sf_dir):
    matches = gazetteer_match(I.doc_raw(spark, sf_dir), I.dictionary(spark))
    text = matches.filter(F.col("label") == "BREED").select("fact", F.lit("text").alias("feed"))
    api = structured_facts(I.breeds(spark, sf_dir), "parts").select(
        F.explode("extracted_facts").alias("fact"), F.lit("api").alias("feed")
    )
    return union_corpora(text, api).groupBy("fact", "feed").agg(F.count("*").alias("n"))


_DICTIONARY = f"""
    , parts AS (SELECT row_number() OVER () AS line_no, list_transform(string_split(line, ','),
                    lambda x: {STRIP("x")}) AS parts FROM lines),
    entities AS (SELECT 'BREED' AS label, canonical, unnest(aliases) AS alias FROM
        (SELECT parts[1] AS canonical, list_distinct(list_filter(parts, lambda x: x <> '')) AS aliases
         FROM parts WHERE parts[1] <> ''))"""
_STATIC = f"SELECT * FROM ({I._values(STATIC_PATTERNS)}) AS v(label, canonical, alias)"


@query(oracle("lines", _DICTIONARY + """
    SELECT label, canonical, alias,
           array_to_string(string_split_regex(lower(alias), '\\s+'), ' ') AS words,
           len(string_split_regex(lower(alias), '\\s+'))::INT AS n FROM entities"""))
def op_build_dictionary(spark, sf_dir):
    built = build_dictionary(name_lines(I.breeds(spark, sf_dir)), "BREED")
    return built.withColumn("words", F.array_join("toks", " ")).drop("toks")


@query(oracle("lines", _DICTIONARY + f" SELECT * FROM entities UNION ALL {_STATIC}"))
def set_union_patterns(spark, sf_dir):
    entities = build_dictionary(name_lines(I.breeds(spark, sf_dir)), "BREED")
    return all_patterns(entities, static_patterns(spark)).select("label", "canonical", "alias")


# Scalar functions


@query(oracle("breeds", "SELECT part_no, concat_ws(', ', name, alt_names) AS line FROM breeds"))
def fn_concat_ws(spark, sf_dir):
    line = F.concat_ws(", ", "name", "alt_names")
    return I.breeds(spark, sf_dir).select("part_no", line.alias("line"))


@query(oracle("breeds", """
    SELECT part_no, coalesce(name, '') || ' ' || coalesce(alt_names, '') || ' '
           || coalesce(origin, '') || ' ' || coalesce(temperament, '') AS text FROM breeds"""))
def fn_concat_coalesce(spark, sf_dir):
    text = S.concat_or_empty(*[F.col(c) for c in BREED_FIELDS.split(", ")])
    return I.breeds(spark, sf_dir).select("part_no", text.alias("text"))


@query("SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def fn_split_explode(spark, sf_dir):
    docs = I.doc_raw(spark, sf_dir).withColumnRenamed("text", "payload")
    return payload_lines(docs)


@query(oracle("breeds", f"""
    SELECT part_no,
           array_to_string(list_transform(string_split(temperament, ', '), lambda x: {STRIP("x")}),
                           '|') AS by_comma_blank,
           array_to_string(list_transform(string_split(alt_names, ','), lambda x: {STRIP("x")}),
                           '|') AS by_comma
    FROM breeds"""))
def fn_split_list(spark, sf_dir):
    return I.breeds(spark, sf_dir).select(
        "part_no",
        F.array_join(S.split_strip(F.col("temperament"), ", "), "|").alias("by_comma_blank"),
        F.array_join(S.split_strip(F.col("alt_names"), ","), "|").alias("by_comma"),
    )


@query(oracle("raw_facts", """
    SELECT p_partkey, split_part(fact, ':', 1) AS before,
           CASE WHEN strpos(fact, ':') > 0 THEN substr(fact, strpos(fact, ':') + 1) END AS after
    FROM raw_facts"""))
def fn_split_first(spark, sf_dir):
    fact = F.col("fact")
    return I.raw_facts(spark, sf_dir).select(
        "p_partkey", S.before_first(fact, ":").alias("before"), S.after_first(fact, ":").alias("after")
    )


@query(f"""
    SELECT p_partkey, {STRIP("chr(160) || chr(9) || p_name || ' ' || chr(8195) || chr(10)")} AS stripped,
           {STRIP("chr(12288) || p_type || chr(133) || 'x' || chr(8232)")} AS inner_kept FROM part""")
def fn_strip(spark, sf_dir):
    padded = F.concat(F.lit("\xa0\t"), "p_name", F.lit(" \u2003\n"))
    inner = F.concat(F.lit("\u3000"), "p_type", F.lit("\x85x\u2028"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", S.strip(padded).alias("stripped"), S.strip(inner).alias("inner_kept")
    )


@query("SELECT conv_id, turn, lower(text) AS low, upper(role) AS up FROM conversations")
def fn_case(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.lower("text").alias("low"), F.upper("role").alias("up")
    )


@query("""
    SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(
        replace(p_name, ' ', '-') || ' ' || p_brand || 'X2y o''NEIL', '([A-Za-z]+|[^A-Za-z]+)'),
        lambda x: upper(x[1]) || lower(x[2:])), '') AS title FROM part""")
def fn_title_case(spark, sf_dir):
    text = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" "), "p_brand", F.lit("X2y o'NEIL")
    )
    return table(spark, sf_dir, "part").select("p_partkey", S.title_case(text).alias("title"))


@query(oracle("structured", """
    SELECT part_no, fact, CAST(starts_with(fact, 'BREED:') AS INT) AS is_breed,
           substr(fact, 7) AS rest FROM structured"""))
def fn_prefix(spark, sf_dir):
    part_no = F.col("part_no").cast("string")
    facts = structured_facts(I.breeds(spark, sf_dir), part_no).select(
        F.col("source_file").cast("bigint").alias("part_no"),
        F.explode("extracted_facts").alias("fact"),
    )
    return facts.select(
        "part_no",
        "fact",
        F.col("fact").startswith("BREED:").cast("int").alias("is_breed"),
        S.without_prefix(F.col("fact"), "BREED:").alias("rest"),
    )


@query("""
    SELECT page_id, replace(url, '/', '_') AS safe, lower(replace(url, 'e', '+')) AS plus,
           replace(url, '-', ' ') AS words FROM pages""")
def fn_replace(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        P.safe_file_name(url).alias("safe"),
        P.search_term(F.replace(url, F.lit("e"), F.lit(" "))).alias("plus"),
        F.replace(url, F.lit("-"), F.lit(" ")).alias("words"),
    )


@query(oracle("esearch_raw", """
    SELECT source_file, regexp_extract(payload, '<Count>(\\d+)</Count>', 1) AS first_count,
           regexp_extract(source_file, '/raw/pubmed/article_list/([^/]+)/', 1) AS folder
    FROM esearch_raw"""))
def fn_regexp_extract(spark, sf_dir):
    return I.esearch_raw(spark, sf_dir).select(
        "source_file",
        F.regexp_extract("payload", r"<Count>(\d+)</Count>", 1).alias("first_count"),
        F.regexp_extract("source_file", r"/raw/pubmed/article_list/([^/]+)/", 1).alias("folder"),
    )


@query(oracle("esearch_raw", "SELECT replace(source_file, '%20', ' ') AS path FROM esearch_raw"))
def fn_regexp_replace(spark, sf_dir):
    return I.esearch_raw(spark, sf_dir).select(P.decode_blanks(F.col("source_file")).alias("path"))


@query("""
    SELECT 'p' || page_id AS id, CAST(regexp_matches(html, '<[^>]+>') AS INT) AS tagged FROM pages
    UNION ALL SELECT 'd' || doc_id, CAST(regexp_matches(text, '<[^>]+>') AS INT) FROM documents""")
def fn_regexp_test(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text")
    )
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), "text"
    )
    return pages.union(docs).select("id", M.has_tag(F.col("text")).cast("int").alias("tagged"))


@query("""
    SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k,
           TRY_CAST(regexp_extract(event_type, '(\\d+)', 1) AS BIGINT) AS missing FROM events""")
def fn_safe_cast_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.first_int(F.col("props"), r'"k": (\d+)').alias("k"),
        S.first_int(F.col("event_type"), r"(\d+)").alias("missing"),
    )


@query(oracle("breeds", """
    SELECT part_no, coalesce(alt_names, origin, temperament, 'none') AS first_value,
           coalesce(nullif(alt_names, ''), nullif(origin, ''), 'none') AS first_text FROM breeds"""))
def fn_coalesce(spark, sf_dir):
    first_value = F.coalesce("alt_names", "origin", "temperament", F.lit("none"))
    first_text = S.first_present(F.col("alt_names"), F.col("origin"), default="none")
    return I.breeds(spark, sf_dir).select(
        "part_no", first_value.alias("first_value"), first_text.alias("first_text")
    )


_EXPLICIT = "CASE WHEN doc_id % 7 = 0 THEN ' PubMed ' WHEN doc_id % 7 = 1 THEN '  ' END"
_ODD_PATH = """CASE doc_id % 5 WHEN 0 THEN source_file WHEN 1 THEN '/RAW//' || title || '.json'
               WHEN 2 THEN '/processed/' || title WHEN 3 THEN '/a/raw/b/raw/' || title END"""


@query(oracle("doc_raw", f"""
    , odd AS (SELECT doc_id, {_ODD_PATH} AS path, {_EXPLICIT} AS explicit FROM doc_raw)
    SELECT doc_id, coalesce(nullif(lower({STRIP("explicit")}), ''),
        {STRIP("nullif(regexp_extract(lower(path), '/raw/+([^/]+)', 1), '')")}, 'unknown') AS source
    FROM odd"""))
def fn_path_source(spark, sf_dir):
    docs = I.doc_raw(spark, sf_dir).select(
        "doc_id", F.expr(_ODD_PATH).alias("path"),
        F.expr(_EXPLICIT).alias("explicit"),
    )
    source = P.path_source(F.col("path"), F.col("explicit"))
    return docs.select("doc_id", source.alias("source"))


@query(oracle("esearch_raw", """
    SELECT source_file, regexp_extract(source_file, '([^/]+)/[^/]+$', 1) AS folder FROM esearch_raw"""))
def fn_path_group(spark, sf_dir):
    return I.esearch_raw(spark, sf_dir).select(
        "source_file", P.parent_dir(F.col("source_file")).alias("folder")
    )


@query("""
    SELECT page_id, regexp_extract(rtrim(url || '/', '/'), '([^/]+)$', 1) AS slug,
           '/raw/p/' || regexp_extract(rtrim(url, '/'), '([^/]+)$', 1) || '.json' AS target FROM pages""")
def fn_url_slug(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        P.url_slug(F.concat(url, F.lit("/"))).alias("slug"),
        P.slug_file(url, "/raw/p/").alias("target"),
    )


@query(f"""
    SELECT p_partkey, '{P.EUTILS}esearch.fcgi?db=pubmed&term=' || lower(replace(p_name, ' ', '+'))
               || '+AND+cat&retmax=9999' AS search_url,
           '{P.EUTILS}efetch.fcgi?db=pubmed&id=' || p_partkey || '&retmode=xml' AS article_url,
           'https://en.wikipedia.org/wiki/' || p_name AS wiki_url FROM part""")
def fn_url_build(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        P.search_url(P.search_term(F.col("p_name"))).alias("search_url"),
        P.article_url(F.col("p_partkey").cast("string")).alias("article_url"),
        P.wiki_url(F.col("p_name")).alias("wiki_url"),
    )


@query(oracle("listing_links", "SELECT url, link FROM listing_links"))
def fn_json_path(spark, sf_dir):
    return listing_items(I.listing_raw(spark, sf_dir))


@query("""
    SELECT o_orderkey || '|' || o_custkey AS ids, count(*) AS n FROM orders GROUP BY ALL""")
def fn_xml_ids(spark, sf_dir):
    ids = M.xml_ids(F.col("payload"))
    return (
        I.esearch_raw(spark, sf_dir)
        .groupBy(F.array_join(ids, "|").alias("ids"))
        .agg(F.count("*").alias("n"))
    )


@query("""
    SELECT p_partkey, to_json({'name': p_name, 'size': p_size, 'tags': [p_brand, p_type]}) AS record
    FROM part""")
def fn_json_encode(spark, sf_dir):
    record = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_size").alias("size"),
        F.array("p_brand", "p_type").alias("tags"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.to_json(record).alias("record"))


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, epoch(date_trunc('second', ts))::BIGINT AS back
    FROM events""")
def fn_timestamp_format(spark, sf_dir):
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id",
        plain.alias("plain"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
        F.unix_timestamp(F.to_timestamp(plain, "yyyy-MM-dd HH:mm:ss")).alias("back"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, round(0.4 * l_discount + 0.4 * l_linenumber / 7.0
           + 0.2 * (1 - 1.0 / (sqrt(l_quantity) + 1)), 9) AS score FROM lineitem""")
def fn_math_score(spark, sf_dir):
    value = score(F.col("l_discount"), F.col("l_linenumber"), F.lit(7.0), F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(value, 9).alias("score")
    )


@query("""
    SELECT p_partkey, 'TYPE:' || p_type AS plain, 'FEATURE:' || p_brand || '=' || p_name AS feature
    FROM part""")
def fn_tag_build(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        S.tag("TYPE", F.col("p_type")).alias("plain"),
        S.feature_tag(F.col("p_brand"), F.col("p_name")).alias("feature"),
    )

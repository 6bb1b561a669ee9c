"""Queries over text extraction, stored crawl records and search."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from factspark.functions.markup import html_to_text
from factspark.functions.paths import EUTILS
from factspark.operators import crawl
from factspark.operators.dictionary import name_lines
from factspark.operators.extraction import (
    document_facts,
    extract_facts,
    gazetteer_hits,
    gazetteer_match,
    guarded_text,
    token_rows,
    word_facts,
)
from factspark.operators.facts import candidate_facts, structured_facts
from factspark.operators.fusion import FACT, default_weights, fuse_facts
from factspark.operators.literature import article_requests
from factspark.operators.search import (
    match,
    matching_postings,
    postings,
    query_terms,
    read_postings,
    search,
    write_postings,
)
from factspark.operators.search_index import build_index, refresh_index, search_index
from factspark.plans import inputs as I
from factspark.plans.inputs import STRIP, oracle, table
from factspark.plans.q_facts import extracted
from factspark.plans.registry import query
from factspark.session import cut_lineage, fresh_path
from factspark.sources.readers import read_json, title_or_url, unify_text
from factspark.sources.writers import overwrite_json

KEYS = ", ".join(FACT)


# Text extraction


@query("""
    SELECT page_id, CASE WHEN page_id % 3 = 1 THEN NULL WHEN page_id % 3 = 0 THEN length(html) END
        AS n_chars FROM pages""")
def txt_null_guard(spark, sf_dir):
    page = F.col("page_id")
    text = F.when(page % 3 == 1, "").when(page % 3 == 0, F.col("html"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.length(guarded_text(text)).cast("bigint").alias("n_chars")
    )


_NOT_TEXT = (
    r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|</?[a-z][^>]*>|<![^>]*>"
)
_ENTITIES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"),
             ("&nbsp;", "\xa0"), ("&amp;", "&")]
_TEXT = f"regexp_replace(html, '{_NOT_TEXT}', ' ', 'g')"
for _entity, _char in _ENTITIES:
    _TEXT = f"replace({_TEXT}, '{_entity}', '{_char}')"


@query(f"""
    SELECT page_id, {STRIP(f"regexp_replace({_TEXT}, '[ \\t\\r\\n\\x{{a0}}]+', ' ', 'g')")} AS text
    FROM pages""")
def txt_html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", html_to_text(F.col("html")).alias("text")
    )


@query(oracle("tok0", "SELECT doc_id, pos, raw, lower(raw) AS token FROM tok0"))
def txt_tokenize(spark, sf_dir):
    rows = token_rows(I.doc_raw(spark, sf_dir), "text", ["doc_id"], 0).filter("pos > 0")
    word = F.get("context", F.lit(0))
    return rows.select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), word.alias("raw"),
        F.lower(word).alias("token"),
    )


def _numbers(df, *columns):
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


@query(oracle("hits", "SELECT doc_id, start, n, label, canonical, surface FROM hits"))
def join_gazetteer(spark, sf_dir):
    hits = gazetteer_hits(I.doc_raw(spark, sf_dir), I.dictionary(spark))
    return _numbers(hits, "start", "n")


@query(oracle("matched", "SELECT doc_id, start, n, label, canonical FROM matched"))
def txt_gazetteer_match(spark, sf_dir):
    found = gazetteer_match(I.doc_raw(spark, sf_dir), I.dictionary(spark))
    return _numbers(found, "start", "n").select("doc_id", "start", "n", "label", "canonical")


@query(oracle("match_facts", """
    SELECT doc_id, fact, count(*) AS n FROM match_facts WHERE label <> 'ORIGIN' GROUP BY ALL"""))
def txt_normalize_entity(spark, sf_dir):
    found = gazetteer_match(I.doc_raw(spark, sf_dir), I.dictionary(spark))
    return (
        found.filter(F.col("label") != "ORIGIN")
        .groupBy("doc_id", "fact")
        .agg(F.count("*").alias("n"))
    )


@query(oracle("match_facts", """
    SELECT doc_id, start, fact FROM match_facts WHERE label = 'ORIGIN'"""))
def txt_place_origin(spark, sf_dir):
    found = gazetteer_match(I.doc_raw(spark, sf_dir), I.dictionary(spark))
    places = found.filter(F.col("label") == "ORIGIN").select("doc_id", "start", "fact")
    return _numbers(places, "start")


@query(oracle("features", "SELECT doc_id, start, fact FROM features"))
def txt_feature_pairs(spark, sf_dir):
    found = word_facts(I.doc_raw(spark, sf_dir), I.rules(spark))
    features = found.filter(F.col("fact").startswith("FEATURE:"))
    return _numbers(features.select("doc_id", "start", "fact"), "start")


_DOC_CHARACTERS = """
    SELECT DISTINCT doc_id, fact FROM (SELECT doc_id, fact FROM characters
                                       UNION ALL SELECT doc_id, fact FROM breed_characters)"""


@query(oracle("characters breed_characters", _DOC_CHARACTERS))
def txt_character_pairs(spark, sf_dir):
    # The dictionary has a label CHARACTER too; renamed, only the word rule's facts remain.
    rules = I.rules(spark)
    renamed = rules.dictionary.withColumn(
        "label", F.when(F.col("label") == "CHARACTER", "WORD").otherwise(F.col("label"))
    )
    facts = document_facts(
        I.doc_raw(spark, sf_dir), replace(rules, dictionary=renamed), ["doc_id"], "text"
    )
    return facts.select("doc_id", F.explode("extracted_facts").alias("fact")).filter(
        F.col("fact").startswith("CHARACTER:")
    )


_FACT_SETS = """
    SELECT d.{columns}, coalesce(string_agg(f.fact, '|' ORDER BY f.fact), '') AS facts,
           count(f.fact) AS n_facts
    FROM doc_raw d LEFT JOIN doc_facts f ON f.doc_id = d.doc_id GROUP BY {groups}"""


@query(oracle("doc_raw doc_facts", _FACT_SETS.format(columns="doc_id", groups="d.doc_id")))
def txt_fact_set(spark, sf_dir):
    facts = document_facts(I.doc_raw(spark, sf_dir), I.rules(spark), ["doc_id"], "text")
    return facts.select(
        "doc_id",
        F.array_join("extracted_facts", "|").alias("facts"),
        F.size("extracted_facts").cast("bigint").alias("n_facts"),
    )


@query(oracle("doc_raw doc_facts", _FACT_SETS.format(
    columns="title, d.source_file", groups="d.title, d.source_file")))
def op_extract_facts(spark, sf_dir):
    return extracted(spark, sf_dir).select(
        "title",
        "source_file",
        F.array_join("extracted_facts", "|").alias("facts"),
        F.size("extracted_facts").cast("bigint").alias("n_facts"),
    )


@query(oracle("doc_raw doc_facts", """
    SELECT d.title, coalesce(string_agg(f.fact, '|' ORDER BY f.fact), '') AS facts, count(f.fact) AS n_facts
    FROM doc_raw d LEFT JOIN doc_facts f ON f.doc_id = d.doc_id GROUP BY d.doc_id, d.title"""))
def op_extract_shared_files(spark, sf_dir):
    """Files that hold many records each: one output row per record all the same."""
    path = fresh_path(spark, "records")
    rows = I.doc_raw(spark, sf_dir).select("title", F.col("text").alias("content"))
    rows.write.json(path)
    records = read_json(spark, path, "title string, content string", provenance="source_file")
    facts = extract_facts(records, I.rules(spark), text="content")
    return facts.select(
        "title",
        F.array_join("extracted_facts", "|").alias("facts"),
        F.size("extracted_facts").cast("bigint").alias("n_facts"),
    )


@query(oracle("doc_raw match_facts", """
    , f AS (SELECT doc_id, fact FROM match_facts UNION SELECT doc_id, 'LANG:' || lang FROM doc_raw)
    SELECT d.source_file, string_agg(f.fact, '|' ORDER BY f.fact) AS facts
    FROM doc_raw d JOIN f USING (doc_id) GROUP BY d.source_file"""))
def udf_extract(spark, sf_dir):
    """A plugged-in extractor, here a lookup of the document's language."""
    docs = I.doc_raw(spark, sf_dir)

    def language(rows):
        found = docs.select("doc_id", F.concat(F.lit("LANG:"), "lang").alias("fact"))
        return rows.select("doc_id").join(found, "doc_id")

    words_off = replace(I.rules(spark), adjectives=None)
    facts = extract_facts(docs, words_off, ["doc_id"], extra_extractors=[language])
    return facts.select("source_file", F.array_join("extracted_facts", "|").alias("facts"))


_CORPUS = f"""corpus AS (
        SELECT doc_id, text, 'wikipedia' AS source, 'doc-' || doc_id AS title FROM documents
        UNION ALL SELECT -1 - page_id, {_TEXT}, 'petmd', url FROM pages)"""
_WEIGHTS = "weights AS (SELECT * FROM (VALUES ('wikipedia', 0.6), ('petmd', 0.8), ('pubmed', 0.7), ('cat-api', 0.99)) AS v(source, weight))"


@query(oracle("doc_facts structured", """
    , named AS (SELECT doc_id, min(substr(fact, 7)) AS breed FROM doc_facts
                WHERE fact LIKE 'BREED:%' GROUP BY doc_id),
    api AS (SELECT part_no, name AS breed FROM structured WHERE fact LIKE 'BREED:%' GROUP BY ALL),
    candidate AS (
        SELECT DISTINCT breed,
               CASE WHEN strpos(fact, '=') > 0
                    THEN 'feature_' || split_part(split_part(fact, '=', 1), ':', 2)
                    ELSE lower(split_part(fact, ':', 1)) END AS fact_type,
               CASE WHEN strpos(fact, '=') > 0 THEN split_part(fact, '=', 2)
                    ELSE split_part(fact, ':', 2) END AS fact_value, d.source, d.title
        FROM doc_facts JOIN named USING (doc_id) JOIN documents d USING (doc_id)
        WHERE fact NOT LIKE 'BREED:%'
        UNION
        SELECT breed, lower(split_part(fact, ':', 1)), trim(substr(fact, strpos(fact, ':') + 1)),
               'cat-api', ''
        FROM structured JOIN api USING (part_no)
        WHERE fact NOT LIKE 'BREED:%' AND trim(substr(fact, strpos(fact, ':') + 1)) <> ''),
    f AS (SELECT breed, fact_type, fact_value, count(*) AS mentions_count,
                 count(DISTINCT source) AS sources_count,
                 string_agg(DISTINCT source, '; ' ORDER BY source) AS source_list,
                 0.4 * max(weight) + 0.4 * count(DISTINCT source)::DOUBLE / 4
                 + 0.2 * (1 - 1.0 / (sqrt(count(*)) + 1)) AS final_score
          FROM candidate JOIN weights USING (source) GROUP BY breed, fact_type, fact_value)
    SELECT breed, fact_type, fact_value, mentions_count, sources_count, source_list,
           round(final_score, 9) AS final_score FROM f
    QUALIFY row_number() OVER (PARTITION BY breed, fact_type
                               ORDER BY final_score DESC, fact_value) <= 10""")
    .replace("FROM documents", "FROM corpus").replace("JOIN documents d", "JOIN corpus d")
    .replace("WITH ", f"WITH {_CORPUS}, {_WEIGHTS}, ", 1))
def op_pipeline(spark, sf_dir):
    """The whole job: two record shapes in shared files, and the record feed, to final facts."""
    raw = fresh_path(spark, "corpus") + "/raw"
    doc, page = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    articles = doc.select(F.concat(F.lit("doc-"), "doc_id").alias("title"), F.col("text").alias("content"))
    overwrite_json(articles, f"{raw}/wikipedia")
    overwrite_json(page.select("url", F.col("html").alias("payload")), f"{raw}/petmd")
    columns = "title string, content string, url string, payload string"
    records = read_json(spark, [f"{raw}/wikipedia", f"{raw}/petmd"], columns, provenance="source_file")
    docs = title_or_url(unify_text(records), row_level=True)
    # A file holds many records; each is known by its folder and its title.
    folder = F.regexp_extract("source_file", "^(.*/)", 1)
    docs = docs.withColumn("source_file", F.concat(folder, "title"))
    facts = extract_facts(docs, I.rules(spark))
    feed = structured_facts(I.breeds(spark, sf_dir), "/raw/cat-api/breeds.json")
    fused = fuse_facts(candidate_facts(facts.unionByName(feed)), default_weights(spark))
    return fused.withColumn("final_score", F.round("final_score", 9))


# Stored crawl records


@query(oracle("listing_links", """
    SELECT url, link,
           CASE WHEN link LIKE 'http%' THEN link
                WHEN link LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || link
                ELSE regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^(.*/)', 1) || link END
               AS target_url
    FROM listing_links"""))
def crawl_listing_links(spark, sf_dir):
    return crawl.listing_links(I.listing_raw(spark, sf_dir))


_FORMS = "[link, '//cdn.x.org/a', '/b?c=1', '?page=2', '#top', 'd/e.html', 'mailto:a@b.c']"
_RELATIVE = """
    , forms AS (SELECT page_id, url, unnest({forms}) AS link FROM
                (SELECT page_id, url, 'https://y.org/' || page_id AS link FROM pages)),
    base AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
                    regexp_extract(url, '^([^?#]*)', 1) AS page FROM forms)"""


@query(("WITH " + _RELATIVE.replace("{forms}", _FORMS).strip().lstrip(",") + """
    SELECT page_id, link,
           CASE WHEN regexp_matches(link, '^[a-z]+:') THEN link
                WHEN link LIKE '//%' THEN split_part(url, '//', 1) || link
                WHEN link LIKE '/%' THEN origin || link
                WHEN link LIKE '?%' THEN page || link
                WHEN link LIKE '#%' THEN split_part(url, '#', 1) || link
                WHEN page = origin THEN origin || '/' || link
                ELSE regexp_extract(page, '^(.*/)', 1) || link END AS resolved
    FROM base"""))
def crawl_resolve_url(spark, sf_dir):
    fixed = ["//cdn.x.org/a", "/b?c=1", "?page=2", "#top", "d/e.html", "mailto:a@b.c"]
    links = F.array(F.concat(F.lit("https://y.org/"), "page_id"), *[F.lit(x) for x in fixed])
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(links).alias("link"))
    return rows.select(
        "page_id",
        "link",
        crawl.resolve_url(F.col("url"), F.col("link")).alias("resolved"),
    )


_TITLE_PAGES = """
    SELECT page_id, url || CASE WHEN page_id % 6 = 0 THEN '/maine-coon'
                                WHEN page_id % 6 = 3 THEN '/x/' ELSE '' END AS url,
           CASE WHEN page_id % 3 = 0 THEN replace(html, '<h1', '<h7') ELSE html END AS html
    FROM pages"""


@query(f"""
    WITH p AS ({_TITLE_PAGES})
    SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'Maine Coon' WHEN 3 THEN ''
                    ELSE regexp_extract(html, '<h1[^>]*>([^<]+)', 1) END AS title FROM p""")
def crawl_page_title(spark, sf_dir):
    page = F.col("page_id")
    suffix = F.when(page % 6 == 0, "/maine-coon").when(page % 6 == 3, "/x/").otherwise("")
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat("url", suffix).alias("url"),
        F.when(page % 3 == 0, F.replace("html", F.lit("<h1"), F.lit("<h7")))
        .otherwise(F.col("html"))
        .alias("html"),
    )
    return crawl.page_title(pages).select("page_id", "title")


@query("""
    SELECT regexp_extract(html, '<h1[^>]*>([^<]+)', 1) AS title, md5(html) AS content_hash,
           '2024-01-02 03:04:05' AS "timestamp", url,
           '/raw/pages/' || regexp_extract(rtrim(url, '/'), '([^/]+)$', 1) || '.json' AS target_path
    FROM pages""")
def crawl_page_record(spark, sf_dir):
    fetched = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    pages = table(spark, sf_dir, "pages").withColumn("fetched_at", fetched)
    records = crawl.page_records(pages, "/raw/pages", "fetched_at")
    return records.withColumn("content_hash", F.md5("content")).drop("content")


@query(oracle("esearch_raw", f"""
    , ids AS (SELECT DISTINCT regexp_extract(source_file, '([^/]+)/[^/]+$', 1) AS breed_group,
                     trim(unnest(regexp_extract_all(payload, '<Id>([^<]+)</Id>', 1))) AS article_id
              FROM esearch_raw)
    SELECT *, '{EUTILS}efetch.fcgi?db=pubmed&id=' || article_id
           || '&retmode=xml' AS url,
           '/raw/pubmed/articles/' || breed_group || '/' || article_id || '.json' AS target_path
    FROM ids"""))
def crawl_article_ids(spark, sf_dir):
    return article_requests(I.esearch_raw(spark, sf_dir), "/raw/pubmed/articles")


@query(oracle("lines", f"""
    , names AS (SELECT split_part(line, ', ', 1) AS canonical,
                       unnest(string_split(line, ', ')) AS name FROM lines)
    SELECT canonical, name, '{EUTILS}esearch.fcgi?db=pubmed&term='
           || lower(replace(name, ' ', '+')) || '+AND+cat&retmax=9999' AS url,
           '/raw/pubmed/article_list/' || canonical || '/' || lower(replace(name, ' ', '+')) || '.json'
               AS target_path
    FROM names WHERE {STRIP("name")} <> ''"""))
def crawl_search_terms(spark, sf_dir):
    return crawl.search_requests(name_lines(I.breeds(spark, sf_dir)), I.LISTS)


@query(oracle("members", """
    SELECT substr(title, 6) AS title, md5(content) AS content_hash,
           'https://en.wikipedia.org/wiki/' || substr(title, 6) AS url,
           '/raw/wiki/' || replace(substr(title, 6), '/', '_') || '.json' AS target_path
    FROM members WHERE ns = 1 AND content <> ''"""))
def crawl_talk_articles(spark, sf_dir):
    articles = crawl.talk_articles(I.members_raw(spark, sf_dir), "/raw/wiki")
    return articles.withColumn("content_hash", F.md5("content")).drop("content")


# Search


def _facts(spark, sf_dir):
    """The stored fact table a search runs over."""
    return cut_lineage(fuse_facts(I.candidates(spark, sf_dir), I.weights(spark, sf_dir)))


@query(oracle("postings", f"""
    SELECT {KEYS}, lexeme, array_to_string(positions, ' ') AS positions FROM postings"""))
def fts_postings(spark, sf_dir):
    rows = postings(_facts(spark, sf_dir))
    as_text = F.transform("positions", lambda p: p.cast("string"))
    return rows.withColumn("positions", F.array_join(as_text, " "))


@query(f"""
    SELECT conv_id * 1000 + turn AS query_id, unnest(l) AS term, len(l) AS n_terms FROM
    (SELECT conv_id, turn, list_distinct({I.TOKENS("lower(text)")}) AS l FROM conversations)""")
def fts_query_terms(spark, sf_dir):
    queries = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query")
    )
    return _numbers(query_terms(queries), "n_terms")


@query(oracle("postings terms", f"""
    SELECT query_id, {KEYS}, lexeme, len(positions) AS n_positions
    FROM postings JOIN terms USING (lexeme)"""))
def join_search_terms(spark, sf_dir):
    terms = query_terms(I.search_queries(spark))
    found = matching_postings(postings(_facts(spark, sf_dir)), terms)
    n_positions = F.size("positions").cast("bigint").alias("n_positions")
    return found.select("query_id", *FACT, "lexeme", n_positions)


@query(oracle("matches", f"SELECT query_id, {KEYS} FROM matches"))
def fts_match(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return match(facts, postings(facts), I.search_queries(spark)).drop("rank")


@query(oracle("fact_words squeries", f"""
    SELECT query_id, {KEYS} FROM fact_words, squeries
    WHERE list_has_all(lexemes, all_of) AND (len(any_of) = 0 OR list_has_any(lexemes, any_of))
    AND NOT list_has_any(lexemes, none_of)
    AND len(list_filter(prefixes, lambda p: len(list_filter(lexemes,
            lambda w: starts_with(w, p))) = 0)) = 0"""))
def fts_match_operators(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return match(facts, postings(facts), I.structured_queries(spark)).drop("rank")


@query(oracle("ranks", f"SELECT query_id, {KEYS}, round(rank, 9) AS rank FROM ranks"))
def fts_rank(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    found = match(facts, postings(facts), I.search_queries(spark))
    return found.withColumn("rank", F.round("rank", 9))


_SEARCH = oracle("ranks fused", f"""
    SELECT query_id, {KEYS}, source_list, mentions_count, round(final_score, 9) AS final_score,
           round(rank, 9) AS rank
    FROM ranks JOIN fused USING (breed, fact_type, fact_value)""")


def _rounded(found):
    return found.withColumns({c: F.round(c, 9) for c in ("final_score", "rank")})


def _stored_postings(spark, facts):
    path = fresh_path(spark, "postings")
    write_postings(postings(facts), path)
    return read_postings(spark, path)


@query(_SEARCH)
def op_search(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return _rounded(search(facts, _stored_postings(spark, facts), I.search_queries(spark)))


@query(_SEARCH + " QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY fused.final_score DESC, "
       "ranks.rank DESC, breed, fact_type, fact_value) <= 25")
def srt_search_order(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return _rounded(search(facts, postings(facts), I.search_queries(spark), limit=25))


@query(_SEARCH + " QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY fused.final_score DESC, "
       "ranks.rank DESC, breed, fact_type, fact_value) <= 25")
def srt_search_bands(spark, sf_dir):
    """The first facts of each query from a stored index, read by bands of falling score."""
    index = build_index(_facts(spark, sf_dir), fresh_path(spark, "index"))
    return _rounded(search_index(spark, index, I.search_queries(spark), limit=25))


@query(_SEARCH)
def op_search_segments(spark, sf_dir):
    """An index after three refreshes: other spellings, half the mentions, and the facts as they are."""
    path, candidates, weights = fresh_path(spark, "index"), I.candidates(spark, sf_dir), I.weights(spark, sf_dir)
    older = cut_lineage(fuse_facts(candidates.withColumn("breed", F.upper("breed")), weights))
    build_index(older, path)
    facts = _facts(spark, sf_dir)
    fewer = facts.withColumn("mentions_count", F.floor(F.col("mentions_count") / 2).cast("bigint"))
    refresh_index(older.unionByName(facts.join(older, FACT, "left_anti")), path)
    refresh_index(fewer, path)
    index = refresh_index(facts, path)
    return _rounded(search_index(spark, index, I.search_queries(spark)))


@query(oracle("mixed_matches mixed_ranks fused", f"""
    SELECT m.query_id, {KEYS}, source_list, mentions_count, round(final_score, 9) AS final_score,
           round(coalesce(rank, 0), 9) AS rank
    FROM mixed_matches m JOIN fused USING (breed, fact_type, fact_value)
    LEFT JOIN mixed_ranks r USING (query_id, breed, fact_type, fact_value)"""))
def op_search_operators(spark, sf_dir):
    """Plain words, operators, prefixes and hyphenated words in one entry, over stored postings."""
    facts = _facts(spark, sf_dir)
    return _rounded(search(facts, _stored_postings(spark, facts), I.mixed_queries(spark)))

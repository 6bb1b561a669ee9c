"""The engine's inputs, derived from the test tables, in Spark and in SQL.

Each Spark function has a twin in ``SQL``, the common table expressions the check
queries start with. The tables are used whole; values such as ``o_orderkey % 11``
only vary the shape of a record, no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.functions.strings import WHITESPACE
from factspark.operators.dictionary import patterns
from factspark.operators.extraction import Rules
from factspark.session import literal_table

# Phrases that occur in the documents, which are made of invented syllables.
ENTITY_PHRASES = [
    ("BREED", "The Anea", "the anea eriner"),
    ("BREED", "The Anea", "thanedble"),
    ("BREED", "Tion", "tion"),
    ("BREED", "De Ing", "de"),
    ("BREED", "De Ing", "ing"),
]
OTHER_PHRASES = [
    ("DISEASE", "On The", "on the"),
    ("DISEASE", "Onbleea", "in onbleea of"),
    ("SYMPTOM", "Ly", "ly"),
    ("SYMPTOM", "Ble", "ble"),
    ("ORIGIN", "anea", "anea"),
] + [("CHARACTER", w, w) for w in "in the en of and to a on is that it as be was for er".split()]
PHRASES = ENTITY_PHRASES + OTHER_PHRASES

# Words of the documents that play the parts of the word rules.
ADJECTIVES = "in of on er re an la un le".split()
HEADS = {"the": "coat", "and": "fur", "to": "tail", "du": "ear"}
SUBJECTS = ["it", "that", "les"]
COPULAS = ["is", "was", "be", "est"]

RAW = "hdfs://nn:9000/raw"
LISTS = "/raw/pubmed/article_list"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dictionary(spark: SparkSession) -> DataFrame:
    return patterns(spark, PHRASES)


def rules(spark: SparkSession, with_dictionary: bool = True) -> Rules:
    return Rules(
        dictionary(spark) if with_dictionary else None,
        literal_table(spark, [(w,) for w in ADJECTIVES], "token string"),
        heads=HEADS,
        subjects=SUBJECTS,
        copulas=COPULAS,
    )


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten document sources are weighted, the others are not."""
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("int")
    return (
        table(spark, sf_dir, "documents")
        .select("source", number.alias("n"))
        .filter(F.col("n") < 10)
        .distinct()
        .select("source", (0.5 + F.col("n") / 100).alias("weight"))
    )


def doc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc-"), "doc_id").alias("title"),
        "text",
        "lang",
        F.concat(F.lit(RAW + "/"), "source", F.lit("/"), "doc_id", F.lit(".json")).alias(
            "source_file"
        ),
    )


def page_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.lit(None).cast("string").alias("title"),
        F.col("html").alias("content"),
        "url",
        F.concat(F.lit(f"{RAW}/pages/"), "page_id", F.lit(".json")).alias("source_file"),
    )


def breeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    alternatives = F.when(size % 5 == 0, F.lit(None)).when(size % 7 == 0, "").otherwise(
        F.concat("p_brand", F.lit(", "), "p_type")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_no"),
        F.when(size % 11 == 0, "").otherwise(F.concat("p_name", F.lit(" "), "p_partkey")).alias(
            "name"
        ),
        alternatives.alias("alt_names"),
        F.when(size % 3 != 0, F.col("p_type")).alias("origin"),
        F.when(size % 13 != 0, F.replace("p_name", F.lit(" "), F.lit(",  "))).alias("temperament"),
    )


def breeds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched lists of up to 20 records."""
    record = F.struct("name", "alt_names", "origin", "temperament", "part_no")
    return (
        breeds(spark, sf_dir)
        .groupBy(F.floor(F.col("part_no") / 20).cast("bigint").alias("page"))
        .agg(F.array_sort(F.collect_list(record)).alias("records"))
        .select(
            F.concat(F.lit("https://api.example.org/v1/breeds?page="), "page").alias("url"),
            F.lit("json").alias("content_type"),
            F.transform(
                "records",
                lambda r: F.struct(
                    *[r[c].alias(c) for c in ("name", "alt_names", "origin", "temperament")]
                ),
            ).alias("payload"),
        )
    )


def esearch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search response per order, in a folder per priority."""
    count = F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(
        F.concat(F.lit("<Count>"), "o_custkey", F.lit("</Count>"))
    )
    ids = F.concat(
        F.lit("<IdList><Id>"), "o_orderkey", F.lit("</Id><Id> "), "o_custkey",
        F.lit(" </Id><Id></Id></IdList>"),
    )
    again = F.when(F.col("o_orderkey") % 11 == 0, "").otherwise("<Count>7</Count>")
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit(f"{LISTS}/"), F.replace("o_orderpriority", F.lit(" "), F.lit("%20")),
            F.lit("/"), "o_orderkey", F.lit(".json"),
        ).alias("source_file"),
        F.concat(
            F.lit("<eSearchResult>"), count, ids, again, F.lit("</eSearchResult>")
        ).alias("payload"),
    )


def listing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per page, in the three shapes a listing has."""
    page = F.col("page_id")
    links = F.concat(
        F.lit('[{"url":"'), "url", F.lit('"},{"url":""},{"url":"/p/'), "page_id",
        F.lit('"},{"url":"p/'), "page_id", F.lit('"}]'),
    )
    data = F.when(page % 4 == 0, F.concat(F.lit('"result":[],"items":'), links)).otherwise(
        F.concat(F.lit('"result":'), links)
    )
    script = F.when(page % 9 == 0, "").otherwise(
        F.concat(
            F.lit('<script id="__NEXT_DATA__" type="application/json">'
                  '{"props":{"pageProps":{"data":{'), data, F.lit("}}}}</script>"),
        )
    )
    return table(spark, sf_dir, "pages").select(
        "url", F.concat(F.lit("<html><body>"), script, F.lit("</body></html>")).alias("html")
    )


def members_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("Talk:"), "url").alias("title"),
        F.when(page % 3 == 0, 1).when(page % 3 == 1, 15).otherwise(0).alias("ns"),
        F.when(page % 7 == 0, "").otherwise(F.col("html")).alias("content"),
    )


def refetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many writes of the same files."""
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("/"), "user_id", F.lit(".json")).alias("path"),
        F.col("ts").alias("fetched_at"),
        "event_id",
        F.col("props").alias("payload"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large candidate table with uneven spelling and repeats: one row per line item."""
    line = F.col("l_linenumber")
    spelled = F.when(line % 2 == 0, F.lit(" maine-coon ")).otherwise(F.lit("MAINE-coon "))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(spelled, "l_returnflag", "l_linestatus").alias("breed"),
        F.concat(F.lit("mode_"), line).alias("fact_type"),
        F.concat(F.lit("Size "), F.col("l_quantity").cast("int")).alias("fact_value"),
        F.when(F.col("l_suppkey") % 23 != 0, F.concat(F.lit("src"), F.col("l_suppkey") % 20)).alias(
            "source"
        ),
        F.concat(F.lit("/raw/lines/"), "l_orderkey", F.lit(".json")).alias("hdfs_path"),
    )


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact strings of every form, good and bad, with the name of a part as the value."""
    name, form = F.col("p_name"), F.col("p_size") % 13
    forms = [
        F.concat(F.lit(" CHARACTER : "), name, F.lit(" ")),
        F.concat(F.lit("feature:Coat = "), name),
        F.concat(F.lit("FEATURE:"), name),
        F.concat(F.lit("FEATURE:="), name),
        F.lit("FEATURE:coat="),
        F.concat(F.lit("FEATURE:a="), name, F.lit("=c")),
        F.concat(F.lit("ORIGIN:a:"), name),
        F.concat(F.lit(":"), name),
        F.concat(F.lit("BREED:"), name),
        F.concat(F.lit("breed:"), name),
        name,
        F.lit("TAG:  "),
    ]
    fact = F.lit(None).cast("string")
    for number, value in enumerate(forms):
        fact = F.when(form == number, value).otherwise(fact)
    return table(spark, sf_dir, "part").select("p_partkey", fact.alias("fact"))


QUERIES = [(1, "size maine"), (2, "mode  7"), (3, " SRC3 coon "), (4, "src1 af"), (5, "zzz"), (6, "coon")]
STRUCTURED = [
    (1, ["size"], ["src1", "src2"], ["af"], []),
    (2, ["mode"], [], [], ["src", "ma"]),
    (3, [], ["nf", "ro"], [], ["si"]),
    (4, [], [], ["af", "nf"], []),
    (5, ["zzz"], [], [], []),
]


def search_queries(spark: SparkSession) -> DataFrame:
    return literal_table(spark, QUERIES, "query_id int, query string")


def structured_queries(spark: SparkSession) -> DataFrame:
    words = ", ".join(f"{kind} array<string>" for kind in ("all_of", "any_of", "none_of", "prefix"))
    return literal_table(spark, STRUCTURED, f"query_id int, {words}")


#: query_id, plain words, all_of, any_of, none_of, prefix
MIXED = [
    (1, "size maine", [], [], [], []),
    (2, "coon", ["size"], ["zzz-coon", "maine-coon"], [], ["sr"]),
    (3, "", [], [], ["maine-size"], ["s"]),
    (4, "Maine-Coon", [], ["src1", "src2"], ["af"], []),
    (5, " ", [], [], ["af", "nf"], []),
    (6, "--", [], [], [], []),
]


def mixed_queries(spark: SparkSession) -> DataFrame:
    words = ", ".join(f"{kind} array<string>" for kind in ("all_of", "any_of", "none_of", "prefix"))
    return literal_table(spark, MIXED, f"query_id int, query string, {words}")


def _mixed_sql() -> str:
    """The mixed queries with plain words split, as the check sees them."""
    rows = []
    for number, plain, all_of, *others in MIXED:
        split = [w for w in plain.lower().replace("-", " ").split() if w]
        if split or all_of or any(others):
            rows.append((number, [*split, *all_of], *others))
    return _values(rows)


def _literal(value) -> str:
    if isinstance(value, list):
        return "CAST([" + ", ".join(map(_literal, value)) + "] AS VARCHAR[])"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def words_in(words) -> str:
    return "(" + ", ".join(map(_literal, words)) + ")"


TOKENS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+')".format
STRIP = ("trim({}, '" + WHITESPACE + "')").format

# Name -> the names it builds on, and its SQL.
SQL: dict[str, tuple[list[str], str]] = {
    "weights": ([], r"""
        SELECT DISTINCT source, 0.5 + CAST(regexp_extract(source, '(\d+)$', 1) AS INT) / 100 AS weight
        FROM documents WHERE TRY_CAST(regexp_extract(source, '(\d+)$', 1) AS INT) < 10"""),
    "doc_raw": ([], f"""
        SELECT doc_id, 'doc-' || doc_id AS title, text, lang,
               '{RAW}/' || source || '/' || doc_id || '.json' AS source_file FROM documents"""),
    "page_raw": ([], f"""
        SELECT CAST(NULL AS VARCHAR) AS title, html AS content, url,
               '{RAW}/pages/' || page_id || '.json' AS source_file FROM pages"""),
    "breeds": ([], """
        SELECT p_partkey AS part_no,
               CASE WHEN p_size % 11 = 0 THEN '' ELSE p_name || ' ' || p_partkey END AS name,
               CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN ''
                    ELSE p_brand || ', ' || p_type END AS alt_names,
               CASE WHEN p_size % 3 <> 0 THEN p_type END AS origin,
               CASE WHEN p_size % 13 <> 0 THEN replace(p_name, ' ', ',  ') END AS temperament
        FROM part"""),
    "lines": (["breeds"], "SELECT concat_ws(', ', name, alt_names) AS line FROM breeds"),
    "esearch_raw": ([], f"""
        SELECT '{LISTS}/' || replace(o_orderpriority, ' ', '%20') || '/' || o_orderkey || '.json'
                   AS source_file,
               '<eSearchResult>'
               || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '<Count>' || o_custkey || '</Count>' END
               || '<IdList><Id>' || o_orderkey || '</Id><Id> ' || o_custkey || ' </Id><Id></Id></IdList>'
               || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '<Count>7</Count>' END
               || '</eSearchResult>' AS payload
        FROM orders"""),
    "listing_links": ([], """
        SELECT url, unnest([url, '/p/' || page_id, 'p/' || page_id]) AS link, page_id
        FROM pages WHERE NOT page_id % 9 = 0"""),
    "members": ([], """
        SELECT 'Talk:' || url AS title,
               CASE page_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 15 ELSE 0 END AS ns,
               CASE WHEN page_id % 7 = 0 THEN '' ELSE html END AS content FROM pages"""),
    "refetch_log": ([], """
        SELECT event_type || '/' || user_id || '.json' AS path, ts AS fetched_at, event_id,
               props AS payload FROM events"""),
    "cand": ([], """
        SELECT CASE WHEN l_linenumber % 2 = 0 THEN ' maine-coon ' ELSE 'MAINE-coon ' END
                   || l_returnflag || l_linestatus AS breed,
               'mode_' || l_linenumber AS fact_type,
               'Size ' || CAST(l_quantity AS INT) AS fact_value,
               CASE WHEN l_suppkey % 23 <> 0 THEN 'src' || l_suppkey % 20 END AS source,
               '/raw/lines/' || l_orderkey || '.json' AS hdfs_path
        FROM lineitem"""),
    "by_source": (["cand", "weights"], """
        SELECT breed, fact_type, fact_value, source, weight, count(*) AS mentions_count
        FROM cand JOIN weights USING (source) GROUP BY ALL"""),
    # Straight over the candidates, not by way of the counts per source.
    "scored": (["cand", "weights"], """
        SELECT breed, fact_type, fact_value, count(*) AS mentions_count,
               count(DISTINCT source) AS sources_count,
               string_agg(DISTINCT source, '; ' ORDER BY source) AS source_list,
               max(weight) AS max_weight,
               0.4 * max(weight)
               + 0.4 * count(DISTINCT source)::DOUBLE / (SELECT count(*) FROM weights)
               + 0.2 * (1 - 1.0 / (sqrt(count(*)) + 1)) AS final_score
        FROM cand JOIN weights USING (source) GROUP BY breed, fact_type, fact_value"""),
    "ranked": (["scored"], """
        SELECT *, row_number() OVER (PARTITION BY breed, fact_type
                                     ORDER BY final_score DESC, fact_value) AS rn
        FROM scored"""),
    "fused": (["ranked"], "SELECT * FROM ranked WHERE rn <= 10"),
    "raw_facts": ([], """
        SELECT p_partkey, CASE p_size % 13
            WHEN 0 THEN ' CHARACTER : ' || p_name || ' ' WHEN 1 THEN 'feature:Coat = ' || p_name
            WHEN 2 THEN 'FEATURE:' || p_name WHEN 3 THEN 'FEATURE:=' || p_name
            WHEN 4 THEN 'FEATURE:coat=' WHEN 5 THEN 'FEATURE:a=' || p_name || '=c'
            WHEN 6 THEN 'ORIGIN:a:' || p_name WHEN 7 THEN ':' || p_name
            WHEN 8 THEN 'BREED:' || p_name WHEN 9 THEN 'breed:' || p_name
            WHEN 10 THEN p_name WHEN 11 THEN 'TAG:  ' END AS fact FROM part"""),
    "tok0": ([], f"""
        SELECT doc_id, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT doc_id, {TOKENS("text")} AS l FROM documents)"""),
    "tok": (["tok0"], """
        SELECT doc_id, pos, raw, lower(raw) AS t, lower(lead(raw, 1) OVER w) AS t1,
               lower(lead(raw, 2) OVER w) AS t2, lead(raw, 1) OVER w AS raw1,
               lead(raw, 2) OVER w AS raw2
        FROM tok0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)"""),
    "dict": ([], f"""
        SELECT label, canonical, string_split(alias, ' ') AS toks,
               len(string_split(alias, ' ')) AS n, CAST(label = 'ORIGIN' AS INT) AS tier
        FROM ({_values(PHRASES)}) AS v(label, canonical, alias)"""),
    "hits": (["tok", "dict"], """
        SELECT doc_id, pos AS start, n, label, canonical, tier,
               CASE n WHEN 1 THEN raw WHEN 2 THEN raw || ' ' || raw1
                      ELSE raw || ' ' || raw1 || ' ' || raw2 END AS surface
        FROM tok JOIN dict ON t = toks[1] AND (n < 2 OR t1 = toks[2]) AND (n < 3 OR t2 = toks[3])"""),
    # Phrases of one length cannot overlap each other here, so one pass per length decides.
    "kept3": (["hits"], "SELECT * FROM hits WHERE tier = 0 AND n = 3"),
    "cover3": (["kept3"], "SELECT doc_id, unnest(range(start, start + n)) AS pos FROM kept3"),
    "kept2": (["cover3"], """
        SELECT h.* FROM hits h WHERE tier = 0 AND n = 2 AND NOT EXISTS
            (SELECT 1 FROM cover3 c WHERE c.doc_id = h.doc_id AND c.pos = h.start)
        AND NOT EXISTS (SELECT 1 FROM cover3 c WHERE c.doc_id = h.doc_id AND c.pos = h.start + 1)"""),
    "cover2": (["kept2"], """
        SELECT * FROM cover3 UNION ALL
        SELECT doc_id, unnest(range(start, start + n)) AS pos FROM kept2"""),
    "kept1": (["cover2"], """
        SELECT h.* FROM hits h ANTI JOIN cover2 c ON c.doc_id = h.doc_id AND c.pos = h.start
        WHERE tier = 0 AND n = 1"""),
    "cover1": (["kept1"], "SELECT * FROM cover2 UNION ALL SELECT doc_id, start AS pos FROM kept1"),
    "matched": (["cover1"], """
        SELECT * FROM kept3 UNION ALL SELECT * FROM kept2 UNION ALL SELECT * FROM kept1 UNION ALL
        SELECT h.* FROM hits h ANTI JOIN cover1 c ON c.doc_id = h.doc_id AND c.pos = h.start
        WHERE tier = 1"""),
    "match_facts": (["matched"], """
        SELECT doc_id, start, n, label, canonical, surface,
               label || ':' || CASE WHEN tier = 0 THEN canonical ELSE surface END AS fact
        FROM matched"""),
    "heads": ([], f"SELECT * FROM ({_values(HEADS.items())}) AS v(form, lemma)"),
    "features": (["tok", "heads"], f"""
        SELECT doc_id, pos AS start, 'FEATURE:' || lemma || '=' || t AS fact
        FROM tok JOIN heads ON form = t1 WHERE t IN {words_in(ADJECTIVES)}
        UNION ALL
        SELECT doc_id, pos, 'FEATURE:' || lemma || '=' || t
        FROM tok JOIN heads ON form = t2
        WHERE t IN {words_in(ADJECTIVES)} AND t1 IN {words_in(ADJECTIVES)}"""),
    "predicates": (["tok"], f"""
        SELECT c.doc_id, c.pos, a.t FROM tok c JOIN tok a
            ON a.doc_id = c.doc_id AND a.pos IN (c.pos + 1, c.pos + 2)
        WHERE c.t IN {words_in(COPULAS)} AND a.t IN {words_in(ADJECTIVES)}"""),
    "characters": (["predicates"], f"""
        SELECT s.doc_id, s.pos AS start, 'CHARACTER:' || p.t AS fact FROM tok s JOIN predicates p
            ON p.doc_id = s.doc_id AND p.pos IN (s.pos + 1, s.pos + 2, s.pos + 3)
        WHERE s.t IN {words_in(SUBJECTS)}"""),
    "breed_characters": (["predicates", "matched"], """
        SELECT m.doc_id, m.start, 'CHARACTER:' || p.t AS fact FROM matched m JOIN predicates p
            ON p.doc_id = m.doc_id
            AND p.pos IN (m.start + m.n, m.start + m.n + 1, m.start + m.n + 2)
        WHERE m.label = 'BREED'"""),
    "doc_facts": (["match_facts", "features", "characters", "breed_characters"], """
        SELECT doc_id, fact FROM match_facts UNION SELECT doc_id, fact FROM features
        UNION SELECT doc_id, fact FROM characters UNION SELECT doc_id, fact FROM breed_characters"""),
    "fact_lists": (["breeds"], f"""
        SELECT part_no, name,
            CASE WHEN name <> '' THEN ['BREED:' || name] ELSE [] END
            || CASE WHEN origin <> '' THEN ['ORIGIN:' || origin] ELSE [] END
            || CASE WHEN temperament <> '' THEN list_transform(string_split(temperament, ', '),
                    lambda x: 'CHARACTER:' || {STRIP("x")}) ELSE [] END AS facts
        FROM breeds"""),
    "structured": (["fact_lists"], "SELECT part_no, name, unnest(facts) AS fact FROM fact_lists"),
    "tokens_of_facts": (["fused"], f"""
        SELECT breed, fact_type, fact_value, lower(unnest(l)) AS lexeme,
               unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT breed, fact_type, fact_value,
                     {TOKENS("concat_ws(' ', breed, fact_type, fact_value, source_list)")} AS l
              FROM fused)"""),
    "postings": (["tokens_of_facts"], """
        SELECT breed, fact_type, fact_value, lexeme, list(pos ORDER BY pos) AS positions
        FROM tokens_of_facts GROUP BY ALL"""),
    "queries": ([], f"SELECT * FROM ({_values(QUERIES)}) AS v(query_id, query)"),
    "terms": (["queries"], f"""
        SELECT query_id, unnest(l) AS lexeme, len(l) AS n_terms FROM
        (SELECT query_id, list_distinct({TOKENS("lower(query)")}) AS l FROM queries)"""),
    "matches": (["postings", "terms"], """
        SELECT query_id, breed, fact_type, fact_value FROM postings JOIN terms USING (lexeme)
        GROUP BY ALL HAVING count(*) = max(n_terms)"""),
    "placed": (["matches", "tokens_of_facts", "terms"], """
        SELECT m.*, t.lexeme, t.pos, q.n_terms FROM matches m
        JOIN tokens_of_facts t USING (breed, fact_type, fact_value)
        JOIN terms q ON q.query_id = m.query_id AND q.lexeme = t.lexeme"""),
    "ranks": (["placed"], """
        SELECT query_id, breed, fact_type, fact_value, sum(0.1 / (j * j)) / 1.64493406685 AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, breed, fact_type, fact_value
                                           ORDER BY pos) AS j FROM placed WHERE n_terms = 1)
        GROUP BY ALL
        UNION ALL
        SELECT a.query_id, a.breed, a.fact_type, a.fact_value,
               1 - exp(sum(ln(1 - sqrt(0.01 * CASE WHEN abs(a.pos - b.pos) > 100 THEN 1e-30
                   ELSE 1 / (1.005 + 0.05 * exp(abs(a.pos - b.pos) / 1.5 - 2)) END))))
        FROM placed a JOIN placed b ON a.query_id = b.query_id AND a.breed = b.breed
             AND a.fact_type = b.fact_type AND a.fact_value = b.fact_value AND a.lexeme < b.lexeme
        GROUP BY ALL"""),
    "squeries": ([], f"""
        SELECT * FROM ({_values(STRUCTURED)}) AS v(query_id, all_of, any_of, none_of, prefixes)"""),
    "mqueries": ([], f"""
        SELECT * FROM ({_mixed_sql()}) AS v(query_id, all_of, any_of, none_of, prefixes)"""),
    "fact_words": (["postings"], """
        SELECT breed, fact_type, fact_value, list(lexeme) AS lexemes FROM postings GROUP BY ALL"""),
    "mixed_matches": (["fact_words", "mqueries"], """
        SELECT query_id, breed, fact_type, fact_value, all_of, any_of, prefixes FROM fact_words, mqueries
        WHERE list_has_all(lexemes, all_of) AND (len(any_of) = 0 OR len(list_filter(any_of,
                lambda x: list_has_all(lexemes, string_split(x, '-')))) > 0)
        AND len(list_filter(none_of, lambda x: list_has_all(lexemes, string_split(x, '-')))) = 0
        AND len(list_filter(prefixes, lambda p: len(list_filter(lexemes,
                lambda w: starts_with(w, p))) = 0)) = 0"""),
    "mixed_placed": (["mixed_matches", "tokens_of_facts"], """
        SELECT m.query_id, breed, fact_type, fact_value, t.lexeme, t.pos
        FROM mixed_matches m JOIN tokens_of_facts t USING (breed, fact_type, fact_value)
        WHERE list_contains(all_of, t.lexeme)
        OR len(list_filter(any_of, lambda x: list_contains(string_split(x, '-'), t.lexeme))) > 0
        OR len(list_filter(prefixes, lambda p: starts_with(t.lexeme, p))) > 0"""),
    "mixed_ranks": (["mixed_placed"], """
        SELECT query_id, breed, fact_type, fact_value, sum(0.1 / (j * j)) / 1.64493406685 AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, breed, fact_type, fact_value
                                           ORDER BY pos) AS j FROM mixed_placed)
        GROUP BY ALL HAVING count(DISTINCT lexeme) = 1
        UNION ALL
        SELECT a.query_id, a.breed, a.fact_type, a.fact_value,
               1 - exp(sum(ln(1 - sqrt(0.01 * CASE WHEN abs(a.pos - b.pos) > 100 THEN 1e-30
                   ELSE 1 / (1.005 + 0.05 * exp(abs(a.pos - b.pos) / 1.5 - 2)) END))))
        FROM mixed_placed a JOIN mixed_placed b ON a.query_id = b.query_id AND a.breed = b.breed
             AND a.fact_type = b.fact_type AND a.fact_value = b.fact_value AND a.lexeme < b.lexeme
        GROUP BY ALL"""),
}


def oracle(names: str, body: str) -> str:
    """SQL that starts with the named inputs and everything they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in SQL[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n][1]})" for n in ordered) + "\n" + body

"""Registered queries: matching, filters, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexshelf.functions import money
from lexshelf.functions import text as T
from lexshelf.functions.dates import date_math
from lexshelf.functions.geo import bbox, geo_dist
from lexshelf.functions.analyzers import Analyzer, token_rows
from lexshelf.operators import lookup, match, postings
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query
from lexshelf.session import cut, literal_table

LOWER = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))


def benchmark_matches(spark, sf_dir):
    index, asked = C.text_index(spark, sf_dir), cut(C.clauses(spark, sf_dir))
    return match.match_terms(index.postings, asked, key="doc_id", parts=index.parts()), asked


@query(
    "term_match",
    f"WITH {C.SQL_MATCH} SELECT query_id, doc_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS occurrences FROM matches GROUP BY ALL",
)
def term_match(spark, sf_dir):
    matches, _ = benchmark_matches(spark, sf_dir)
    return matches.groupBy("query_id", "doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("occurrences")
    )


@query(
    "boolean_and",
    f"""WITH {C.SQL_MATCH}, need AS (SELECT query_id, count(*) AS need FROM clauses GROUP BY 1)
    SELECT query_id, doc_id, count(*) AS n_terms FROM matches JOIN need USING (query_id) GROUP BY query_id, doc_id, need HAVING count(*) = need""",
)
def boolean_and(spark, sf_dir):
    matches, asked = benchmark_matches(spark, sf_dir)
    return match.boolean_match(matches, asked, "doc_id", "AND")


@query("boolean_or", f"WITH {C.SQL_MATCH} SELECT query_id, doc_id, count(*) AS n_terms FROM matches GROUP BY ALL")
def boolean_or(spark, sf_dir):
    matches, asked = benchmark_matches(spark, sf_dir)
    return match.boolean_match(matches, asked, "doc_id", "OR")


def part_postings(spark, sf_dir):
    return postings.postings_of(C.table(spark, sf_dir, "part"), "p_partkey", "p_name", LOWER)


SQL_PART_TOK = (
    "tok AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS term, "
    "generate_subscripts(string_split(p_name, ' '), 1) - 1 AS pos FROM part), "
    "names AS (SELECT DISTINCT lower(p_name) AS q, string_split(lower(p_name), ' ') AS w FROM part)"
)


@query(
    "must_not",
    f"""WITH {SQL_PART_TOK}
    SELECT q AS query_id, p_partkey FROM names JOIN tok ON term = w[1] WHERE NOT EXISTS
      (SELECT 1 FROM tok b WHERE b.p_partkey = tok.p_partkey AND b.term = names.w[len(names.w)])""",
)
def must_not(spark, sf_dir):
    """Per product name: parts with its first word but without its last."""
    names = C.table(spark, sf_dir, "part").select(F.lower("p_name").alias("query_id")).distinct()
    words = F.split("query_id", " ")
    wanted = names.select("query_id", F.get(words, 0).alias("term"))
    unwanted = names.select("query_id", F.element_at(words, -1).alias("term"))
    post = part_postings(spark, sf_dir)
    hits = match.match_terms(post, wanted).select("query_id", "p_partkey")
    return match.exclude(hits, post, unwanted, "p_partkey")


SQL_PHRASES = (
    f"ph AS (SELECT item_id AS query_id, generate_subscripts(t, 1) - 1 AS offset_, unnest(t) AS term FROM "
    f"(SELECT item_id, {C.GENERAL_ARRAY} AS t FROM benchmark)), size AS (SELECT query_id, count(*) AS words FROM ph GROUP BY 1)"
)


@query(
    "phrase_match",
    f"""WITH {C.SQL_TOK}, {SQL_PHRASES}
    SELECT query_id, doc_id, CAST(start AS BIGINT) AS start FROM
     (SELECT query_id, doc_id, pos - offset_ AS start, count(*) AS got FROM tok JOIN ph USING (term) GROUP BY ALL)
     JOIN size USING (query_id) WHERE got = words""",
)
def phrase_match(spark, sf_dir):
    """Where documents hold a whole benchmark item word for word."""
    items = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return lookup.phrase_places(C.text_index(spark, sf_dir), lookup.place_clauses(items, "text", C.GENERAL))


@query(
    "auto_phrase",
    r"""WITH p AS (SELECT c_custkey, c_name, regexp_extract_all(c_name, '[\p{L}]+|[0-9]+') AS parts FROM customer)
    SELECT a.c_name AS query_id, b.c_custkey, CAST(0 AS BIGINT) AS start FROM p a JOIN p b ON a.parts = b.parts WHERE len(a.parts) > 1""",
)
def auto_phrase(spark, sf_dir):
    """Query words that split into several parts are phrases of their parts."""
    names = C.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    chain = Analyzer("split", T.tok_whitespace, (), (("slots", T.word_delimiter(catenate=False)), ("term", F.lower)))
    words = names.select(F.explode(T.tok_whitespace(F.col("c_name"))).alias("word")).distinct()
    return match.phrase_match(cut(token_rows(names, "c_name", chain)), match.auto_phrases(words, "word"), "c_custkey")


PATTERNS = ["th*", "*tion", "a*e", "?he", "ou??", "*", "*eau*", "ün*"]
SQL_PATTERNS = "pats AS (SELECT unnest([" + ", ".join(f"'{p}'" for p in PATTERNS) + "]) AS pattern), found AS (SELECT pattern, term, df, ttf FROM pats JOIN stats ON term LIKE replace(replace(pattern, '*', '%'), '?', '_'))"


def pattern_table(spark):
    return literal_table(spark, [(p, p) for p in PATTERNS], "query_id string, pattern string")


@query(
    "wildcard_expand",
    f"""WITH {C.SQL_STATS}, {SQL_PATTERNS}
    SELECT pattern AS query_id, pattern, term, df, ttf, count(*) OVER (PARTITION BY pattern) AS n_terms FROM found""",
)
def wildcard_expand(spark, sf_dir):
    return match.expand_wildcards(C.text_index(spark, sf_dir).stats, pattern_table(spark), C.vocabulary(spark, sf_dir))


@query(
    "wildcard_match",
    f"""WITH {C.SQL_STATS}, {SQL_PATTERNS}
    SELECT pattern AS query_id, doc_id, count(*) AS n_terms, CAST(1.0 AS DOUBLE) AS score
    FROM found JOIN post USING (term) GROUP BY pattern, doc_id""",
)
def wildcard_match(spark, sf_dir):
    index = C.text_index(spark, sf_dir)
    return match.wildcard_match(index.postings, index.stats, pattern_table(spark), "doc_id", C.vocabulary(spark, sf_dir))


@query("match_all", "SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM documents")
def match_all(spark, sf_dir):
    return match.match_all(C.table(spark, sf_dir, "documents"), "doc_id")


@query(
    "range_filter",
    """SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 200000
    AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-01-01' AND o_custkey > 10""",
)
def range_filter(spark, sf_dir):
    orders = C.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    return match.with_filters(
        orders,
        [
            match.range_filter(F.col("o_totalprice"), 100000, 200000, True, False),
            (day >= F.lit("1996-01-01").cast("timestamp")) & (day <= F.lit("1997-01-01").cast("timestamp")),
            match.range_filter(F.col("o_custkey"), 10, "*", include_low=False),
        ],
    ).select("o_orderkey")


@query(
    "doc_filter",
    """WITH s AS (SELECT CASE WHEN turn = 0 THEN 'c' || conv_id ELSE 'c' || conv_id || '.' || turn END AS docOID FROM conversations)
    SELECT docOID FROM s WHERE docOID = 'c4' OR starts_with(docOID, 'c4.')""",
)
def doc_filter(spark, sf_dir):
    from lexshelf.operators.build import section_key

    return match.doc_filter(C.sections(spark, sf_dir).select(section_key().alias("docOID")), "docOID", "c4")


SELECTIONS = [
    ("q1", '["p_brand:Brand%233", "p_brand:Brand%237", "p_type:ECONOMY"]'),
    ("q2", '["p_size:5", "p_size:6", "p_size:7", "nonsense"]'),
    ("q3", '["p_type:STANDARD", "p_type:SMALL", "p_brand:Brand%231", "p_size:10"]'),
]


@query(
    "drill_down",
    """SELECT 'q1' AS query_id, p_partkey FROM part WHERE p_brand IN ('Brand#3', 'Brand#7') AND p_type = 'ECONOMY'
    UNION ALL SELECT 'q2', p_partkey FROM part WHERE p_size IN (5, 6, 7)
    UNION ALL SELECT 'q3', p_partkey FROM part WHERE p_type IN ('STANDARD', 'SMALL') AND p_brand = 'Brand#1' AND p_size = 10""",
)
def drill_down(spark, sf_dir):
    asked = literal_table(spark, SELECTIONS, "query_id string, selections string")
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return match.drill_down(parts, asked, "p_partkey", ["p_brand", "p_type", "p_size"])


@query("drill_down_predicate", "SELECT p_partkey, p_name FROM part WHERE p_brand IN ('Brand#3', 'Brand#7') AND p_size BETWEEN 1 AND 30")
def drill_down_predicate(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part")
    keep = match.selection_filter({"p_brand": ["Brand#3", "Brand#7"], "p_size": list(range(1, 31))}, parts)
    return parts.filter(keep).select("p_partkey", "p_name")


@query(
    "filter_queries",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24",
)
def filter_queries(spark, sf_dir):
    lines = C.table(spark, sf_dir, "lineitem")
    kept = match.with_filters(
        lines, [F.col("l_returnflag") == "R", F.col("l_discount").between(0.05, 0.07), F.col("l_quantity") < 24]
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "hit_fields",
    f"""WITH {C.SQL_SCORES}, top AS (SELECT * FROM (SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM hits) WHERE rank <= 5)
    SELECT query_id, doc_id, score, lang, source, n_chars FROM top JOIN documents USING (doc_id)""",
)
def hit_fields(spark, sf_dir):
    """Stored fields are looked up for the best hits only."""
    top = lookup.best_documents(C.text_index(spark, sf_dir), C.clauses(spark, sf_dir), 5)
    return match.fetch_fields(top, C.table(spark, sf_dir, "documents"), "doc_id", ["lang", "source", "n_chars"])


@query("get_by_ids", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def get_by_ids(spark, sf_dir):
    ids = C.table(spark, sf_dir, "labels").filter("quality = 1")
    return match.get_by_ids(C.table(spark, sf_dir, "documents"), ids, "doc_id").select("doc_id", "lang", "n_chars")


def points(spark, sf_dir):
    """A point per customer, worked out from its key."""
    key = F.col("c_custkey")
    return C.table(spark, sf_dir, "customer").select(
        "c_custkey",
        ((key * 37 % 1800) / 10.0 - 90.0).alias("lat"),
        ((key * 91 % 3600) / 10.0 - 180.0).alias("lon"),
    )


SQL_POINTS = "pts AS (SELECT c_custkey, (c_custkey * 37 % 1800) / 10.0 - 90.0 AS lat, (c_custkey * 91 % 3600) / 10.0 - 180.0 AS lon FROM customer)"
SQL_DIST = "2 * 6371.0087714 * asin(sqrt(least(1.0, pow(sin((radians(10.0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(10.0)) * pow(sin((radians(10.0) - radians(lon)) / 2), 2))))"


@query(
    "spatial_box",
    f"""WITH {SQL_POINTS}, b AS (SELECT degrees(2500 / 6371.0087714) AS dlat, degrees(asin(sin(2500 / 6371.0087714) / cos(radians(10.0)))) AS dlon)
    SELECT c_custkey FROM pts, b WHERE lat BETWEEN 10 - dlat AND 10 + dlat AND lon BETWEEN 10 - dlon AND 10 + dlon""",
)
def spatial_box(spark, sf_dir):
    return points(spark, sf_dir).filter(bbox(F.col("lat"), F.col("lon"), 10.0, 10.0, 2500.0)).select("c_custkey")


@query("spatial_distance", f"WITH {SQL_POINTS} SELECT c_custkey, round({SQL_DIST}, 3) AS km FROM pts WHERE {SQL_DIST} <= 2500")
def spatial_distance(spark, sf_dir):
    """The box first, as it is cheap, then the exact distance."""
    lat, lon = F.col("lat"), F.col("lon")
    near = points(spark, sf_dir).filter(bbox(lat, lon, 10.0, 10.0, 2500.0))
    near = near.withColumn("_km", geo_dist(lat, lon, F.lit(10.0), F.lit(10.0))).filter("_km <= 2500")
    return near.select("c_custkey", F.round("_km", 3).alias("km")).orderBy("km", "c_custkey")


def sql_rates() -> str:
    from lexshelf.functions.words import RATES

    return "usd AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', CAST({r} AS DOUBLE))" for f, t, r in RATES if f == "USD") + ") AS v(code, rate))"


@query(
    "currency_range",
    f"""WITH {sql_rates()}, priced AS (SELECT p_partkey, p_retailprice AS amount, ['USD', 'EUR', 'GBP', 'JPY', NULL, 'XXX'][1 + p_partkey % 6] AS code FROM part),
    conv AS (SELECT p_partkey, coalesce(code, 'USD') AS code, amount FROM priced),
    inusd AS (SELECT p_partkey, c.code, CASE WHEN c.code = 'USD' THEN amount ELSE amount * (1 / rate) END AS usd FROM conv c LEFT JOIN usd ON usd.code = c.code)
    SELECT p_partkey, round(usd, 4) AS usd FROM inusd WHERE usd BETWEEN 5 AND 1300""",
)
def currency_range(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY", None, "XXX")])
    parts = C.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").alias("amount"), F.get(codes, (F.col("p_partkey") % 6).cast("int")).alias("code")
    )
    in_usd = money.convert(parts, "amount", "code", money.default_rates(spark), "USD", "usd")
    return in_usd.filter(F.col("usd").between(5, 1300)).select("p_partkey", F.round("usd", 4).alias("usd"))


@query(
    "currency_cross_rate",
    f"""WITH {sql_rates()}, priced AS (SELECT p_partkey, p_retailprice AS amount, ['EUR', 'NOK', 'GBP', 'CHF'][1 + p_partkey % 4] AS code FROM part)
    SELECT p_partkey, code, round(CASE code WHEN 'NOK' THEN amount WHEN 'EUR' THEN amount * 7.800095 WHEN 'GBP' THEN amount * 8.966508
      ELSE amount * ((1 / (SELECT rate FROM usd WHERE usd.code = 'CHF')) * (SELECT rate FROM usd WHERE usd.code = 'NOK')) END, 8) AS nok FROM priced""",
)
def currency_cross_rate(spark, sf_dir):
    """Listed cross rates first, others by way of USD."""
    codes = F.array(*[F.lit(c) for c in ("EUR", "NOK", "GBP", "CHF")])
    parts = C.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").alias("amount"), F.get(codes, (F.col("p_partkey") % 4).cast("int")).alias("code")
    )
    converted = money.convert(parts, "amount", "code", money.default_rates(spark), "NOK", "nok")
    return converted.select("p_partkey", "code", F.round("nok", 8).alias("nok"))


@query("augment", "SELECT c_custkey, 'part of the catalogue' AS note, c_acctbal > 5000 AS boosted FROM customer")
def augment(spark, sf_dir):
    rows = C.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return match.augment(rows, {"note": F.lit("part of the catalogue"), "boosted": F.col("c_acctbal") > 5000}).drop("c_acctbal")


@query(
    "join_documents",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 0)",
)
def join_documents(spark, sf_dir):
    chosen = C.table(spark, sf_dir, "customer").filter((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 0))
    orders = C.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return match.join_docs(orders, chosen, "o_custkey", "c_custkey")


@query(
    "sections_of_documents",
    f"""WITH {C.SQL_SECTIONS} SELECT s.docOID, s.doc_oid, d.org[1] AS organization FROM sections s JOIN sections d ON d.doc_oid = s.doc_oid AND d.sec_no = 1 WHERE s.role = 'assistant'""",
)
def sections_of_documents(spark, sf_dir):
    from lexshelf.operators.build import meta_values, section_key

    rows = C.sections(spark, sf_dir)
    hits = rows.filter(F.array_contains(meta_values("dc.Subject"), "assistant")).select(section_key().alias("docOID"))
    docs = rows.filter("sec_no = 1").select("doc_oid", F.get(meta_values("dls.Organization"), 0).alias("organization"))
    return match.sections_of(hits, docs, "docOID", "doc_oid")


@query(
    "facet_labels",
    """WITH counts AS (SELECT 'nation' AS field, CAST(c_nationkey AS VARCHAR) AS value, count(*) AS count FROM customer GROUP BY 2),
    labels AS (SELECT 'nation' AS field, CAST(n_nationkey AS VARCHAR) AS value, CASE WHEN n_nationkey = 5 THEN 'es' WHEN n_nationkey % 3 = 0 THEN 'fr' ELSE 'en' END AS lang, n_name AS label FROM nation)
    SELECT c.field, c.value, c.count, coalesce(f.label, e.label, c.value) AS label FROM counts c
     LEFT JOIN labels f ON f.value = c.value AND f.lang = 'fr' LEFT JOIN labels e ON e.value = c.value AND e.lang = 'en'""",
)
def facet_labels(spark, sf_dir):
    from lexshelf.operators.facets import facet_fields

    customers = C.table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    labels = C.table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("field"),
        F.col("n_nationkey").cast("string").alias("value"),
        F.when(F.col("n_nationkey") == 5, "es").when(F.col("n_nationkey") % 3 == 0, "fr").otherwise("en").alias("lang"),
        F.col("n_name").alias("label"),
    )
    return match.label_facets(facet_fields(customers, ["nation"]), labels, "fr")


@query(
    "date_math",
    """SELECT event_id, date_trunc('year', ts) - INTERVAL 10 YEAR AS decade_ago, date_trunc('hour', ts) + INTERVAL 1 DAY - INTERVAL 30 MINUTE AS next_day,
    date_trunc('month', ts + INTERVAL 2 MONTH) AS month_start FROM events""",
)
def date_math_query(spark, sf_dir):
    ts = F.col("ts")
    return C.table(spark, sf_dir, "events").select(
        "event_id",
        date_math(ts, "/YEAR-10YEARS").alias("decade_ago"),
        date_math(ts, "/HOUR+1DAY-30MINUTES").alias("next_day"),
        date_math(ts, "+2MONTHS/MONTH").alias("month_start"),
    )

"""Registered queries: facets, groups, statistics, term lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions import words as W
from lexshelf.functions.analyzers import query_rows
from lexshelf.operators import facets, match, postings
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query
from lexshelf.plans.matching import benchmark_matches
from lexshelf.plans.ranking import SQL_ROUNDED, benchmark_hits
from lexshelf.session import cut, literal_table


@query(
    "facet_fields",
    """SELECT 'p_brand' AS field, p_brand AS value, count(*) AS count FROM part GROUP BY 2 HAVING count(*) >= 5
    UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2 HAVING count(*) >= 5
    UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY 2 HAVING count(*) >= 5
    UNION ALL SELECT 'words', w, count(DISTINCT p_partkey) FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 2 HAVING count(DISTINCT p_partkey) >= 5""",
)
def facet_fields(spark, sf_dir):
    """Four fields, one of them multi-valued, in one pass."""
    parts = C.table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size", F.split("p_name", " ").alias("words"))
    return facets.facet_fields(parts, ["p_brand", "p_type", "p_size", "words"], mincount=5)


@query(
    "facet_hits",
    f"""WITH {C.SQL_MATCH}, h AS (SELECT DISTINCT query_id, doc_id FROM matches), j AS (SELECT query_id, lang, source FROM h JOIN documents USING (doc_id))
    SELECT query_id, 'lang' AS field, lang AS value, count(*) AS count FROM j GROUP BY ALL UNION ALL SELECT query_id, 'source', source, count(*) FROM j GROUP BY ALL""",
)
def facet_hits(spark, sf_dir):
    """Facets over the documents that match each query."""
    matches, asked = benchmark_matches(spark, sf_dir)
    hits = match.boolean_match(matches, asked, "doc_id", "OR")
    return facets.facet_fields(C.table(spark, sf_dir, "documents"), ["lang", "source"], hits, "doc_id")


@query(
    "facet_queries",
    """SELECT 'cheap' AS query, count(*) FILTER (o_totalprice < 100000) AS count FROM orders
    UNION ALL SELECT 'urgent', count(*) FILTER (o_orderpriority LIKE '1%') FROM orders
    UNION ALL SELECT 'recent and open', count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'O') FROM orders""",
)
def facet_queries(spark, sf_dir):
    return facets.facet_queries(
        C.table(spark, sf_dir, "orders"),
        {
            "cheap": F.col("o_totalprice") < 100000,
            "urgent": F.col("o_orderpriority").startswith("1"),
            "recent and open": (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp")) & (F.col("o_orderstatus") == "O"),
        },
    )


@query(
    "facet_range",
    """WITH b AS (SELECT CASE WHEN p_size < 10 THEN -1 WHEN p_size >= 42 THEN 4 ELSE CAST(floor((p_size - 10) / 8) AS INTEGER) END AS b, count(*) AS n FROM part GROUP BY 1),
    s AS (SELECT unnest(range(-1, 5)) AS b)
    SELECT CASE WHEN b < 0 THEN 'before' WHEN b > 3 THEN 'after' ELSE 'range' END AS part, CASE WHEN b BETWEEN 0 AND 3 THEN 10.0 + b * 8.0 END::DOUBLE AS low, coalesce(n, 0) AS count FROM s LEFT JOIN b USING (b)""",
)
def facet_range(spark, sf_dir):
    return facets.facet_range(C.table(spark, sf_dir, "part"), "p_size", 10, 42, 8)


@query(
    "facet_range_empty_buckets",
    """WITH b AS (SELECT CASE WHEN o_totalprice < 0 THEN -1 WHEN o_totalprice >= 1000000 THEN 20 ELSE CAST(floor(o_totalprice / 50000) AS INTEGER) END AS b, count(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT unnest(range(-1, 21)) AS b)
    SELECT CASE WHEN b < 0 THEN 'before' WHEN b > 19 THEN 'after' ELSE 'range' END AS part, CASE WHEN b BETWEEN 0 AND 19 THEN b * 50000.0 END::DOUBLE AS low, coalesce(n, 0) AS count FROM s LEFT JOIN b USING (b)""",
)
def facet_range_empty_buckets(spark, sf_dir):
    return facets.facet_range(C.table(spark, sf_dir, "orders"), "o_totalprice", 0, 1000000, 50000)


@query(
    "facet_date",
    """WITH b AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN -1 WHEN o_orderdate >= TIMESTAMP '2003-01-01' THEN 7 ELSE CAST(year(o_orderdate) - 1996 AS INTEGER) END AS b, count(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT unnest(range(-1, 8)) AS b)
    SELECT CASE WHEN b < 0 THEN 'before' WHEN b > 6 THEN 'after' ELSE 'range' END AS part, CASE WHEN b BETWEEN 0 AND 6 THEN make_timestamp(1996 + b, 1, 1, 0, 0, 0) END AS low, coalesce(n, 0) AS count FROM s LEFT JOIN b USING (b)""",
)
def facet_date(spark, sf_dir):
    """Years, from ten years before the given now."""
    return facets.facet_date(C.table(spark, sf_dir, "orders"), "o_orderdate", "NOW/YEAR-10YEARS", "NOW/MONTH-42MONTHS", "+1YEAR", now="2006-01-20")


@query(
    "facet_date_months",
    """WITH b AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN -1 WHEN ts >= TIMESTAMP '2024-07-15' THEN 2 WHEN ts >= TIMESTAMP '2024-04-15' THEN 1 ELSE 0 END AS b, count(*) AS n FROM events GROUP BY 1)
    SELECT CASE b WHEN -1 THEN 'before' WHEN 2 THEN 'after' ELSE 'range' END AS part, CASE b WHEN 0 THEN TIMESTAMP '2024-01-15' WHEN 1 THEN TIMESTAMP '2024-04-15' END AS low, n AS count FROM b WHERE n >= 1""",
)
def facet_date_months(spark, sf_dir):
    return facets.facet_date(C.table(spark, sf_dir, "events"), "ts", "2024-01-15", "2024-07-15", "+3MONTHS", mincount=1)


@query(
    "facet_date_days",
    """WITH e AS (SELECT unnest(range(-1, 8)) AS b), n AS (SELECT CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-30')) / 259200) AS BIGINT) AS k FROM events),
    c AS (SELECT CASE WHEN k < 0 THEN -1 WHEN k > 6 THEN 7 ELSE k END AS b, count(*) AS n FROM n GROUP BY 1)
    SELECT CASE WHEN b < 0 THEN 'before' WHEN b > 6 THEN 'after' ELSE 'range' END AS part,
     CASE WHEN b BETWEEN 0 AND 6 THEN TIMESTAMP '2024-01-30' + to_days(CAST(3 * b AS INTEGER)) END AS low, coalesce(n, 0) AS count FROM e LEFT JOIN c USING (b)""",
)
def facet_date_days(spark, sf_dir):
    """Steps of three days over the end of a month."""
    return facets.facet_date(C.table(spark, sf_dir, "events"), "ts", "2024-01-30", "2024-02-18", "+3DAYS")


@query(
    "facet_pivot",
    """SELECT o_orderpriority, NULL AS o_orderstatus, count(*) AS count, 1 AS level FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, o_orderstatus, count(*), 2 FROM orders GROUP BY 1, 2""",
)
def facet_pivot(spark, sf_dir):
    return facets.facet_pivot(C.table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "group_results",
    f"""WITH {SQL_ROUNDED}, j AS (SELECT query_id, doc_id, score, CASE WHEN source <> 'src1' THEN source END AS group_value FROM r JOIN documents USING (doc_id)),
    s AS (SELECT *, count(*) OVER (PARTITION BY query_id, group_value) AS group_size, row_number() OVER (PARTITION BY query_id, group_value ORDER BY score DESC, doc_id) AS rank FROM j),
    m AS (SELECT query_id, count(*) AS matches, count(DISTINCT coalesce(group_value, '-none-')) AS n_groups FROM j GROUP BY 1)
    SELECT query_id, doc_id, score, group_value, rank, group_size, CAST(matches AS BIGINT) AS matches, n_groups FROM s JOIN m USING (query_id) WHERE rank <= 2""",
)
def group_results(spark, sf_dir):
    """Two best hits per source of each query; one source stands in for 'no value'."""
    index = C.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("source") != "src1", F.col("source")).alias("source")
    )
    hits = cut(benchmark_hits(spark, sf_dir).select("query_id", "doc_id", "score"))
    return facets.group_results(hits, index, "doc_id", "source", 2)


SQL_FIELD_STATS = """min({c}) AS min, max({c}) AS max, round(sum({c}), 2) AS sum, count({c}) AS count, count(*) - count({c}) AS missing,
 round(sum({c} * {c}), 1) AS sum_of_squares, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev"""


def rounded_stats(df):
    return df.withColumns(
        {"sum": F.round("sum", 2), "sum_of_squares": F.round("sum_of_squares", 1), "mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    )


@query("field_stats", "SELECT " + SQL_FIELD_STATS.format(c="v") + " FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS v FROM events)")
def field_stats(spark, sf_dir):
    events = C.table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return rounded_stats(facets.field_stats(events, "v"))


@query("field_stats_by_facet", "SELECT l_returnflag, l_linestatus, " + SQL_FIELD_STATS.format(c="l_quantity") + " FROM lineitem GROUP BY ALL")
def field_stats_by_facet(spark, sf_dir):
    return rounded_stats(facets.field_stats(C.table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag", "l_linestatus"]))


@query("terms_by_count", f"WITH {C.SQL_STATS} SELECT term, df FROM stats ORDER BY df DESC, term LIMIT 50")
def terms_by_count(spark, sf_dir):
    return postings.terms(C.text_index(spark, sf_dir).stats, limit=50)


@query("terms_by_prefix", f"WITH {C.SQL_STATS} SELECT term, df FROM stats WHERE term LIKE 'th%' ORDER BY term LIMIT 100")
def terms_by_prefix(spark, sf_dir):
    return postings.terms(C.text_index(spark, sf_dir).stats, "th", "index", 100)


@query("query_term_statistics", f"WITH {C.SQL_MATCH} SELECT query_id, term, doc_id, tf, df, ttf FROM matches JOIN stats USING (term)")
def query_term_statistics(spark, sf_dir):
    index = C.text_index(spark, sf_dir)
    return facets.term_counts(index.postings, C.clauses(spark, sf_dir), "doc_id", index.stats)


@query(
    "term_vectors",
    f"""WITH {C.SQL_STATS} SELECT doc_id, term, tf, df, round(tf / df, 6) AS tf_idf FROM post JOIN stats USING (term) WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def term_vectors(spark, sf_dir):
    """Vectors of the documents labelled toxic."""
    docs = C.table(spark, sf_dir, "labels").filter("toxic = 1")
    index = C.text_index(spark, sf_dir)
    vectors = postings.term_vectors(index.postings, "doc_id", docs, index.stats)
    return vectors.withColumn("tf_idf", F.round("tf_idf", 6))


SQL_RUNS = T.RUNS.replace("'", "''")


@query(
    "term_offsets",
    f"""WITH r AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS run FROM (SELECT doc_id, regexp_extract_all(text, '{SQL_RUNS}') AS t FROM documents)),
    o AS (SELECT *, regexp_matches(run, '^[{T.WORD_CHARS}]') AS word, coalesce(sum(length(run)) OVER w, 0) AS start, coalesce(sum(CASE WHEN regexp_matches(run, '^[{T.WORD_CHARS}]') THEN 1 ELSE 0 END) OVER w, 0) AS pos
      FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT doc_id, lower(run) AS term, CAST(pos AS BIGINT) AS pos, CAST(start AS BIGINT) AS start, CAST(start + length(run) AS BIGINT) AS "end" FROM o WHERE word""",
)
def term_offsets(spark, sf_dir):
    """Every token of every document with its place and its characters in the text."""
    return postings.token_offsets(C.documents(spark, sf_dir), "doc_id", "text")


@query(
    "query_stop_words",
    f"""SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest({C.GENERAL_ARRAY}) AS term FROM benchmark)
    WHERE term IN ({", ".join("'" + w + "'" for w in W.STOP_EN)})""",
)
def query_stop_words(spark, sf_dir):
    listed = literal_table(spark, [(w,) for w in W.STOP_EN], "word string")
    items = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return facets.query_stop_words(query_rows(items, "text", C.GENERAL), listed)

"""Registered queries: highlighting, spelling, suggestions, similar documents, clusters, browsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions.analyzers import token_rows
from lexshelf.operators import discover, highlight, postings, spelling
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query
from lexshelf.plans.analysis import PATH
from lexshelf.plans.matching import LOWER
from lexshelf.plans.ranking import SQL_ROUNDED, benchmark_best
from lexshelf.session import cut

SQL_TOP3 = (
    f"{SQL_ROUNDED}, top AS (SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 3), "
    f"qt AS (SELECT item_id AS query_id, {C.GENERAL_ARRAY} AS terms FROM benchmark), "
    "rows AS (SELECT query_id, doc_id, text, terms FROM top JOIN documents USING (doc_id) JOIN qt USING (query_id))"
)
SQL_RUNS = T.RUNS.replace("'", "''")


def sql_tagged(text: str, pre: str, post: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '{SQL_RUNS}'), "
        f"lambda x: CASE WHEN list_contains(terms, lower(x)) THEN '{pre}' || x || '{post}' ELSE x END), '')"
    )


def top_texts(spark, sf_dir):
    """Text and query terms of the three best hits of every query."""
    top = cut(benchmark_best(spark, sf_dir, 3).select("query_id", "doc_id"))
    asked = C.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.array_distinct(C.GENERAL(F.col("text"))).alias("terms")
    )
    # stored hits: Spark sees how few they are, and brings them to the texts
    return C.table(spark, sf_dir, "documents").select("doc_id", "text").join(top, "doc_id").join(asked, "query_id")


@query("highlighted_documents", f"WITH {SQL_TOP3} SELECT query_id, doc_id, {sql_tagged('text', *highlight.DOC_TAGS)} AS highlighted FROM rows")
def highlighted_documents(spark, sf_dir):
    rows = highlight.highlight_doc(top_texts(spark, sf_dir), "text", "terms")
    return rows.select("query_id", "doc_id", "highlighted")


SQL_SNIPPETS = rf"""{SQL_TOP3}, frag AS (SELECT query_id, doc_id, terms, generate_subscripts(f, 1) AS i, unnest(f) AS fragment FROM
  (SELECT *, regexp_extract_all(text, '(?s)\S.{{0,99}}\S*') AS f FROM rows)),
 rated AS (SELECT *, list_filter(list_transform({C.sql_tokens('fragment')}, lambda x: lower(x)), lambda x: list_contains(terms, x)) AS found FROM frag),
 best AS (SELECT *, len(list_distinct(found)) AS n_terms, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY len(list_distinct(found)) DESC, len(found) DESC, i) - 1 AS snippet_no FROM rated WHERE len(found) > 0)"""


@query(
    "snippets",
    f"WITH {SQL_SNIPPETS} SELECT query_id, doc_id, snippet_no, n_terms, {sql_tagged('fragment', *highlight.SNIPPET_TAGS)} AS snippet FROM best WHERE snippet_no < 3",
)
def snippets(spark, sf_dir):
    return highlight.snippets(top_texts(spark, sf_dir), "text", "terms")


@query(
    "snippet_or_alternate",
    f"""WITH rows AS (SELECT lang AS query_id, doc_id, text, ['the', 'der'] AS terms FROM documents),
    frag AS (SELECT query_id, doc_id, terms, generate_subscripts(f, 1) AS i, unnest(f) AS fragment FROM (SELECT *, regexp_extract_all(text, '(?s)\\S.{{0,199}}\\S*') AS f FROM rows)),
    rated AS (SELECT *, list_filter(list_transform({C.sql_tokens('fragment')}, lambda x: lower(x)), lambda x: list_contains(terms, x)) AS found FROM frag),
    best AS (SELECT * FROM rated WHERE len(found) > 0 QUALIFY row_number() OVER (PARTITION BY query_id, doc_id ORDER BY len(list_distinct(found)) DESC, len(found) DESC, i) = 1),
    shown AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(fragment, '{SQL_RUNS}'),
       lambda x: CASE WHEN list_contains(terms, lower(x)) THEN '<b>' || {C.sql_escape('x')} || '</b>' ELSE {C.sql_escape('x')} END), '') AS s FROM best)
    SELECT query_id, doc_id, coalesce(s, {C.sql_escape("left(text, 50)")}) AS shown FROM rows LEFT JOIN shown USING (doc_id)""",
)
def snippet_or_alternate(spark, sf_dir):
    """Every document's best snippet for a fixed query, or else how it begins."""
    docs = C.documents(spark, sf_dir, "text", "lang")
    rows = docs.select(F.col("lang").alias("query_id"), "doc_id", "text", F.array(F.lit("the"), F.lit("der")).alias("terms"))
    parts = highlight.snippets(rows, "text", "terms", 1, 200, ("<b>", "</b>"), encode=True)
    hits = rows.select("query_id", "doc_id")
    return highlight.with_alternate(hits, parts, docs, "doc_id", "text", 50).select("query_id", "doc_id", "shown")


@query(
    "more_like_this",
    f"""WITH {SQL_TOP3}, src AS (SELECT DISTINCT doc_id AS query_id FROM top),
    w AS (SELECT query_id, term, round(tf * (1 + ln(n / (df + 1))), 9) AS w FROM src JOIN post ON doc_id = query_id JOIN stats USING (term), n WHERE tf >= 2 AND df >= 5),
    cl AS (SELECT query_id, term FROM w QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY w DESC, term) <= 25),
    h2 AS (SELECT query_id, doc_id, round(sum(sqrt(tf) * pow(1 + ln(n / (df + 1)), 2) / sqrt(len)), 6) AS score FROM cl JOIN post USING (term) JOIN stats USING (term), n WHERE doc_id <> query_id GROUP BY ALL)
    SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM h2 QUALIFY rank <= 3""",
)
def more_like_this(spark, sf_dir):
    """Three documents like each of the queries' best hits."""
    index = C.text_index(spark, sf_dir)
    sources = benchmark_best(spark, sf_dir, 3).select("doc_id").distinct()
    return discover.more_like_this(index.postings, sources, "doc_id", index.count(), stats=index.stats, parts=index.parts(), max_terms=25, min_tf=2, min_df=5)


@query(
    "more_like_this_fields",
    """WITH t AS (SELECT p_partkey, 'name' AS field, string_split(lower(p_name), ' ') AS t FROM part UNION ALL SELECT p_partkey, 'type', [lower(p_type)] FROM part),
    post AS (SELECT p_partkey, field, len(t) AS len, term, count(*) AS tf FROM (SELECT p_partkey, field, t, unnest(t) AS term FROM t) GROUP BY ALL),
    st AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL), n AS (SELECT count(*) AS n FROM part),
    src AS (SELECT p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1),
    cl AS (SELECT p_partkey AS query_id, field, term FROM post WHERE p_partkey IN (SELECT * FROM src)),
    h AS (SELECT query_id, p_partkey, round(sum(sqrt(tf) * pow(1 + ln(n / (df + 1)), 2) * CASE field WHEN 'name' THEN 2.0 ELSE 0.5 END / sqrt(len)), 6) AS score
      FROM cl JOIN post USING (field, term) JOIN st USING (field, term), n WHERE p_partkey <> query_id GROUP BY ALL)
    SELECT query_id, p_partkey, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_partkey) AS rank FROM h QUALIFY rank <= 5""",
)
def more_like_this_fields(spark, sf_dir):
    """Five parts like the dearest of each brand, by the words of two weighted fields."""
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    fields = {"name": "p_name", "type": "p_type"}
    post = [postings.postings_of(parts, "p_partkey", c, LOWER).withColumn("field", F.lit(f)) for f, c in fields.items()]
    dearest = F.max(F.struct("p_retailprice", (-F.col("p_partkey")).alias("_k")))["_k"]
    sources = parts.groupBy("p_brand").agg((-dearest).alias("p_partkey"))
    count = parts.select(F.count(F.lit(1))).scalar()
    return discover.more_like_this(cut(post[0].union(post[1])), sources, "p_partkey", count, 5, {"name": 2.0, "type": 0.5})


def index_words(spark, sf_dir):
    return C.text_index(spark, sf_dir, LOWER).stats


def benchmark_words(spark, sf_dir):
    items = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return token_rows(items, "text", LOWER).withColumnRenamed("term", "word")


# the twin's edit distance counts bytes: letters of several bytes become one-byte signs first
WIDE = "éèêëçàáâäãùúûüîïíìôóöòõñßÿæœ’"
NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123"
SQL_LOWER_STATS = C.SQL_STATS.replace(C.GENERAL_ARRAY, f"list_transform({C.sql_tokens('text')}, lambda x: lower(x))")
SQL_BENCH_WORDS = f"bw AS (SELECT item_id AS query_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS word FROM (SELECT item_id, {C.sql_tokens('lower(text)')} AS t FROM benchmark))"


@query(
    "spelling",
    f"""WITH {SQL_LOWER_STATS}, {SQL_BENCH_WORDS}, n AS (SELECT count(*) AS n FROM documents),
    rare AS (SELECT DISTINCT word FROM bw LEFT JOIN stats ON term = word, n WHERE length(word) >= 4 AND coalesce(df, 0) <= n * 0.01),
    pairs AS (SELECT word, term, df, levenshtein(translate(word, '{WIDE}', '{NARROW}'), translate(term, '{WIDE}', '{NARROW}')) AS distance
      FROM rare JOIN stats ON left(term, 1) = left(word, 1) AND abs(length(term) - length(word)) <= 2)
    SELECT word, term AS suggestion, distance, df, row_number() OVER (PARTITION BY word ORDER BY distance, df DESC, term) AS rank FROM pairs
    WHERE distance BETWEEN 1 AND 2 AND 1 - distance / least(length(word), length(term)) >= 0.5 QUALIFY rank <= 10""",
)
def spelling_query(spark, sf_dir):
    """Suggestions for the rare words of all queries."""
    stats = index_words(spark, sf_dir)
    words = benchmark_words(spark, sf_dir).select("word")
    return spelling.spellcheck(stats, words, C.count_docs(spark, sf_dir), 10, vocabulary=C.vocabulary(spark, sf_dir, LOWER))


@query(
    "word_breaks",
    f"""WITH {SQL_LOWER_STATS.replace("stats AS (", "stats AS MATERIALIZED (")}, {SQL_BENCH_WORDS}, w AS (SELECT DISTINCT word FROM bw WHERE length(word) >= 2),
    c AS MATERIALIZED (SELECT word, left(word, i) AS "left", substr(word, i + 1) AS "right" FROM (SELECT word, unnest(range(1, length(word))) AS i FROM w))
    SELECT word, "left", "right", a.df AS left_df, b.df AS right_df FROM c JOIN stats a ON a.term = c."left" JOIN stats b ON b.term = c."right" """,
)
def word_breaks(spark, sf_dir):
    return spelling.word_breaks(index_words(spark, sf_dir), benchmark_words(spark, sf_dir))


@query(
    "word_joins",
    f"""WITH {SQL_LOWER_STATS}, {SQL_BENCH_WORDS} SELECT a.query_id, a.pos, a.word || b.word AS term, df FROM bw a JOIN bw b ON a.query_id = b.query_id AND b.pos = a.pos + 1 JOIN stats ON term = a.word || b.word""",
)
def word_joins(spark, sf_dir):
    words = benchmark_words(spark, sf_dir).select("query_id", F.col("pos").alias("pos"), "word")
    return spelling.word_joins(index_words(spark, sf_dir), words)


def part_words(spark, sf_dir):
    """Product names as queries with a letter lost in the first word: (query_id, pos, word), and the index."""
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    names = parts.select(F.lower("p_name").alias("query_id")).distinct()
    words = names.select("query_id", F.posexplode(F.split("query_id", " ")).alias("pos", "word"))
    spoilt = F.when(
        (F.col("pos") == 0) & (F.length("word") >= 5), F.concat(F.left("word", F.lit(2)), F.substr("word", F.lit(4)))
    ).otherwise(F.col("word"))
    post = postings.postings_of(parts, "p_partkey", "p_name", LOWER)
    return cut(words.withColumn("word", spoilt)), cut(post)


@query(
    "collation",
    """WITH tok AS (SELECT DISTINCT p_partkey, unnest(string_split(lower(p_name), ' ')) AS term FROM part),
    stats AS (SELECT term, count(*) AS df FROM tok GROUP BY 1), n AS (SELECT count(*) AS n FROM part),
    names AS (SELECT DISTINCT lower(p_name) AS query_id, string_split(lower(p_name), ' ') AS w FROM part),
    q AS (SELECT query_id, CASE WHEN length(w[1]) >= 5 THEN left(w[1], 2) || substr(w[1], 4) ELSE w[1] END AS a, w[2] AS b FROM names),
    rare AS (SELECT DISTINCT a AS word FROM q WHERE length(a) >= 4 AND a NOT IN (SELECT term FROM stats)),
    sug AS (SELECT word, term, row_number() OVER (PARTITION BY word ORDER BY levenshtein(word, term), df DESC, term) AS rank FROM rare JOIN stats ON left(word, 1) = left(term, 1)
      WHERE levenshtein(word, term) BETWEEN 1 AND 2 AND 1 - levenshtein(word, term) / least(length(word), length(term)) >= 0.5 QUALIFY rank <= 5),
    opt AS (SELECT query_id, b, coalesce(s.term, a) AS first, CAST(coalesce(rank, 0) AS BIGINT) AS rank_sum FROM q LEFT JOIN sug s ON s.word = q.a)
    SELECT query_id, rank_sum, first || ' ' || b AS corrected, count(*) AS hits FROM opt JOIN tok x ON x.term = first JOIN tok y ON y.term = b AND y.p_partkey = x.p_partkey
    GROUP BY query_id, rank_sum, first, b QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank_sum, first) = 1""",
)
def collation(spark, sf_dir):
    """Misspelt product names corrected to queries that have hits."""
    words, post = part_words(spark, sf_dir)
    found = spelling.spellcheck(
        postings.term_stats(post), words, C.table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar(), 5, max_frequency=0.0
    )
    return spelling.collate(words, cut(found), post, "p_partkey")


@query(
    "suggestions",
    """WITH v AS (SELECT p_name AS value, max(p_retailprice) AS weight FROM part GROUP BY 1),
    q AS (SELECT DISTINCT p_name AS query_id, left(p_name, 2) || 'q' || substr(p_name, 4, 3) AS prefix FROM part WHERE length(p_name) >= 6)
    SELECT query_id, prefix, value, weight, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, value) AS rank FROM q JOIN v
     ON length(value) >= length(prefix) AND levenshtein(left(value, length(prefix)), prefix) <= 1 QUALIFY rank <= 10""",
)
def suggestions(spark, sf_dir):
    """The start of every product name with one wrong letter."""
    parts = C.table(spark, sf_dir, "part")
    starts = parts.filter(F.length("p_name") >= 6).select(
        F.col("p_name").alias("query_id"),
        F.concat(F.left("p_name", F.lit(2)), F.lit("q"), F.substr("p_name", F.lit(4), F.lit(3))).alias("prefix"),
    ).distinct()
    return spelling.suggest(parts, "p_name", "p_retailprice", starts)


@query("cluster_kmeans")
def cluster_kmeans(spark, sf_dir):
    return discover.cluster_kmeans(C.documents(spark, sf_dir), "doc_id", "text", LOWER)


@query(
    "cluster_phrases",
    f"""WITH a AS (SELECT doc_id, list_transform({C.sql_tokens('text')}, lambda x: lower(x)) AS t FROM documents),
    g AS (SELECT DISTINCT doc_id, phrase FROM (SELECT doc_id, unnest(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' '))) AS phrase FROM a)),
    c AS (SELECT phrase, count(*) AS size FROM g GROUP BY 1 HAVING count(*) >= 2)
    SELECT phrase, size, doc_id FROM g JOIN c USING (phrase)""",
)
def cluster_phrases(spark, sf_dir):
    return discover.cluster_phrases(C.documents(spark, sf_dir), "doc_id", "text", LOWER)


@query(
    "browse_list",
    "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 100 AS shelf FROM orders",
)
def browse_list(spark, sf_dir):
    return discover.browse_list(C.table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice", 100)


@query(
    "browse_groups",
    """SELECT p_brand AS node, p_name, p_partkey, count(*) OVER (PARTITION BY p_brand) AS count,
    row_number() OVER (ORDER BY p_brand, p_name, p_partkey) AS place FROM part""",
)
def browse_groups(spark, sf_dir):
    """Documents under each value, by title, with the value's size."""
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    sizes = parts.groupBy(F.col("p_brand").alias("node")).agg(F.count(F.lit(1)).alias("count"))
    return discover.browse_leaves(parts, "p_partkey", "p_brand", "p_name").join(sizes, "node").orderBy("place")


@query(
    "browse_tree",
    rf"""WITH p AS (SELECT regexp_extract(url, '{PATH}', 1) AS path FROM pages), s AS (SELECT string_split(path, '/') AS s FROM p),
    h AS (SELECT array_to_string(s[1:i], '/') AS node FROM (SELECT s, unnest(range(1, len(s) + 1)) AS i FROM s))
    SELECT node, count(*) AS count, CAST(len(string_split(node, '/')) AS INTEGER) AS depth FROM h WHERE node <> '' GROUP BY node""",
)
def browse_tree(spark, sf_dir):
    pages = C.table(spark, sf_dir, "pages").select(F.regexp_extract("url", PATH, 1).alias("path"))
    return discover.browse_tree(pages, "path")


@query(
    "browse_tree_leaves",
    rf"""WITH p AS (SELECT page_id, regexp_extract(url, '{PATH}', 1) AS node, url FROM pages)
    SELECT node, url, page_id, row_number() OVER (ORDER BY node, url, page_id) AS place FROM p WHERE node <> ''""",
)
def browse_tree_leaves(spark, sf_dir):
    """The pages at each node of the tree of paths, by address."""
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url", F.nullif(F.regexp_extract("url", PATH, 1), F.lit("")).alias("path"))
    return discover.browse_leaves(pages, "page_id", "path", "url").orderBy("place")

"""Registered queries: scores, ordering, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions.analyzers import Analyzer, token_rows
from lexshelf.operators import lookup, postings, rank
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query
from lexshelf.session import cut

SQL_ROUNDED = f"{C.SQL_SCORES}, r AS (SELECT query_id, doc_id, round(score, 6) AS score, n_terms FROM hits)"


def benchmark_parts(spark, sf_dir, model: str = "tfidf"):
    index, asked = C.text_index(spark, sf_dir), C.clauses(spark, sf_dir)
    avg_len = index.mean_length() if model == "bm25" else None
    weights = rank.term_weights(index.postings, asked, index.count(), model, avg_len, index.stats)
    return rank.explain_scores(index.postings, weights, key="doc_id", parts=index.parts())


def benchmark_hits(spark, sf_dir, model: str = "tfidf"):
    hits = rank.score(benchmark_parts(spark, sf_dir, model), "doc_id")
    return hits.withColumn("score", F.round("score", 6))


def benchmark_best(spark, sf_dir, k: int):
    """The ``k`` best documents of every query: (query_id, doc_id, score, n_terms, rank)."""
    return lookup.best_documents(C.text_index(spark, sf_dir), C.clauses(spark, sf_dir), k)


@query(
    "top_documents",
    f"""WITH {SQL_ROUNDED} SELECT query_id, doc_id, score, n_terms, rank FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 10""",
)
def top_documents(spark, sf_dir):
    """Ten best documents for every query."""
    return benchmark_best(spark, sf_dir, 10)


@query("scores_tfidf", f"WITH {SQL_ROUNDED} SELECT query_id, doc_id, score, n_terms FROM r")
def scores_tfidf(spark, sf_dir):
    return benchmark_hits(spark, sf_dir)


@query(
    "top_documents_bm25",
    f"""WITH {C.SQL_MATCH}, n AS (SELECT count(*) AS n, (SELECT avg(len) FROM (SELECT DISTINCT doc_id, len FROM post)) AS a FROM documents),
    parts AS (SELECT query_id, doc_id, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a)) AS value
      FROM matches JOIN stats USING (term), n),
    r AS (SELECT query_id, doc_id, round(sum(value), 6) AS score, count(*) AS n_terms FROM parts GROUP BY ALL)
    SELECT query_id, doc_id, score, n_terms, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 10""",
)
def top_documents_bm25(spark, sf_dir):
    return rank.top_k(benchmark_hits(spark, sf_dir, "bm25"), 10, "doc_id")


@query(
    "score_parts",
    f"""WITH {C.SQL_SCORES}, top AS (SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM hits) WHERE rank <= 3)
    SELECT query_id, doc_id, term, round(value, 6) AS value FROM parts JOIN top USING (query_id, doc_id)""",
)
def score_parts(spark, sf_dir):
    """What each term adds to the score of the three best hits."""
    parts = benchmark_parts(spark, sf_dir)
    top = cut(benchmark_best(spark, sf_dir, 3).select("query_id", "doc_id"))
    return parts.join(top, ["query_id", "doc_id"]).select("query_id", "doc_id", "term", F.round("value", 6).alias("value"))


FIELDS = {"p_name": 1.2, "p_brand": 1.5, "p_type": 0.5}


def part_fields(spark, sf_dir):
    """Tokens of three fields of part: (field, p_partkey, len, pos, term)."""
    parts = C.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS])).alias("_f"),
    )
    rows = parts.select("p_partkey", "_f.field", "_f.text")
    chain = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))
    return token_rows(rows, "text", chain, "len")


@query(
    "dismax",
    r"""WITH f AS (SELECT p_partkey, 'p_name' AS field, 1.2 AS w, p_name AS text FROM part UNION ALL SELECT p_partkey, 'p_brand', 1.5, p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', 0.5, p_type FROM part),
    tok AS (SELECT p_partkey, field, w, len(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS len, lower(unnest(regexp_extract_all(text, '[\p{L}\p{N}]+'))) AS term FROM f),
    post AS (SELECT p_partkey, field, w, len, term, count(*) AS tf FROM tok GROUP BY ALL),
    stats AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL),
    q AS (SELECT DISTINCT lower(p_type || ' ' || split_part(p_name, ' ', 1)) AS query_id FROM part),
    clauses AS (SELECT DISTINCT query_id, unnest(string_split(query_id, ' ')) AS term FROM q),
    n AS (SELECT count(*) AS n FROM part),
    parts AS (SELECT query_id, p_partkey, term, max(w * sqrt(tf) * pow(1 + ln(n / (df + 1)), 2) / sqrt(len)) AS value
      FROM post JOIN stats USING (field, term) JOIN clauses USING (term), n GROUP BY query_id, p_partkey, term),
    need AS (SELECT query_id, count(*) AS need FROM clauses GROUP BY 1)
    SELECT query_id, p_partkey, round(sum(value), 6) AS score, count(*) AS n_terms FROM parts JOIN need USING (query_id) GROUP BY query_id, p_partkey, need HAVING count(*) >= need""",
)
def dismax(spark, sf_dir):
    """Every query against three weighted fields; all its words must occur somewhere."""
    parts = C.table(spark, sf_dir, "part")
    asked = (
        parts.select(F.lower(F.concat_ws(" ", "p_type", F.substring_index("p_name", " ", 1))).alias("query_id"))
        .distinct()
        .select("query_id", F.explode(F.array_distinct(F.split("query_id", " "))).alias("term"))
    )
    by_field = asked.select("*", F.explode(F.array(*[F.lit(f) for f in FIELDS])).alias("field"))
    post = postings.postings(part_fields(spark, sf_dir), "p_partkey")
    weights = rank.term_weights(post, by_field, parts.select(F.count(F.lit(1))).scalar())
    scored = rank.explain_scores(post, weights)
    hits = rank.dismax(scored, "p_partkey", FIELDS, asked)
    return hits.select("query_id", "p_partkey", F.round("score", 6).alias("score"), "n_terms")


@query(
    "boost_function",
    f"""WITH {SQL_ROUNDED} SELECT query_id, doc_id, round(score + ln(1 + n_chars) / 10, 6) AS score FROM r JOIN documents USING (doc_id)""",
)
def boost_function(spark, sf_dir):
    hits = benchmark_hits(spark, sf_dir)
    index = C.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    boosted = rank.boost(hits, index, "doc_id", F.log(1 + F.col("n_chars")) / 10)
    return boosted.select("query_id", "doc_id", F.round("score", 6).alias("score"))


def conversation_sorts(spark, sf_dir):
    return C.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("size"),
        F.split("p_name", " ").alias("byNA"),
    )


@query(
    "sort_hits",
    """SELECT p_partkey, CAST(row_number() OVER (ORDER BY p_size % 5 = 0, CASE WHEN p_size % 5 <> 0 THEN p_size END DESC, p_partkey) AS BIGINT) AS place
    FROM part""",
)
def sort_hits(spark, sf_dir):
    """Descending, missing values last; the place says the order."""
    rows = conversation_sorts(spark, sf_dir)
    return rank.numbered(rows, [rank.sort_key(rows, "size", True)], "p_partkey").select("p_partkey", "place")


@query(
    "index_order",
    """SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS place FROM conversations QUALIFY role = 'user'""",
)
def index_order(spark, sf_dir):
    """Hits in the order in which their sections were read."""
    rows = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    placed = rank.numbered(rows, [F.asc("conv_id")], "turn")
    return placed.filter("role = 'user'").select("conv_id", "turn", "place").orderBy("place")


@query(
    "sort_multi_valued",
    """SELECT p_partkey, least(split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS least_value,
    row_number() OVER (ORDER BY least(split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)), p_partkey) AS place FROM part""",
)
def sort_multi_valued(spark, sf_dir):
    rows = conversation_sorts(spark, sf_dir)
    placed = rank.numbered(rows, [rank.sort_key(rows, "byNA", False)], "p_partkey")
    return placed.select("p_partkey", F.array_min("byNA").alias("least_value"), "place")


@query(
    "result_page",
    f"""WITH {SQL_ROUNDED} SELECT query_id, doc_id, score, rank, total FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
    count(*) OVER (PARTITION BY query_id) AS total FROM r) WHERE rank > 11 AND rank <= 22""",
)
def result_page(spark, sf_dir):
    """Second page of eleven hits, with totals."""
    rows = rank.page(cut(benchmark_hits(spark, sf_dir)), 2, 11, "doc_id")
    return rows.select("query_id", "doc_id", "score", "rank", "total")


@query(
    "deep_page",
    f"""WITH {SQL_ROUNDED} SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 2000""",
)
def deep_page(spark, sf_dir):
    """More rows per query than a map task's limit covers: ranked in slices first."""
    rows = rank.top_k(benchmark_hits(spark, sf_dir), 2000, "doc_id")
    return rows.select("query_id", "doc_id", "score", "rank")


@query(
    "random_order",
    "SELECT doc_id, md5(doc_id || '|42') AS random, row_number() OVER (ORDER BY md5(doc_id || '|42'), doc_id) AS place FROM documents",
)
def random_order(spark, sf_dir):
    rows = rank.random_order(C.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)
    return rank.numbered(rows, [F.asc("random")], "doc_id")


@query(
    "elevate",
    f"""WITH {SQL_ROUNDED}, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 10),
    rules AS (SELECT item_id AS query_id, CAST(item_id + 1 AS BIGINT) AS doc_id, CAST(1 AS INTEGER) AS pin_rank, FALSE AS excluded FROM benchmark
      UNION ALL SELECT query_id, doc_id, NULL, TRUE FROM top WHERE rank = 2 AND doc_id <> query_id + 1),
    kept AS (SELECT query_id, doc_id, score FROM r WHERE NOT EXISTS (SELECT 1 FROM rules x WHERE x.excluded AND x.query_id = r.query_id AND x.doc_id = r.doc_id))
    SELECT query_id, doc_id, score, pin_rank, place FROM (SELECT query_id, doc_id, score, pin_rank,
      row_number() OVER (PARTITION BY query_id ORDER BY pin_rank NULLS LAST, score DESC NULLS LAST, doc_id) AS place
      FROM kept FULL JOIN (SELECT query_id, doc_id, pin_rank FROM rules WHERE NOT excluded) p USING (query_id, doc_id)) WHERE place <= 10""",
)
def elevate(spark, sf_dir):
    """Per query: one document pinned first, the second best one excluded."""
    hits = cut(benchmark_hits(spark, sf_dir).select("query_id", "doc_id", "score"))
    pins = C.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), (F.col("item_id") + 1).alias("doc_id"), F.lit(1).alias("pin_rank"), F.lit(False).alias("excluded")
    )
    second = rank.top_k(hits, 2, "doc_id").filter((F.col("rank") == 2) & (F.col("doc_id") != F.col("query_id") + 1))
    rules = pins.unionByName(
        second.select("query_id", "doc_id", F.lit(None).cast("int").alias("pin_rank"), F.lit(True).alias("excluded"))
    )
    order = [F.asc_nulls_last("pin_rank"), F.desc_nulls_last("score")]
    return rank.top_k(rank.elevate(hits, rules, "doc_id"), 10, "doc_id", order=order).withColumnRenamed("rank", "place")

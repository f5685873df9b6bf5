"""The registered queries of this package, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.llm import (
    bpe,
    decontaminate,
    language,
    licenses,
    lmscore,
    minhash,
    packing,
    pages,
    periodic,
    quality,
    search,
    simhash,
    substrings,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query | None = None, *, sql: str = "") -> Query:
    if fn is None:
        return lambda inner: query(inner, sql=sql)
    QUERIES[fn.__name__] = fn
    if sql:
        ORACLES[fn.__name__] = sql
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lmscore.scored(table(spark, sf_dir, "documents"), language.held_out(F.col("doc_id"), 7))
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * F.log2(F.lit(10.0)) / F.col("n_bytes"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", bits.alias("bits_per_byte"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged_ids(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return found.select("doc_id", *base, "kept", "quality")


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, start, end, edits) of every benchmark passage in a document."""
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return found.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query(
    sql=r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS docs, sum(len(words))::BIGINT AS words FROM d WHERE len(words) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, docs),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf)::BIGINT // (1000 * tf + 8 * (100 - 75 + (75 * n * docs)::BIGINT // words))::BIGINT))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS held
  FROM w),
s AS MATERIALIZED (SELECT doc_id, len(held) AS n, unnest(held) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
SELECT doc_id, len(held)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)"""
)
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): from some word on, the words of one document in ten repeat a stretch of it; the rest stays."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"))
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    docs = docs.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p AS int)]))")
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query(
    sql=r"""
WITH codes AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS code
  FROM range(256) AS r(i)),
hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda h, b: xor(h >> 8, code[(xor(h, b) & 255) + 1])), 4294967295) AS h
  FROM documents, codes),
placed AS (SELECT *, len(words) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM hashed),
spaced AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
w AS MATERIALIZED (
  SELECT doc_id, n, unnest(CASE WHEN a IS NULL THEN words
      ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END) AS word,
    unnest(range(n)) AS i
  FROM spaced),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS MATERIALIZED (SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS told,
    arg_min({'s': s, 'l': l, 'q': q}, [-l, s, q]) AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, (1000 * best.l) // best.q AS exponent_milli,
  sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""
)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(planted(table(spark, sf_dir, "documents")))
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS s, r.period AS p)))")
    found = found.withColumn("b", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("b.s").alias("start"),
        (-F.col("b.l")).alias("length"),
        F.col("b.p").alias("period"),
        F.expr("(-1000 * b.l) div b.p").alias("exponent_milli"),
        F.sha2(F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

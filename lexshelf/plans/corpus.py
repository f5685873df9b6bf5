"""The driver's tables in the shapes the operators take, and the registry of queries.

``documents`` is the corpus, ``benchmark`` a table of queries (every item is one query, whole text),
``conversations`` a collection of document trees (conversation = document, turn = section).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer, analyzer, query_rows
from lexshelf.functions.text import HTML_BLOCKS, HTML_TAGS, WORD
from lexshelf.operators.postings import postings_of, tokenize
from lexshelf.operators.textindex import TextIndex, build_text_index, open_text_index
from lexshelf.operators.vocabulary import Vocabulary, build_vocabulary
from lexshelf.session import deal, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, its twin."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


GENERAL = analyzer("text_general")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return deal(table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",))), "doc_id")


#: Folders of the indexes that this application has written, by session, chain and state of the input files.
_INDEXES: dict[tuple, str] = {}


def text_index(spark: SparkSession, sf_dir: str, chain: Analyzer = GENERAL) -> TextIndex:
    """The stored index of ``documents.text``: written by the first search of an application, read by all others.

    Files that changed since (by name, size or time) are indexed anew.
    """
    file = F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = table(spark, sf_dir, "documents").select(file.alias("file")).distinct()
    state = tuple(files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("file") % 1_000_000_007)).first())
    name = (spark.sparkContext.applicationId, shared_dir(spark), chain.name, sf_dir, *state)
    if name not in _INDEXES:
        path = f"{shared_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
        build_text_index(documents(spark, sf_dir), "doc_id", "text", chain, path)
        _INDEXES[name] = path
    return open_text_index(spark, "doc_id", _INDEXES[name])


def vocabulary(spark: SparkSession, sf_dir: str, chain: Analyzer = GENERAL) -> Vocabulary:
    """What the terms of the stored index are looked up by; each table is written beside the index by the first search that wants it."""
    index = text_index(spark, sf_dir, chain)
    name = ("vocabulary", spark.sparkContext.applicationId, index.path)
    if name not in _INDEXES:
        _INDEXES[name] = f"{index.path}/vocabulary-{uuid.uuid4().hex}"
    return build_vocabulary(index.stats, _INDEXES[name])


def doc_tokens(spark: SparkSession, sf_dir: str, chain: Analyzer = GENERAL) -> DataFrame:
    return tokenize(documents(spark, sf_dir), "doc_id", "text", chain)


def doc_postings(spark: SparkSession, sf_dir: str, chain: Analyzer = GENERAL) -> DataFrame:
    return postings_of(documents(spark, sf_dir), "doc_id", "text", chain)


def clauses(spark: SparkSession, sf_dir: str, chain: Analyzer = GENERAL) -> DataFrame:
    """The distinct terms of every benchmark item: (query_id, term)."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return query_rows(items, "text", chain)


def count_docs(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as document trees. System turns are marked as not to be indexed."""
    rows = table(spark, sf_dir, "conversations")
    doc = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    words = F.split(F.trim(F.col("text")), r"\s+")
    meta = F.map_from_entries(
        F.array(
            F.struct(F.lit("Identifier"), F.array(doc)),
            F.struct(F.lit("dc.Title"), F.when(F.col("turn") % 2 == 0, F.array(F.get(words, 0))).otherwise(F.array().cast("array<string>"))),
            F.struct(F.lit("dc.Subject"), F.array(F.element_at(words, -1), F.col("role"))),
            F.struct(F.lit("dls.Organization"), F.when(F.col("turn") == 0, F.array(F.concat(F.lit("org"), (F.col("conv_id") % 7).cast("string")))).otherwise(F.array().cast("array<string>"))),
            F.struct(F.lit("gsdldoctype"), F.array(F.when(F.col("role") == "system", "ignored_section").otherwise("indexed_section"))),
            F.struct(F.lit("gsdlsourcefilename"), F.array(F.lit("import"))),
        )
    )
    return rows.select(
        doc.alias("doc_oid"),
        F.when(F.col("turn") == 0, "").otherwise(F.col("turn").cast("string")).alias("sec_path"),
        (F.col("turn") + 1).cast("int").alias("sec_no"),
        F.when(F.col("conv_id") % 10 == 9, "classify_doc").otherwise("indexed_doc").alias("doc_type"),
        "text",
        meta.alias("meta"),
    )


# --- the same in SQL -------------------------------------------------------------------------

SQL_WORD = WORD.replace("'", "''")


def sql_tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '{SQL_WORD}')"


def sql_html_strip(c: str) -> str:
    out = f"regexp_replace(regexp_replace({c}, '{HTML_BLOCKS}', ' ', 'g'), '{HTML_TAGS}', ' ', 'g')"
    # the references that occur in the tables; others are in literal texts beside them, with what they have to give
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{plain}')"
    return out


def sql_escape(c: str) -> str:
    return f"""replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


def sql_token_rows(source: str, key: str, array: str) -> str:
    """tok(key, len, pos, term) from an array-valued SQL expression."""
    return (
        f"arr AS (SELECT {key}, {array} AS t FROM {source}), "
        f"tok AS (SELECT {key}, len, pos, term FROM (SELECT {key}, CAST(len(list_filter(t, lambda x: x <> '')) AS BIGINT) AS len, "
        f"generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS term FROM arr) WHERE term <> '')"
    )


GENERAL_ARRAY = f"list_transform({sql_tokens(sql_html_strip('text'))}, lambda x: lower(x))"
SQL_TOK = sql_token_rows("documents", "doc_id", GENERAL_ARRAY)
SQL_POST = f"{SQL_TOK}, post AS (SELECT doc_id, len, term, count(*) AS tf FROM tok GROUP BY ALL)"
SQL_STATS = f"{SQL_POST}, stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM post GROUP BY term)"
SQL_CLAUSES = f"clauses AS (SELECT DISTINCT item_id AS query_id, unnest({GENERAL_ARRAY}) AS term FROM benchmark)"
SQL_MATCH = f"{SQL_STATS}, {SQL_CLAUSES}, matches AS (SELECT * FROM post JOIN clauses USING (term))"
SQL_SCORES = (
    f"{SQL_MATCH}, n AS (SELECT count(*) AS n FROM documents), parts AS (SELECT query_id, doc_id, term, "
    "sqrt(tf) * pow(1 + ln(n / (df + 1)), 2) / sqrt(len) AS value FROM matches JOIN stats USING (term), n), "
    "hits AS (SELECT query_id, doc_id, sum(value) AS score, count(*) AS n_terms FROM parts GROUP BY ALL)"
)
SQL_SECTIONS = """sections AS (SELECT 'c' || conv_id AS doc_oid, CASE WHEN turn = 0 THEN '' ELSE CAST(turn AS VARCHAR) END AS sec_path,
 CAST(turn + 1 AS INTEGER) AS sec_no, CASE WHEN conv_id % 10 = 9 THEN 'classify_doc' ELSE 'indexed_doc' END AS doc_type, text, role,
 CASE WHEN turn = 0 THEN 'c' || conv_id ELSE 'c' || conv_id || '.' || turn END AS docOID,
 CASE WHEN turn % 2 = 0 THEN [w[1]] ELSE [] END AS title, [w[len(w)], role] AS subject,
 CASE WHEN turn = 0 THEN ['org' || (conv_id % 7)] ELSE [] END AS org, role <> 'system' AS indexed
 FROM (SELECT *, regexp_split_to_array(trim(text), '\\s+') AS w FROM conversations))"""

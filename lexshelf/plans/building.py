"""Registered queries: index build, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions import words as W
from lexshelf.operators import build, facets, index
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query, sql_escape
from lexshelf.session import cut, literal_table, shared_dir
from lexshelf.sources import records, store
from lexshelf.streaming import ingest

SPEC = "allfields;text;dc.Title,Title;dc.Subject;topdls.Organization"
SORTS = ["rank", "dls.Organization", "none"]
FACETS = ["dls.Organization", "dc.Subject"]
SQL_ELIGIBLE = f"{C.SQL_SECTIONS}, ok AS (SELECT * FROM sections WHERE doc_type = 'indexed_doc' AND indexed)"


def sql_trim(c: str) -> str:
    return f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"


SQL_TX, SQL_TI = sql_trim(sql_escape("text")), sql_trim(f"coalesce({sql_escape('title[1]')}, '')")
SQL_SU, SQL_OR = sql_trim(f"{sql_escape('subject[1]')} || ' ' || {sql_escape('subject[2]')}"), sql_trim("coalesce(org[1], '')")
SQL_ZZ = (
    f"concat_ws(' ', nullif({sql_escape('text')}, ''), nullif({sql_escape('title[1]')}, ''), "
    f"{sql_escape('subject[1]')} || ' ' || {sql_escape('subject[2]')}, CASE WHEN sec_no = 1 THEN org[1] END)"
)


@query(
    "document_index",
    f"""WITH {SQL_ELIGIBLE}, f AS (SELECT doc_oid AS docOID, sec_no, {SQL_TX} AS TX, {SQL_TI} AS TI, {SQL_SU} AS SU, {SQL_OR} AS "OR", {SQL_ZZ} AS ZZ FROM ok),
    u AS (SELECT docOID, sec_no, 'TX' AS field, TX AS value FROM f UNION ALL SELECT docOID, sec_no, 'TI', TI FROM f UNION ALL SELECT docOID, sec_no, 'SU', SU FROM f
      UNION ALL SELECT docOID, sec_no, 'OR', "OR" FROM f UNION ALL SELECT docOID, sec_no, 'ZZ', ZZ FROM f)
    SELECT docOID, field, sec_no, value FROM u WHERE value <> ''""",
)
def document_index(spark, sf_dir):
    return build.build_doc_index(C.sections(spark, sf_dir), SPEC)


@query(
    "section_index",
    f"""WITH {C.SQL_SECTIONS}, s AS (SELECT * FROM sections WHERE doc_type = 'indexed_doc')
    SELECT docOID, doc_oid, sec_no, CASE WHEN indexed THEN {SQL_TX} END AS TX, CASE WHEN indexed THEN {SQL_TI} END AS TI,
     CASE WHEN indexed THEN {SQL_SU} END AS SU, CASE WHEN indexed AND sec_no = 1 THEN {SQL_OR} END AS "OR", CASE WHEN indexed THEN {SQL_ZZ} END AS ZZ,
     CASE WHEN indexed THEN array_to_string(org, '|') END AS byOR,
     CASE WHEN indexed THEN {sql_escape("array_to_string(subject, '|')")} END AS bySU FROM s""",
)
def section_index(spark, sf_dir):
    rows = build.build_sec_index(C.sections(spark, sf_dir), SPEC, SORTS, FACETS)
    return rows.withColumns({c: F.array_join(c, "|") for c in ("byOR", "bySU")})


@query(
    "eligible_sections",
    f"WITH {C.SQL_SECTIONS} SELECT docOID, sec_no, indexed FROM sections WHERE doc_type = 'indexed_doc'",
)
def eligible_sections(spark, sf_dir):
    rows = build.eligible(C.sections(spark, sf_dir), keep_placeholders=True)
    return rows.select(build.section_key().alias("docOID"), "sec_no", "indexed")


@query("subcollection", "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src2') OR (lang = 'de' AND n_chars > 1000)")
def subcollection(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return build.subcollection(docs, ["source IN ('src1', 'src2')", "lang = 'de' AND n_chars > 1000"]).select("doc_id", "source")


@query(
    "language_filter",
    "SELECT 'en,fr' AS filter, doc_id FROM documents WHERE lang IN ('en', 'fr') UNION ALL SELECT '!de', doc_id FROM documents WHERE lang <> 'de' OR lang IS NULL",
)
def language_filter(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    pick = [build.language_filter(docs, f, "lang").select(F.lit(f).alias("filter"), "doc_id") for f in ("en,fr", "!de")]
    return pick[0].union(pick[1])


@query(
    "fielded_projection",
    f"""WITH {C.SQL_SECTIONS} SELECT docOID, {SQL_TX} AS TX, {SQL_TI} AS TI, {SQL_SU} AS SU, CASE WHEN sec_no = 1 THEN {SQL_OR} END AS "OR" FROM sections""",
)
def fielded_projection(spark, sf_dir):
    rows = build.project_fields(C.sections(spark, sf_dir), "text;dc.Title,Title;dc.Subject;topdls.Organization")
    return rows.select(build.section_key().alias("docOID"), "TX", "TI", "SU", "OR")


@query(
    "all_fields",
    f"WITH {C.SQL_SECTIONS} SELECT docOID, {SQL_ZZ} AS ZZ FROM sections",
)
def all_fields(spark, sf_dir):
    rows = build.project_fields(C.sections(spark, sf_dir), SPEC, trim=False)
    return rows.select(build.section_key().alias("docOID"), "ZZ")


@query(
    "metadata_inheritance",
    f"""WITH {C.SQL_SECTIONS}, t AS (SELECT doc_oid, subject AS top_subject, title AS top_title, org AS top_org FROM sections WHERE sec_no = 1)
    SELECT docOID, array_to_string(CASE WHEN sec_no > 1 THEN list_concat(org, coalesce(top_org, [])) ELSE org END, '|') AS always,
     array_to_string(CASE WHEN sec_no > 1 AND len(title) = 0 THEN coalesce(top_title, []) ELSE title END, '|') AS unless_present
    FROM sections LEFT JOIN t USING (doc_oid)""",
)
def metadata_inheritance(spark, sf_dir):
    rows = build.inherit_metadata(C.sections(spark, sf_dir))
    return rows.select(
        build.section_key().alias("docOID"),
        F.array_join(build.merged_values("dls.Organization", "always"), "|").alias("always"),
        F.array_join(build.merged_values("dc.Title", "unless_section_metadata_exists"), "|").alias("unless_present"),
    )


@query(
    "all_metadata",
    f"""WITH {C.SQL_SECTIONS}, m AS (SELECT doc_oid, sec_no, 'dc.Title' AS field, 0 AS item_no, title[1] AS value FROM sections
      UNION ALL SELECT doc_oid, sec_no, 'dls.Organization', 0, org[1] FROM sections)
    SELECT doc_oid, sec_no, field, item_no, {sql_escape('value')} AS value FROM m WHERE value <> ''""",
)
def all_metadata(spark, sf_dir):
    return build.all_metadata(C.sections(spark, sf_dir), ["dc.Subject"])


@query(
    "field_map",
    """SELECT * FROM (VALUES ('allfields', 'ZZ'), ('text', 'TX'), ('dc.Subject', 'SU'), ('dc.Sums', 'SU2'), ('dc.Title', 'TI'), ('dls.Organization', 'OR')) AS v(field, short_name)""",
)
def field_map(spark, sf_dir):
    """Numbered as the columns of the index are: fields of the spec first, then the other metadata of the collection."""
    return build.field_map(spark, "allfields;dc.Subject;dc.Sums;text", C.sections(spark, sf_dir))


@query(
    "sort_fields_document",
    f"""WITH {C.SQL_SECTIONS} SELECT doc_oid, array_to_string(org, '|') AS byOR, {sql_escape("array_to_string(subject, '|')")} AS bySU FROM sections WHERE sec_no = 1""",
)
def sort_fields_document(spark, sf_dir):
    rows = build.sort_facet_fields(C.sections(spark, sf_dir), SORTS, FACETS, level="document")
    return rows.select("doc_oid", *[F.array_join(c, "|").alias(c) for c in ("byOR", "bySU")])


@query(
    "sort_fields_section",
    f"""WITH {C.SQL_SECTIONS}, t AS (SELECT doc_oid, org AS top_org FROM sections WHERE sec_no = 1)
    SELECT docOID, array_to_string(CASE WHEN sec_no > 1 AND len(org) = 0 THEN coalesce(top_org, []) ELSE org END, '|') AS byOR FROM sections LEFT JOIN t USING (doc_oid)""",
)
def sort_fields_section(spark, sf_dir):
    rows = build.sort_facet_fields(C.sections(spark, sf_dir), SORTS, [], "unless_section_metadata_exists")
    return rows.select(build.section_key().alias("docOID"), F.array_join("byOR", "|").alias("byOR"))


@query(
    "present_sort_fields",
    f"WITH {C.SQL_SECTIONS} SELECT 'byOR' AS field, count(*) FILTER (len(org) > 0) AS records FROM sections UNION ALL SELECT 'bySU', count(*) FILTER (len(subject) > 0) FROM sections",
)
def present_sort_fields(spark, sf_dir):
    return build.present_fields(build.sort_facet_fields(C.sections(spark, sf_dir), SORTS, FACETS))


@query("html_escape", f"SELECT page_id, {sql_escape('html')} AS escaped FROM pages")
def html_escape(spark, sf_dir):
    return C.table(spark, sf_dir, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"))


@query(
    "ingest_statistics",
    f"""WITH {SQL_ELIGIBLE}, raw AS (SELECT count(*) FILTER (sec_no = 1) AS docs, count(*) AS sections FROM sections WHERE doc_type = 'indexed_doc')
    SELECT docs, sections, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
    CAST(sum(coalesce(strlen({SQL_TX}), 0) + coalesce(strlen({SQL_SU}), 0)) AS BIGINT) AS processed_bytes FROM ok, raw GROUP BY docs, sections""",
)
def ingest_statistics(spark, sf_dir):
    sections = C.sections(spark, sf_dir)
    return build.ingest_stats(build.eligible(sections, keep_placeholders=True), build.build_doc_index(sections, "text;dc.Subject"))


SQL_CHANGES = """target AS (SELECT 'c' || conv_id AS doc_oid, CASE WHEN turn = 0 THEN 'c' || conv_id ELSE 'c' || conv_id || '.' || turn END AS docOID, text AS TX FROM conversations),
 changes AS (SELECT doc_oid, docOID, TX || ' (' || seq || ')' AS TX, op, seq FROM (
   SELECT t.*, 'add' AS op, k AS seq FROM target t, (SELECT unnest([1, 2, 3]) AS k) WHERE CAST(substr(doc_oid, 2) AS BIGINT) % 4 = 1
   UNION ALL SELECT t.*, 'delete', 2 FROM target t WHERE docOID = doc_oid AND CAST(substr(doc_oid, 2) AS BIGINT) % 8 = 1
   UNION ALL SELECT t.*, 'delete', 1 FROM target t WHERE docOID = doc_oid AND CAST(substr(doc_oid, 2) AS BIGINT) % 4 = 2
   UNION ALL SELECT t.*, 'reindex', 5 FROM target t WHERE docOID = doc_oid AND CAST(substr(doc_oid, 2) AS BIGINT) % 4 = 3))"""


def change_feed(spark, sf_dir):
    """Some documents added three times, some deleted (before or after), some reindexed with their top section only."""
    rows = C.sections(spark, sf_dir).select("doc_oid", build.section_key().alias("docOID"), F.col("text").alias("TX"))
    number = F.substr("doc_oid", F.lit(2)).cast("bigint")
    top = F.col("docOID") == F.col("doc_oid")
    adds = rows.filter(number % 4 == 1).select("*", F.lit("add").alias("op"), F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])).alias("seq"))
    others = [
        rows.filter(top & (number % n == r)).select("*", F.lit(op).alias("op"), F.lit(seq).alias("seq"))
        for n, r, op, seq in ((8, 1, "delete", 2), (4, 2, "delete", 1), (4, 3, "reindex", 5))
    ]
    changes = adds.unionByName(others[0]).unionByName(others[1]).unionByName(others[2])
    changes = changes.withColumn("TX", F.concat("TX", F.lit(" ("), F.col("seq").cast("string"), F.lit(")")))
    return rows, changes


@query(
    "apply_changes",
    f"""WITH {SQL_CHANGES}, gone AS (SELECT doc_oid, max(seq) AS g FROM changes WHERE op IN ('delete', 'reindex') GROUP BY 1),
    adds AS (SELECT * FROM changes WHERE op IN ('add', 'reindex') QUALIFY row_number() OVER (PARTITION BY docOID ORDER BY seq DESC) = 1)
    SELECT doc_oid, docOID, TX FROM target WHERE doc_oid NOT IN (SELECT doc_oid FROM gone) AND docOID NOT IN (SELECT docOID FROM adds)
    UNION ALL SELECT a.doc_oid, docOID, TX FROM adds a LEFT JOIN gone USING (doc_oid) WHERE g IS NULL OR seq >= g""",
)
def apply_changes(spark, sf_dir):
    target, changes = change_feed(spark, sf_dir)
    return build.apply_changes(target, changes)


@query(
    "typed_fields",
    """SELECT p_partkey AS key_l, p_size AS size_i, CAST(p_retailprice AS FLOAT) AS price_f, TRY_CAST(p_name AS INTEGER) AS name_i,
    (p_size > 25) AS big_b, TIMESTAMP '2001-02-03 04:05:06' AS seen_dt, p_brand AS attr_brand FROM part""",
)
def typed_fields(spark, sf_dir):
    raw = C.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("key_l"),
        F.col("p_size").cast("string").alias("size_i"),
        F.col("p_retailprice").cast("string").alias("price_f"),
        F.col("p_name").alias("name_i"),
        (F.col("p_size") > 25).cast("string").alias("big_b"),
        F.lit("2001-02-03T04:05:06Z").alias("seen_dt"),
        F.col("p_brand").alias("attr_brand"),
        F.col("p_type").alias("ignored_type"),
    )
    return build.cast_dynamic(raw).withColumn("attr_brand", F.array_join("attr_brand", "|"))


@query("copy_field", "SELECT p_partkey, left(p_name, 8) || '|' || left(p_brand, 8) || '|' || left(p_type, 8) AS catch_all FROM part")
def copy_field(spark, sf_dir):
    rows = C.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    for source in ("p_name", "p_brand", "p_ty*"):
        rows = build.copy_field(rows, source, "catch_all", 8)
    return rows.select("p_partkey", F.array_join("catch_all", "|").alias("catch_all"))


@query(
    "required_and_default",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderstatus END AS status, o_orderpriority NOT LIKE '5%' AS accepted FROM orders""",
)
def required_and_default(spark, sf_dir):
    orders = C.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority")).alias("priority"),
    )
    good, bad = build.enforce(orders, ["priority"], {"status": "unknown"})
    return good.withColumn("accepted", F.lit(True)).union(bad.withColumn("accepted", F.lit(False))).drop("priority")


PAGE = f"regexp_replace(html, '{T.HTML_BLOCKS}', ' ', 'g')"


@query(
    "page_extraction",
    f"""SELECT page_id, url, trim(regexp_replace({C.sql_html_strip(f"regexp_extract({PAGE}, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) AS title,
    trim(regexp_replace({C.sql_html_strip(f"regexp_replace({PAGE}, '(?is)<head[^>]*>.*?</head>', ' ', 'g')")}, '\\s+', ' ', 'g')) AS text,
    array_to_string(regexp_extract_all({PAGE}, '(?i)<a\\s[^>]*href=["'']([^"'']*)["'']', 1), ' ') AS links FROM pages""",
)
def page_extraction(spark, sf_dir):
    pages = records.extract_pages(C.table(spark, sf_dir, "pages"))
    return pages.withColumn("links", F.array_join("links", " "))


@query("extracted_names", "SELECT page_id AS id, url AS links, length(html) AS ignored_size FROM pages")
def extracted_names(spark, sf_dir):
    rows = C.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ID"), F.col("url").alias("a"), F.length("html").cast("bigint").alias("Size")
    )
    return records.rename_extracted(rows, ["id", "links"], {"a": "links"})


SQL_SIGNED = "s AS (SELECT doc_id, md5('=' || lang || chr(1) || '=' || text) AS signature FROM documents)"


@query("signatures", f"WITH {SQL_SIGNED} SELECT * FROM s")
def signatures(spark, sf_dir):
    return build.signature(C.documents(spark, sf_dir, "lang", "text"), ["lang", "text"]).select("doc_id", "signature")


@query("deduplicate", f"WITH {SQL_SIGNED} SELECT max(doc_id) AS doc_id, signature FROM s GROUP BY signature")
def deduplicate(spark, sf_dir):
    return build.dedupe(cut(signatures(spark, sf_dir)), "doc_id")


@query(
    "mark_duplicates",
    f"WITH {SQL_SIGNED} SELECT doc_id, signature, doc_id <> min(doc_id) OVER (PARTITION BY signature) AS duplicate FROM s",
)
def mark_duplicates(spark, sf_dir):
    return build.dedupe(cut(signatures(spark, sf_dir)), "doc_id", overwrite=False)


def sql_language_counts() -> str:
    counts = ", ".join(
        f"len(list_filter(t, lambda x: x IN ({', '.join(chr(39) + w + chr(39) for w in ws)}))) AS {lang}" for lang, ws in W.FUNCTION_WORDS.items()
    )
    return f"n AS (SELECT doc_id, {counts} FROM (SELECT doc_id, {C.sql_tokens('lower(text)')} AS t FROM documents)), b AS (SELECT *, greatest(en, de, fr, es) AS best FROM n)"


@query(
    "language_identification",
    f"""WITH {sql_language_counts()} SELECT doc_id, CASE WHEN best = 0 THEN 'en' WHEN de = best THEN 'de' WHEN en = best THEN 'en' WHEN es = best THEN 'es' ELSE 'fr' END AS language_s FROM b""",
)
def language_identification(spark, sf_dir):
    return build.detect_language(C.documents(spark, sf_dir), "doc_id", ["text"], W.FUNCTION_WORDS).select("doc_id", "language_s")


@query("attribute_names", f"WITH {C.SQL_SECTIONS} SELECT docOID, 'dc.Subject|dc.Title' AS attribute_ss, upper(role) AS role FROM sections")
def attribute_names(spark, sf_dir):
    """A user's step over all records, and the names of fields that match a pattern."""
    hooked = build.apply_hook(
        C.sections(spark, sf_dir), lambda df: df.withColumn("role", F.upper(F.element_at(build.meta_values("dc.Subject"), -1)))
    )
    rows = build.attribute_names(hooked, r"^dc\.")
    return rows.select(build.section_key().alias("docOID"), F.array_join("attribute_ss", "|").alias("attribute_ss"), "role")


@query(
    "crosswalk",
    "SELECT s_suppkey, s_name AS title, CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS VARCHAR) ELSE s_name END AS coverage FROM supplier",
)
def crosswalk(spark, sf_dir):
    rows = C.table(spark, sf_dir, "supplier").withColumn("place", F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")))
    return build.crosswalk(rows, {"title": ["s_name"], "coverage": ["place", "s_name"]}, ["s_suppkey"])


@query(
    "document_cap",
    f"WITH {C.SQL_SECTIONS} SELECT docOID, doc_oid FROM sections WHERE doc_oid IN (SELECT DISTINCT doc_oid FROM sections ORDER BY 1 LIMIT 25)",
)
def document_cap(spark, sf_dir):
    return build.limit_docs(C.sections(spark, sf_dir), 25).select(build.section_key().alias("docOID"), "doc_oid")


@query("feed", f"SELECT '<item><title>' || {sql_escape('s_name')} || '</title><link>' || {sql_escape("'http://example.org/?s=' || s_suppkey || '&n=' || s_nationkey")} || '</link></item>' AS item FROM supplier")
def feed(spark, sf_dir):
    link = F.concat(F.lit("http://example.org/?s="), F.col("s_suppkey").cast("string"), F.lit("&n="), F.col("s_nationkey").cast("string"))
    return build.feed(C.table(spark, sf_dir, "supplier"), F.col("s_name"), link)


@query(
    "document_store",
    f"""WITH {C.SQL_SECTIONS} SELECT doc_oid, docOID, sec_no, '<Sec gs2:id="' || sec_no || '">' || {sql_escape('text')} || '</Sec>' AS xml FROM sections""",
)
def document_store(spark, sf_dir):
    """Written to the store and read back."""
    path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    store.write_doc_store(C.sections(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(
    "publish_versions",
    "SELECT doc_id, lang FROM documents WHERE lang <> 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'en'",
)
def publish_versions(spark, sf_dir):
    """A version rebuilt, a second one published over it, then added to."""
    root = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    store.publish(docs, root)
    store.publish(docs.filter("lang != 'en'"), root)
    store.publish(docs.filter("lang = 'en'"), root, "append")
    return store.current(spark, root)


@query(
    "read_records",
    "SELECT 'csv' AS fmt, p_partkey, p_name FROM part UNION ALL SELECT 'json', p_partkey, p_name FROM part UNION ALL SELECT 'xml', p_partkey, p_name FROM part",
)
def read_records(spark, sf_dir):
    """The same records written and read in three formats."""
    root = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    parts.write.option("header", "true").csv(f"{root}/csv")
    parts.write.json(f"{root}/json")
    parts.write.option("rowTag", "doc").format("xml").save(f"{root}/xml")
    read = [
        records.read_records(spark, f"{root}/{fmt}", fmt, "p_partkey bigint, p_name string").select(F.lit(fmt).alias("fmt"), "p_partkey", "p_name")
        for fmt in ("csv", "json", "xml")
    ]
    return read[0].union(read[1]).union(read[2])


@query(
    "stream_changes",
    f"""WITH {SQL_CHANGES}, gone AS (SELECT doc_oid, max(seq) AS g FROM changes WHERE op IN ('delete', 'reindex') GROUP BY 1),
    adds AS (SELECT * FROM changes WHERE op IN ('add', 'reindex') QUALIFY row_number() OVER (PARTITION BY docOID ORDER BY seq DESC) = 1)
    SELECT doc_oid, docOID, TX FROM target WHERE doc_oid NOT IN (SELECT doc_oid FROM gone) AND docOID NOT IN (SELECT docOID FROM adds)
    UNION ALL SELECT a.doc_oid, docOID, TX FROM adds a LEFT JOIN gone USING (doc_oid) WHERE g IS NULL OR seq >= g""",
)
def stream_changes(spark, sf_dir):
    """The change feed loaded as a stream of files; the outcome is that of the batch."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    target, changes = change_feed(spark, sf_dir)
    changes.repartition(4, "seq").write.parquet(f"{root}/feed")
    feed_schema = "doc_oid string, docOID string, TX string, op string, seq int"
    ingest.stream_index(ingest.file_changes(spark, f"{root}/feed", feed_schema, 2), root).awaitTermination()
    return ingest.current_index(spark, root, target, "docOID", "doc_oid", by_batch=False)


# fielded clauses, as in ``TX:the SU:user``; every clause of a query has to hold
FIELDED = [("q1", "TX", "the"), ("q1", "SU", "user"), ("q2", "TX", "that"), ("q3", "SU", "assistant"), ("q3", "TX", "of"), ("q4", "TX", "nowhere")]
SQL_FIELDED = "cl AS (SELECT * FROM (VALUES " + ", ".join(str(c) for c in FIELDED) + ") AS v(query_id, field, term))"


def sql_search(key: str) -> str:
    """Hits of the fielded clauses over the values of ``ok``, grouped by ``key``."""
    return (
        f"{SQL_ELIGIBLE}, val AS (SELECT {key} AS docOID, 'TX' AS field, {SQL_TX} AS text FROM ok UNION ALL SELECT {key}, 'SU', {SQL_SU} FROM ok), "
        f"tk AS (SELECT docOID, field, unnest({C.GENERAL_ARRAY}) AS term FROM val), "
        "po AS (SELECT docOID, field, term, count(*) AS tf FROM tk WHERE term <> '' GROUP BY ALL), "
        "ln AS (SELECT docOID, field, sum(tf) AS len FROM po GROUP BY ALL), st AS (SELECT field, term, count(*) AS df FROM po GROUP BY ALL), "
        f"nd AS (SELECT count(DISTINCT docOID) AS n FROM val WHERE text <> ''), {SQL_FIELDED}, need AS (SELECT query_id, count(*) AS need FROM cl GROUP BY 1), "
        "hit AS (SELECT query_id, docOID, round(sum(sqrt(tf) * pow(1 + ln(n / (df + 1)), 2) / sqrt(len)), 6) AS score FROM cl JOIN st USING (field, term) "
        "JOIN po USING (field, term) JOIN ln USING (docOID, field) JOIN need USING (query_id), nd GROUP BY query_id, docOID, need HAVING count(*) = need)"
    )


def fielded_hits(spark, values, key: str):
    """The stored index of the values, and what the fielded clauses find in it."""
    stored = index.build_index(values, key, C.GENERAL, f"{shared_dir(spark)}/index-{uuid.uuid4().hex}")
    clauses = literal_table(spark, FIELDED, "query_id string, field string, term string")
    hits = index.matching(index.search(stored, clauses), clauses)
    return hits.select("query_id", key, F.round("score", 6).alias("score"))


@query("search_documents", f"WITH {sql_search('doc_oid')} SELECT query_id, docOID, score FROM hit")
def search_documents(spark, sf_dir):
    """Fielded clauses against the stored index of whole conversations."""
    return fielded_hits(spark, build.build_doc_index(C.sections(spark, sf_dir), "text;dc.Subject"), "docOID")


@query(
    "search_sections",
    f"""WITH {sql_search('docOID')}, x AS (SELECT query_id, h.docOID, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, h.docOID) AS rank,
     count(*) OVER (PARTITION BY query_id, role) AS same_role, role FROM hit h JOIN sections s ON s.docOID = h.docOID)
    SELECT query_id, docOID, score, rank, role, same_role FROM x WHERE rank <= 11""",
)
def search_sections(spark, sf_dir):
    """First page of eleven turns per query, with the facet counts of their roles."""
    from lexshelf.operators import rank

    sections = C.sections(spark, sf_dir)
    rows = build.build_sec_index(sections, "text;dc.Subject")
    bag = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("TX", "SU")])
    hits = cut(fielded_hits(spark, rows.select("docOID", F.inline(bag)).filter("value IS NOT NULL"), "docOID"))
    roles = sections.select(build.section_key().alias("docOID"), F.element_at(build.meta_values("dc.Subject"), -1).alias("role"))
    counts = facets.facet_fields(roles, ["role"], hits, "docOID").select("query_id", F.col("value").alias("role"), F.col("count").alias("same_role"))
    page = rank.top_k(hits, 11, "docOID")
    return page.join(roles, "docOID").join(counts, ["query_id", "role"]).select("query_id", "docOID", "score", "rank", "role", "same_role")

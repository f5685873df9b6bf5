"""Registered queries: text analysis and postings."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions import words as W
from lexshelf.functions.analyzers import LANGUAGE_STEPS, PRESETS, Analyzer, analyzer, token_rows
from lexshelf.operators import match, postings
from lexshelf.plans import corpus as C
from lexshelf.plans.corpus import query
from lexshelf.session import cut, literal_table


def term_table(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"))


SQL_TERM_TABLE = "SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM tok GROUP BY term"


def sql_terms(array: str, source: str = "documents", key: str = "doc_id") -> str:
    return f"WITH {C.sql_token_rows(source, key, array)} {SQL_TERM_TABLE}"


def chain_terms(spark: SparkSession, sf_dir: str, chain: Analyzer) -> DataFrame:
    return term_table(C.doc_tokens(spark, sf_dir, chain))


def sql_map(array: str, expression: str) -> str:
    """Apply an SQL expression of ``x`` to the terms; empty ones become holes."""
    return f"list_transform({array}, lambda x: nullif({expression}, ''))"


SQL_STD = C.sql_tokens("text")
SQL_LOW = f"list_transform({SQL_STD}, lambda x: lower(x))"
SQL_STRIPPED = C.sql_tokens(C.sql_html_strip("text"))
SQL_STEM_EN = (
    "CASE WHEN length(x) < 3 OR x NOT LIKE '%s' OR x LIKE '%us' OR x LIKE '%ss' THEN x "
    "WHEN regexp_matches(x, '[^ae]ies$') THEN left(x, length(x) - 3) || 'y' "
    "WHEN regexp_matches(x, '(i|a|o|e)es$') THEN x ELSE left(x, length(x) - 1) END"
)


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# literal texts beside the pages, and what they have to give
MARKED_UP = [
    ("caf&#233; na&iuml;ve", "café naïve"),
    ("&#x4E2D;&#X6587; &#128512;!", "中文 😀!"),
    ("a&nbsp;b&#160;c", "a b c"),
    ("&amp;lt; &unknown; &#0; &#xD800; AT&T R&D;", "&lt; &unknown; &#0; &#xD800; AT&T R&D;"),
    ("<b>&Omega;</b>&hellip;&rsquo;&apos;", " Ω …’\'"),
]


@query(
    "html_strip",
    f"SELECT page_id, {C.sql_html_strip('html')} AS text FROM pages UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"({-1 - i}, {sql_list([plain])})" for i, (_, plain) in enumerate(MARKED_UP)) + ")",
)
def html_strip(spark, sf_dir):
    more = literal_table(spark, [(-1 - i, marked) for i, (marked, _) in enumerate(MARKED_UP)], "page_id bigint, html string")
    pages = C.table(spark, sf_dir, "pages").select("page_id", "html").union(more)
    return pages.select("page_id", T.html_strip(F.col("html")).alias("text"))


@query("whitespace_terms", sql_terms(r"regexp_extract_all(text, '\S+')"))
def whitespace_terms(spark, sf_dir):
    return chain_terms(spark, sf_dir, analyzer("text_ws"))


@query("standard_terms", sql_terms(SQL_STD))
def standard_terms(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("standard", T.tok_standard))


@query("keyword_values", "SELECT lower(p_name) AS term, count(*) AS n FROM part GROUP BY 1")
def keyword_values(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return token_rows(parts, "p_name", analyzer("lowercase")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


PATH = r"^https?://[^/]+(/[^?#]*)"


@query(
    "path_match",
    rf"""WITH p AS (SELECT page_id, regexp_extract(url, '{PATH}', 1) AS path FROM pages),
    parts AS (SELECT page_id, path, string_split(path, '/') AS s FROM p),
    heads AS (SELECT page_id, path, array_to_string(s[1:i], '/') AS head FROM
      (SELECT page_id, path, s, unnest(range(1, len(s) + 1)) AS i FROM parts)),
    asked AS (SELECT DISTINCT path AS query_path FROM p WHERE path <> '')
    SELECT 'descendant' AS kind, query_path, count(DISTINCT page_id) AS n FROM asked JOIN heads ON head = query_path GROUP BY ALL
    UNION ALL SELECT 'ancestor', query_path, count(DISTINCT p.page_id) FROM
      (SELECT DISTINCT path AS query_path, head FROM heads WHERE head <> '') a JOIN p ON p.path = a.head GROUP BY ALL""",
)
def path_match(spark, sf_dir):
    pages = C.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", PATH, 1).alias("path"))
    pages = pages.filter("path != ''")
    heads = pages.select("page_id", F.explode(T.path_prefixes(F.col("path"))).alias("head"))
    asked = pages.select(F.col("path").alias("query_path")).distinct()
    down = heads.join(asked, F.col("head") == F.col("query_path")).groupBy("query_path").agg(
        F.count_distinct("page_id").alias("n")
    )
    above = asked.select("query_path", F.explode(T.path_prefixes(F.col("query_path"))).alias("path"))
    up = pages.join(above, "path").groupBy("query_path").agg(F.count_distinct("page_id").alias("n"))
    return down.select(F.lit("descendant").alias("kind"), "query_path", "n").union(
        up.select(F.lit("ancestor"), "query_path", "n")
    )


LOW, UP = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL_SHOUT = C.sql_tokens(f"translate(text, '{LOW}', '{UP}')")


@query(
    "lower_case_variants",
    f"""WITH w AS (SELECT unnest({SQL_SHOUT}) AS x FROM documents)
    SELECT 'tr' AS lang, lower(translate(x, 'Iİ', 'ıi')) AS term, count(*) AS n FROM w GROUP BY ALL
    UNION ALL SELECT 'el', translate(lower(x), 'ςάέήίόύώϊϋΐΰ', 'σαεηιουωιυιυ'), count(*) FROM w GROUP BY ALL
    UNION ALL SELECT 'ga', lower(regexp_replace(x, '^([nt])([AEIOUÁÉÍÓÚ])', '\\1-\\2')), count(*) FROM w GROUP BY ALL""",
)
def lower_case_variants(spark, sf_dir):
    words = C.documents(spark, sf_dir).select(F.explode(T.tok_standard(F.translate("text", LOW, UP))).alias("x"))
    forms = [F.struct(F.lit(g).alias("lang"), T.lower_case(g)(F.col("x")).alias("term")) for g in ("tr", "el", "ga")]
    return words.select(F.explode(F.array(*forms)).alias("_f")).groupBy("_f.lang", "_f.term").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("stop_words", sql_terms(f"list_transform({SQL_LOW}, lambda x: CASE WHEN x NOT IN ({sql_list(W.STOP_EN)}) THEN x END)"))
def stop_words(spark, sf_dir):
    chain = Analyzer("stopped", T.tok_standard, (), (("term", F.lower), ("term", T.stop(W.STOP_EN))))
    return chain_terms(spark, sf_dir, chain)


@query(
    "stop_word_table",
    f"""WITH {C.sql_token_rows('documents', 'doc_id', SQL_LOW)},
    dropped AS (SELECT DISTINCT unnest({C.sql_tokens('lower(text)')}) AS term FROM benchmark)
    SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM tok WHERE term NOT IN (SELECT term FROM dropped) GROUP BY term""",
)
def stop_word_table(spark, sf_dir):
    """A stop list that is itself a table: here every benchmark word."""
    listed = C.table(spark, sf_dir, "benchmark").select(F.explode(T.tok_standard(F.lower("text"))).alias("word"))
    chain = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))
    index = C.text_index(spark, sf_dir, chain)
    return term_table(postings.drop_stop_words(index.tokens, listed, frequency=index.stats.select("term", F.col("ttf").alias("n"))))


REWRITES = [("red", [["crimson"]]), ("widget", [["thing", "made"], ["gadget"]])]
GROUPS = [["bolt", "screw", "fastener"], ["ring", "loop"]]
SQL_SYNONYM = (
    "CASE x WHEN 'red' THEN [['crimson']] WHEN 'widget' THEN [['thing', 'gadget'], ['made']] "
    "WHEN 'bolt' THEN [{bolt}] WHEN 'ring' THEN [{ring}] ELSE [[x]] END"
)
SQL_SLOT_TERMS = (
    "slots AS (SELECT p_partkey, flatten(list_transform(string_split(lower(p_name), ' '), lambda x: {slot})) AS s FROM part), "
    "places AS (SELECT p_partkey, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS t FROM slots), "
    "tok AS (SELECT p_partkey, pos, unnest(t) AS term FROM places)"
)


def part_synonyms(spark, sf_dir, expand: bool) -> DataFrame:
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    chain = Analyzer("synonyms", T.tok_standard, (), (("slots", T.synonyms(REWRITES, GROUPS, expand)), ("term", F.lower)))
    return term_table(token_rows(parts, "p_name", chain))


@query(
    "synonyms_expanded",
    "WITH " + SQL_SLOT_TERMS.format(slot=SQL_SYNONYM.format(bolt="['bolt', 'screw', 'fastener']", ring="['ring', 'loop']"))
    + " " + SQL_TERM_TABLE,
)
def synonyms_expanded(spark, sf_dir):
    return part_synonyms(spark, sf_dir, True)


@query(
    "synonyms_reduced",
    "WITH " + SQL_SLOT_TERMS.format(slot=SQL_SYNONYM.format(bolt="['bolt']", ring="['ring']")) + " " + SQL_TERM_TABLE,
)
def synonyms_reduced(spark, sf_dir):
    return part_synonyms(spark, sf_dir, False)


@query(
    "synonym_table",
    """WITH tok AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word,
      generate_subscripts(string_split(lower(p_name), ' '), 1) - 1 AS pos FROM part),
    rules AS (SELECT lower(r_name) AS target, ['red', 'blue', 'old', 'new', 'hot'][r_regionkey + 1] AS source FROM region),
    out AS (SELECT pos, coalesce(target, word) AS term FROM tok LEFT JOIN rules ON word = source)
    SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM out GROUP BY term""",
)
def synonym_table(spark, sf_dir):
    """Rules that are a table: joined, not held in the expression."""
    sources = F.array(*[F.lit(w) for w in ("red", "blue", "old", "new", "hot")])
    rules = C.table(spark, sf_dir, "region").select(
        F.get(sources, F.col("r_regionkey")).alias("source"), F.lower("r_name").alias("target")
    )
    parts = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    chain = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))
    return term_table(postings.join_synonyms(cut(token_rows(parts, "p_name", chain)), rules))


SQL_PARTS = (
    r"regexp_extract_all(regexp_replace(x, '[''’][sS]$', ''), "
    r"'\p{Lu}*[\p{Ll}\p{Lm}\p{Lo}\p{Lt}\p{M}]+|\p{Lu}+|\p{N}+')"
)
# every part at its place, and each run of several parts joined at the place of its first
SQL_DELIMITED = (
    r"w AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS x FROM (SELECT doc_id, {array} AS t FROM documents)), "
    r"p AS (SELECT doc_id, i, CASE WHEN x IS NULL THEN [] ELSE " + SQL_PARTS + r" END AS parts FROM w), "
    r"b AS (SELECT *, CAST(coalesce(sum(greatest(len(parts), 1)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM p), "
    r"r AS (SELECT doc_id, i, base, generate_subscripts(runs, 1) AS j, unnest(runs) AS run FROM (SELECT doc_id, i, base, "
    r"regexp_extract_all(array_to_string(parts, chr(1)), '[\p{L}\p{M}\x01]+|[\p{N}\x01]+') AS runs FROM b)), "
    r"c AS (SELECT doc_id, i, base, j, list_filter(string_split(run, chr(1)), lambda q: q <> '') AS q FROM r), "
    r"o AS (SELECT *, CAST(coalesce(sum(len(q)) OVER (PARTITION BY doc_id, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM c), "
)
SQL_DELIMITED_ALL = SQL_DELIMITED + (
    "raw AS (SELECT doc_id, base + off + generate_subscripts(q, 1) - 1 AS pos, unnest(q) AS x FROM o "
    "UNION ALL SELECT doc_id, base + off, array_to_string(q, '') FROM o WHERE len(q) > 1), "
)



def sql_delimited(array: str, head: str = SQL_DELIMITED_ALL) -> str:
    return "WITH " + head.replace("{array}", array)


@query(
    "word_delimiter",
    sql_delimited(r"regexp_extract_all(text, '\S+')") + "tok AS (SELECT pos, x AS term FROM raw) " + SQL_TERM_TABLE,
)
def word_delimiter(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("delimited", T.tok_whitespace, (), (("slots", T.word_delimiter()),)))


@query("possessives", sql_terms(sql_map(SQL_LOW, "regexp_replace(x, '[''’][sS]$', '')")))
def possessives(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("possessive", T.tok_standard, (), (("term", F.lower), ("term", T.possessive))))


KEPT = ["this", "thens", "areas", "ones"]


@query("protected_words", sql_terms(sql_map(SQL_LOW, f"CASE WHEN x IN ({sql_list(KEPT)}) THEN x ELSE {SQL_STEM_EN} END")))
def protected_words(spark, sf_dir):
    step = T.protect(KEPT, T.stem_en_minimal)
    return chain_terms(spark, sf_dir, Analyzer("protected", T.tok_standard, (), (("term", F.lower), ("term", step))))


@query("stem_english", sql_terms(sql_map(SQL_LOW, SQL_STEM_EN)))
def stem_english(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("stem", T.tok_standard, (), (("term", F.lower), ("term", T.stem_en_minimal))))


@query(
    "stem_override_table",
    f"""WITH {C.sql_token_rows('documents', 'doc_id', SQL_LOW)}, words AS (SELECT DISTINCT unnest({C.sql_tokens('lower(text)')}) AS word FROM benchmark),
    out AS (SELECT pos, CASE WHEN word IS NULL THEN term ELSE left(word, 4) END AS term FROM tok LEFT JOIN words ON term = word)
    SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM out GROUP BY term""",
)
def stem_override_table(spark, sf_dir):
    """A stem dictionary that is itself a table."""
    words = C.table(spark, sf_dir, "benchmark").select(F.explode(T.tok_standard(F.lower("text"))).alias("word")).distinct()
    chain = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))
    index = C.text_index(spark, sf_dir, chain)
    stems = words.withColumn("stem", F.left("word", F.lit(4)))
    return term_table(postings.override_stems(index.tokens, stems, index.stats.select("term", F.col("ttf").alias("n"))))


def sql_suffix_steps(lang: str, x: str) -> str:
    """The suffix tables said in SQL."""
    fold = T.LIGHT_FOLDS.get(lang)
    if fold and lang != "pt":
        x = f"translate({x}, '{fold[0]}', '{fold[1]}')"
    for rules in T.LIGHT_SUFFIXES[lang]:
        whens = " ".join(
            f"WHEN length(v) > {longer} AND regexp_matches(v, '(?:{ending})$') "
            f"THEN regexp_replace(v, '(?:{ending})$', '{new.replace('$', chr(92))}')"
            for longer, ending, new in rules
        )
        x = f"list_transform([{x}], lambda v: CASE {whens} ELSE v END)[1]"
    if fold and lang == "pt":
        x = f"translate({x}, '{fold[0]}', '{fold[1]}')"
    return x


LANGS = ["de", "fr", "es", "it", "pt"]


@query(
    "stem_light",
    f"WITH w AS (SELECT term, count(*) AS n FROM (SELECT unnest({SQL_LOW}) AS term FROM documents) GROUP BY term) "
    + " UNION ALL ".join(
        f"SELECT '{lang}' AS lang, {sql_suffix_steps(lang, 'term')} AS stem, CAST(sum(n) AS BIGINT) AS n FROM w GROUP BY ALL" for lang in LANGS
    ),
)
def stem_light(spark, sf_dir):
    """Each distinct word is stemmed once."""
    words = C.documents(spark, sf_dir).select(F.explode(T.tok_standard(F.col("text"))).alias("term"))
    words = words.groupBy(F.lower("term").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    forms = [F.struct(F.lit(g).alias("lang"), T.stem_light(g)(F.col("term")).alias("stem")) for g in LANGS]
    return words.select("n", F.explode(F.array(*forms)).alias("_f")).groupBy("_f.lang", "_f.stem").agg(F.sum("n").alias("n"))


def sql_elision(x: str) -> str:
    either = "|".join(sorted(set(W.ELISIONS["fr"]), key=lambda a: (-len(a), a)))
    return f"regexp_replace({x}, '^(?i:{either})[''’]', '')"


@query("elision", sql_terms(sql_map(SQL_STD, f"lower({sql_elision('x')})")))
def elision(spark, sf_dir):
    steps = (("term", T.elision(W.ELISIONS["fr"])), ("term", F.lower))
    return chain_terms(spark, sf_dir, Analyzer("elision", T.tok_standard, (), steps))


def sql_folds(c: str) -> str:
    folds = W.latin_folds()
    single = {k: v for k, v in folds.items() if len(v) == 1}
    out = f"translate({c}, '{''.join(single)}', '{''.join(single.values())}')"
    for k, v in folds.items():
        if len(v) != 1:
            out = f"replace({out}, '{k}', '{v}')"
    return out


@query("char_map", sql_terms(rf"regexp_extract_all({sql_folds('text')}, '\S+')"))
def char_map(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("folded", T.tok_whitespace, (T.char_map,)))


SQL_NORM_DE = "replace(regexp_replace(translate(x, 'äöü', 'aou'), '(^|[^aeq])ue', '\\1u', 'g'), 'ß', 'ss')"


@query("normalize_german", sql_terms(sql_map(SQL_LOW, SQL_NORM_DE)))
def normalize_german(spark, sf_dir):
    return chain_terms(spark, sf_dir, Analyzer("german", T.tok_standard, (), (("term", F.lower), ("term", T.normalize("de")))))


SQL_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
SQL_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")


# the tables hold no ideographs or kana: a few literal texts go beside them, with the terms they have to give
CJK_TEXTS = [
    ("東京都の天気 abc", "東京 京都 都の の天 天気 abc"),
    ("ＡＢ１ 한국어 テスト", "ab1 한국 국어 テス スト"),
    ("日 本 ひらがな", "日 本 ひら らが がな"),
    ("東京タワー タワー", "東京 京タ タワ ワー タワ ワー"),
    ("東京abc東2020年", "東京 abc 東 2020 年"),
]


@query(
    "cjk_bigrams",
    f"""WITH w AS (SELECT unnest(list_transform({SQL_STRIPPED}, lambda x: lower(translate(x, '{SQL_WIDE}', '{SQL_PLAIN}')))) AS term FROM documents),
    g AS (SELECT term FROM w UNION ALL SELECT unnest([{sql_list(' '.join(terms for _, terms in CJK_TEXTS).split())}]))
    SELECT term, count(*) AS n FROM g GROUP BY term""",
)
def cjk_bigrams(spark, sf_dir):
    more = literal_table(spark, [(-1 - i, t) for i, (t, _) in enumerate(CJK_TEXTS)], "doc_id bigint, text string")
    docs = C.documents(spark, sf_dir).union(more)
    return postings.tokenize(docs, "doc_id", "text", analyzer("text_cjk")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "reversed_terms",
    f"""WITH w AS (SELECT DISTINCT unnest({SQL_LOW}) AS term FROM documents)
    SELECT term FROM w WHERE suffix(term, 'tion')""",
)
def reversed_terms(spark, sf_dir):
    """``*tion`` as a prefix filter on the marked reversed form held beside each term."""
    terms = C.doc_tokens(spark, sf_dir, analyzer("text_general_rev")).select("term").distinct()
    found = terms.filter(F.col("term").startswith(T.REVERSED + "noit"))
    return found.select(F.reverse(F.substr("term", F.lit(2))).alias("term"))


@query("alpha_sort_key", "SELECT c_custkey, regexp_replace(trim(lower(c_name || ' ' || c_mktsegment)), '[^a-z]', '', 'g') AS sort_key FROM customer")
def alpha_sort_key(spark, sf_dir):
    return C.table(spark, sf_dir, "customer").select(
        "c_custkey", T.alpha_sort_key(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("sort_key")
    )


# Soundex: the code of each letter, 7 for those that part nothing; equal codes in a row count once; vowels part but are not written
SOUNDEX_CODES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230127022455012623017202")


def sql_soundex(x: str) -> str:
    code = f"translate(regexp_replace(upper({x}), '[^A-Z]', '0', 'g'), '{SOUNDEX_CODES[0]}', '{SOUNDEX_CODES[1]}')"
    out = f"left({code}, 1) || replace(substr({code}, 2), '7', '')"
    for digit in "0123456":
        out = f"regexp_replace({out}, '{digit}+', '{digit}', 'g')"
    out = f"rpad(left(replace(substr({out}, 2), '0', ''), 3), 3, '0')"
    return f"CASE WHEN regexp_matches({x}, '^[A-Za-z]') THEN upper(left({x}, 1)) || {out} ELSE {x} END"


@query(
    "phonetic_match",
    f"""WITH d AS MATERIALIZED (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest({C.GENERAL_ARRAY}) AS x FROM documents)),
    q AS (SELECT DISTINCT item_id AS query_id, x FROM (SELECT item_id, unnest({C.GENERAL_ARRAY}) AS x FROM benchmark)),
    k AS MATERIALIZED (SELECT x, {sql_soundex('x')} AS k FROM (SELECT x FROM d UNION SELECT x FROM q)),
    dk AS (SELECT DISTINCT doc_id, k FROM d JOIN k USING (x)), qk AS (SELECT DISTINCT query_id, k FROM q JOIN k USING (x))
    SELECT query_id, doc_id, count(*) AS n_keys FROM dk JOIN qk USING (k) GROUP BY ALL""",
)
def phonetic_match(spark, sf_dir):
    """Documents by the sound of the queries' words: both sides carry the phonetic key as their term."""
    chain = C.GENERAL.then("term", F.soundex)
    asked = C.clauses(spark, sf_dir, chain)
    found = match.match_terms(cut(postings.restrict(cut(C.doc_postings(spark, sf_dir, chain)), asked)), asked)
    return found.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("n_keys"))


@query(
    "payload_sums",
    """WITH w AS (SELECT unnest([[l_returnflag, CAST(l_quantity AS VARCHAR)], [l_linestatus, CAST(l_discount AS VARCHAR)], ['line', '1']]) AS p FROM lineitem)
    SELECT p[1] AS term, count(*) AS n, round(sum(CAST(p[2] AS DOUBLE)), 2) AS total, round(avg(CAST(p[2] AS DOUBLE)), 4) AS mean FROM w GROUP BY ALL""",
)
def payload_sums(spark, sf_dir):
    line = F.concat(
        "l_returnflag", F.lit("|"), F.col("l_quantity").cast("string"), F.lit(" "),
        "l_linestatus", F.lit("|"), F.col("l_discount").cast("string"), F.lit(" line"),
    )
    rows = C.table(spark, sf_dir, "lineitem").select(F.explode(T.payloads(line)).alias("_p"))
    return rows.groupBy("_p.term").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("_p.payload"), 2).alias("total"),
        F.round(F.avg("_p.payload"), 4).alias("mean"),
    )


SQL_STOP_WS = f"list_transform(regexp_extract_all({C.sql_html_strip('text')}, '\\S+'), lambda x: CASE WHEN lower(x) NOT IN ({sql_list(W.STOP_EN)}) THEN x END)"


def sql_stem(x: str) -> str:
    """English chain's last steps on an SQL expression."""
    return f"list_transform([lower({x})], lambda x: CASE WHEN x IN ({sql_list(W.PROTECTED)}) THEN x ELSE {SQL_STEM_EN} END)[1]"


@query(
    "preset_text_en_splitting",
    sql_delimited(SQL_STOP_WS)
    + f"tok AS (SELECT pos, {sql_stem('x')} AS term FROM raw) " + SQL_TERM_TABLE,
)
def preset_text_en_splitting(spark, sf_dir):
    return chain_terms(spark, sf_dir, analyzer("text_en_splitting"))



@query(
    "preset_text_en_splitting_tight",
    sql_delimited(SQL_STOP_WS, SQL_DELIMITED)
    + f"""runs AS (SELECT doc_id, i, j, lower(array_to_string(q, '')) AS x FROM o)
    SELECT {sql_stem('x')} AS term, count(*) AS n FROM runs WHERE x <> '' GROUP BY ALL""",
)
def preset_text_en_splitting_tight(spark, sf_dir):
    tokens = C.doc_tokens(spark, sf_dir, analyzer("text_en_splitting_tight"))
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("preset_text_general", sql_terms(C.GENERAL_ARRAY))
def preset_text_general(spark, sf_dir):
    return chain_terms(spark, sf_dir, C.GENERAL)


@query(
    "preset_text_general_rev",
    f"WITH {C.sql_token_rows('documents', 'doc_id', SQL_LOW)}, two AS (SELECT term, pos FROM tok UNION ALL SELECT chr(1) || reverse(term), pos FROM tok) "
    "SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM two GROUP BY term",
)
def preset_text_general_rev(spark, sf_dir):
    return chain_terms(spark, sf_dir, analyzer("text_general_rev"))


@query(
    "preset_text_en",
    sql_terms(
        f"list_transform({SQL_STRIPPED}, lambda y: CASE WHEN lower(y) NOT IN ({sql_list(W.STOP_EN)}) THEN "
        + sql_stem("regexp_replace(lower(y), '[''’][sS]$', '')") + " END)"
    ),
)
def preset_text_en(spark, sf_dir):
    return chain_terms(spark, sf_dir, analyzer("text_en"))


def sql_language(lang: str) -> str:
    stops = {"fr": W.STOP_FR}.get(lang, W.FUNCTION_WORDS[lang])
    low = f"lower({sql_elision('y')})" if lang == "fr" else "lower(y)"
    norm = SQL_NORM_DE.replace("translate(x,", f"translate({low},") if lang == "de" else low
    return sql_terms(
        f"list_transform({SQL_STRIPPED}, lambda y: CASE WHEN {low} NOT IN ({sql_list(stops)}) THEN nullif({sql_suffix_steps(lang, norm)}, '') END)"
    )


def language_terms(lang: str):
    def run(spark, sf_dir):
        stops = None if lang == "fr" else W.FUNCTION_WORDS[lang]
        return chain_terms(spark, sf_dir, analyzer(f"text_{lang}", stop_words=stops))

    return run


for _lang in ("de", "fr", "es"):
    query(f"preset_text_{_lang}", sql_language(_lang))(language_terms(_lang))


@query(
    "duplicates_at_a_position",
    sql_terms(sql_map(SQL_LOW, SQL_STEM_EN)),
)
def duplicates_at_a_position(spark, sf_dir):
    """A synonym that the stemmer makes equal to its word is one term at that position, not two."""
    steps = (
        ("term", F.lower), ("slots", T.synonyms([], [["the", "thes"], ["that", "thats"]])),
        ("term", T.stem_en_minimal), ("slots", T.dedupe_tokens),
    )
    return chain_terms(spark, sf_dir, Analyzer("dedupe", T.tok_standard, (), steps))


@query("preset_token_counts")
def preset_token_counts(spark, sf_dir):
    """Tokens every preset makes of the corpus, in one pass.

    Every step of a chain works on each token by itself, so a chain makes of a text what it makes of its tokens, one by one. Texts are cut
    into tokens once for all chains that cut alike, tokens are counted, and the steps are applied to each different one, times its number.
    Chains that keep the text whole are applied to it.
    """
    docs = C.documents(spark, sf_dir)
    chains = {}
    for name in PRESETS:
        lang = name.removeprefix("text_")
        own = lang in LANGUAGE_STEPS and lang != "fr"
        chains[name] = analyzer(name, stop_words=W.FUNCTION_WORDS.get(lang, W.FUNCTION_WORDS["en"]) if own else None)

    def size(chain: Analyzer, column: str):
        tokens = chain(F.col(column))
        return F.size(F.filter(F.flatten(tokens) if chain.stacked else tokens, lambda t: t != "")).cast("bigint")

    whole = [p for p in PRESETS if chains[p].tokenize is T.tok_keyword]
    ways = list(dict.fromkeys((c.before, c.tokenize) for p, c in chains.items() if p not in whole))
    cuts = [F.struct(F.lit(i).alias("way"), Analyzer("cut", tokenize, before)(F.col("text")).alias("tokens")) for i, (before, tokenize) in enumerate(ways)]
    parts = docs.select(F.explode(F.array(*cuts)).alias("_c")).select("_c.way", F.explode("_c.tokens").alias("token"))
    counted = cut(parts.groupBy("way", "token").agg(F.count(F.lit(1)).alias("n")))
    sums = []
    for name, chain in chains.items():
        if name not in whole:
            steps = replace(chain, tokenize=T.tok_keyword, before=())
            mine = F.col("way") == ways.index((chain.before, chain.tokenize))
            sums.append(F.sum(F.when(mine, F.col("n") * size(steps, "token"))).alias(name))
    by_token = counted.agg(*sums)
    # without any text there is no sum, and with empty texts alone it is 0
    by_text = docs.agg(F.when(F.count("text") > 0, F.lit(0)).alias("_some"), *[F.sum(size(chains[p], "text")).alias(p) for p in whole])
    one = by_text.crossJoin(by_token)  # one row each
    total = {p: F.col(p) if p in whole else F.coalesce(p, "_some").cast("bigint") for p in PRESETS}
    return one.select(F.inline(F.array(*[F.struct(F.lit(p).alias("preset"), total[p].alias("tokens")) for p in PRESETS])))


@query(
    "position_gap",
    f"""WITH v AS (SELECT conv_id, turn, {SQL_LOW} AS t FROM conversations),
    b AS (SELECT *, CAST(coalesce(sum(len(t)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + 100 * turn AS base FROM v),
    k AS (SELECT conv_id, base + generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS term FROM b)
    SELECT conv_id, CAST(pos AS BIGINT) AS pos, term FROM k""",
)
def position_gap(spark, sf_dir):
    chain = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))
    return postings.tokenize_values(C.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", chain)


@query("postings", f"WITH {C.SQL_POST} SELECT doc_id, len, term, tf FROM post")
def build_postings(spark, sf_dir):
    return C.doc_postings(spark, sf_dir)


@query(
    "posting_blocks",
    f"WITH {C.SQL_TOK} SELECT doc_id, term, pos // 4096 AS block, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions FROM tok GROUP BY ALL",
)
def posting_blocks(spark, sf_dir):
    blocks = postings.posting_blocks(C.doc_tokens(spark, sf_dir), "doc_id")
    return blocks.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), " "))


@query("term_statistics", f"WITH {C.SQL_STATS} SELECT * FROM stats")
def term_statistics(spark, sf_dir):
    return postings.term_stats(C.doc_postings(spark, sf_dir))


@query("doc_lengths", f"WITH {C.SQL_TOK} SELECT doc_id, count(*) AS len FROM tok GROUP BY doc_id")
def doc_lengths(spark, sf_dir):
    return postings.doc_lengths(C.doc_tokens(spark, sf_dir), "doc_id")

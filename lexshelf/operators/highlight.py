"""Highlighted documents and snippets, worked out within each hit's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.functions.text import RUNS, TermStep, html_escape, tok_standard

# Tags around matched words in whole documents and in snippets.
DOC_TAGS = ('<span class="termHighlight">', "</span>")
SNIPPET_TAGS = ('&lt;span class="snippetText"&gt;', "&lt;/span&gt;")


def tagged(text: Column, terms: Column, pre: str, post: str, normal: TermStep = F.lower, encode: bool = False) -> Column:
    """``text`` with every word whose normal form is in ``terms`` between ``pre`` and ``post``."""
    shown = html_escape if encode else (lambda c: c)
    runs = F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))
    marked = F.transform(
        runs,
        lambda r: F.when(F.array_contains(terms, normal(r)), F.concat(F.lit(pre), shown(r), F.lit(post))).otherwise(shown(r)),
    )
    return F.array_join(marked, "")


def highlight_doc(rows: DataFrame, text: str, terms: str, tags: tuple[str, str] = DOC_TAGS, normal: TermStep = F.lower,
                  name: str = "highlighted") -> DataFrame:
    """Whole text of each row with its ``terms`` (an array) tagged; unchanged when none occurs."""
    return rows.withColumn(name, tagged(F.col(text), F.col(terms), *tags, normal))


def snippets(rows: DataFrame, text: str, terms: str, n: int = 3, size: int = 100, tags: tuple[str, str] = SNIPPET_TAGS,
             normal: TermStep = F.lower, encode: bool = False, keep: tuple[str, ...] = ("query_id", "doc_id")) -> DataFrame:
    """The ``n`` best fragments of about ``size`` characters per row, in order of merit.

    A fragment ends with a whole word. More different terms first, then more matches, then the earlier.
    """
    fragments = F.regexp_extract_all(F.col(text), F.lit(rf"(?s)\S.{{0,{size - 1}}}\S*"), F.lit(0))

    def rated(fragment: Column, at: Column) -> Column:
        found = F.filter(F.transform(tok_standard(fragment), normal), lambda t: F.array_contains(F.col(terms), t))
        return F.struct(
            F.size(F.array_distinct(found)).alias("n_terms"),
            F.size(found).alias("n_matches"),
            (-at).alias("back"),
            fragment.alias("fragment"),
        )

    best = F.slice(
        F.sort_array(F.filter(F.transform(fragments, rated), lambda f: f["n_terms"] > 0), asc=False), 1, n
    )
    return (
        rows.select(*keep, terms, F.posexplode(best).alias("snippet_no", "_f"))
        .select(
            *keep,
            "snippet_no",
            F.col("_f.n_terms").alias("n_terms"),
            tagged(F.col("_f.fragment"), F.col(terms), *tags, normal, encode).alias("snippet"),
        )
    )


def with_alternate(hits: DataFrame, parts: DataFrame, index: DataFrame, key: str, alternate: str, length: int) -> DataFrame:
    """First snippet of each hit, or the start of another field, HTML-encoded, where there is none."""
    first = parts.filter(F.col("snippet_no") == 0).select("query_id", key, "snippet")
    return (
        hits.join(first, ["query_id", key], "left")
        .join(index.select(key, F.left(F.col(alternate), F.lit(length)).alias("_alt")), key)
        .withColumn("shown", F.coalesce("snippet", html_escape(F.col("_alt"))))
        .drop("snippet", "_alt")
    )

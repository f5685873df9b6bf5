"""Token, posting and term-statistics tables.

``tokens``   (key, len, pos, term): one row per token
``postings`` (key, len, term, tf): one row per document and term
``blocks``   (key, term, block, tf, positions): positions in blocks of bounded size

A document's number of tokens travels with its postings, so scoring needs no join with a length table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer, term_rows, token_rows
from lexshelf.functions.text import WORD
from lexshelf.session import cut, spread_join

BLOCK = 4096
GAP = 100
#: Words whose offsets are summed together.
SUMMED = 64


def tokenize(df: DataFrame, key: str, text: str, analyzer: Analyzer, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tokens of a table with one text per key."""
    return token_rows(df.select(key, *keep, text), text, analyzer, length="len")


def running_total(df: DataFrame, key: str, order: str, amount: Column, name: str, block: int = 1024) -> DataFrame:
    """Sum of ``amount`` over a key's earlier rows, ``order`` being an integer that numbers them.

    Summed within blocks of rows, then over block totals, so a key with very many rows is
    spread over tasks.
    """
    rows = df.withColumn("_block", F.floor(F.col(order) / block)).withColumn("_amount", amount)
    totals = rows.groupBy(key, "_block").agg(F.sum("_amount").alias("_total"))
    ahead = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_block", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("_inner", F.coalesce(F.sum("_amount").over(inner), F.lit(0)))
    return within.join(starts, [key, "_block"]).withColumn(name, F.col("_start") + F.col("_inner")).drop(
        "_block", "_amount", "_start", "_inner"
    )


def tokenize_values(
    values: DataFrame, key: str, order: str, text: str, analyzer: Analyzer, gap: int = GAP
) -> DataFrame:
    """Tokens of a multi-valued field: each value's positions start ``gap`` beyond the one before.

    ``values`` has a row per value, numbered from 0 by ``order`` within a key.
    """
    sized = values.select(key, order, analyzer(F.col(text)).alias("_tokens")).withColumn("_width", F.size("_tokens"))
    widths = running_total(
        sized.select(key, order, "_width"), key, order, F.col("_width").cast("bigint"), "_base"
    ).select(key, order, "_base")
    rows = sized.join(widths, [key, order]).select(
        key, F.posexplode_outer("_tokens").alias("_at", "term"), (F.col("_base") + F.col(order) * gap).alias("_first")
    )
    if analyzer.stacked:
        rows = rows.select(key, "_first", "_at", F.explode("term").alias("term"))
    return rows.filter(F.col("term") != "").select(
        key, (F.col("_first") + F.col("_at")).cast("bigint").alias("pos"), "term"
    )


def postings_of(df: DataFrame, key: str, text: str, analyzer: Analyzer) -> DataFrame:
    """Postings of a table with one text per key: worked out row by row, without a shuffle."""
    return term_rows(df.select(key, text), text, analyzer, "len")


def postings(tokens: DataFrame, key: str) -> DataFrame:
    """Term frequency per document (and field), for documents whose tokens come from several rows.

    A document's length is the number of its tokens over all rows, counted per term first.
    """
    owner = [c for c in ("field", key) if c in tokens.columns]
    counted = tokens.groupBy(*owner, "term").agg(F.count(F.lit(1)).alias("tf"))
    sizes = counted.groupBy(*owner).agg(F.sum("tf").alias("len"))
    return counted.join(sizes, owner).select(*owner, "len", "term", "tf")


def posting_blocks(tokens: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """Positions of a term in a document, at most ``block`` positions to a row."""
    keys = [c for c in ("field", key, "term") if c in tokens.columns]
    return (
        tokens.withColumn("block", F.floor(F.col("pos") / block))
        .groupBy(*keys, "block")
        .agg(F.count(F.lit(1)).alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))
    )


def term_stats(post: DataFrame) -> DataFrame:
    """Documents and occurrences per term."""
    keys = [c for c in ("field", "term") if c in post.columns]
    return post.groupBy(*keys).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def doc_lengths(tokens: DataFrame, key: str) -> DataFrame:
    return tokens.groupBy(key).agg(F.count(F.lit(1)).alias("len"))


def restrict(tokens: DataFrame, clauses: DataFrame, frequency: DataFrame | None = None) -> DataFrame:
    """Only tokens some query asks for; done before any other shuffle of the tokens.

    The wanted terms are stored first: Spark sees their size and brings few of them to the tokens, which then stay where they are.
    Where they are many, a frequent term is split by its ``frequency`` ([field], term, n), or by a count of the tokens.
    """
    keys = [c for c in ("field", "term") if c in tokens.columns and c in clauses.columns]
    return spread_join(tokens, cut(clauses.select(*keys).distinct()), keys, "left_semi", frequency=frequency)


def terms(stats: DataFrame, prefix: str = "", sort: str = "count", limit: int = 10) -> DataFrame:
    """Term list with document frequency, by count or by term."""
    rows = stats.filter(F.col("term").startswith(prefix)) if prefix else stats
    order = [F.desc("df"), F.asc("term")] if sort == "count" else [F.asc("term")]
    return rows.select("term", "df").orderBy(*order).limit(limit)


def term_vectors(post: DataFrame, key: str, docs: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Term vector rows of the wanted documents: tf, df and their quotient; ``stats`` are the stored term statistics, if there are."""
    wanted = post if docs is None else post.join(docs.select(key).distinct(), key, "left_semi")
    stats = cut(term_stats(post)) if stats is None else stats
    return spread_join(wanted, stats, ["term"], frequency=stats.select("term", F.col("df").alias("n"))).select(
        key, "term", "tf", "df", (F.col("tf") / F.col("df")).alias("tf_idf")
    )


def token_offsets(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, pos, start, end) of the words of one text per key: characters from start up to end.

    Within the row: the text is cut into words and what stands between them, which take turns, so the lengths of the words and those of
    the gaps are two arrays. Blocks of SUMMED words are summed first, then each word within its block, so a long text costs no square.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    gaps = F.split(F.col(text), WORD, -1)
    rows = df.select(key, words.alias("_w"), F.transform(gaps, F.length).alias("_g"))
    # what stands before the i-th word: its gap and, but for the first, the word before that gap
    step = F.transform("_w", lambda w, i: F.get("_g", i) + F.when(i > 0, F.length(F.get("_w", i - 1))).otherwise(0))
    rows = rows.select(key, "_w", step.alias("_step")).where(F.size("_w") > 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / SUMMED).cast("int"))
    rows = rows.select(key, "_w", "_step", F.transform(blocks, lambda b: total(F.slice("_step", b * SUMMED + 1, F.lit(SUMMED)))).alias("_sums"))
    starts = F.transform(
        blocks,
        lambda b: F.struct(
            (b * SUMMED).alias("first"),
            F.slice("_w", b * SUMMED + 1, F.lit(SUMMED)).alias("words"),
            F.slice("_step", b * SUMMED + 1, F.lit(SUMMED)).alias("steps"),
            total(F.slice("_sums", F.lit(1), b)).alias("base"),
        ),
    )
    rows = rows.select(key, F.inline(starts))
    placed = F.transform(
        "words",
        lambda w, i: F.struct(
            F.lower(w).alias("term"),
            (F.col("first") + i).cast("bigint").alias("pos"),
            (F.col("base") + total(F.slice("steps", F.lit(1), i + 1))).alias("start"),
            F.length(w).alias("n"),
        ),
    )
    return rows.select(key, F.inline(placed)).select(key, "term", "pos", "start", (F.col("start") + F.col("n")).alias("end"))


def drop_stop_words(tokens: DataFrame, stop_words: DataFrame, word: str = "word", frequency: DataFrame | None = None) -> DataFrame:
    """Remove listed terms (a list of any length); positions stay as they are.

    This and the next two split a term by its ``frequency`` (term, n); without it the tokens are counted first, and should be stored.
    """
    return spread_join(tokens, stop_words.select(F.lower(word).alias("term")).distinct(), ["term"], "left_anti", frequency=frequency)


def override_stems(tokens: DataFrame, stems: DataFrame, frequency: DataFrame | None = None) -> DataFrame:
    """Replace terms by the stem a (word, stem) table of any length gives; of several for one word, the least."""
    rest = [c for c in tokens.columns if c != "term"]
    one = stems.groupBy(F.col("word").alias("term")).agg(F.min("stem").alias("stem"))
    return spread_join(tokens, one, ["term"], "left", frequency=frequency).select(*rest, F.coalesce("stem", "term").alias("term"))


def join_synonyms(tokens: DataFrame, rules: DataFrame, frequency: DataFrame | None = None) -> DataFrame:
    """Put every target of a (source, target) table of any length at the token's position; others stay."""
    rest = [c for c in tokens.columns if c != "term"]
    targets = rules.select(F.col("source").alias("term"), "target").distinct()
    return spread_join(tokens, targets, ["term"], "left", frequency=frequency).select(*rest, F.coalesce("target", "term").alias("term"))

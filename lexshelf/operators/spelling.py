"""Spelling, word breaks, collation, suggestions: joins of query words with the term table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.session import cut


def _segment(term: Column, size: Column, j: int, parts: int) -> Column:
    start = F.floor(size * j / parts)
    return F.substr(term, (start + 1).cast("int"), (F.floor(size * (j + 1) / parts) - start).cast("int"))


#: Terms up to this length are looked up by what deletions leave of them; their segments would be single letters.
SHORT = 6


def _deletions(term: Column, edits: int) -> Column:
    """The term and all strings that up to ``edits`` deletions leave of it."""

    def without_one(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(t))
        left = F.transform(places, lambda i: F.concat(F.left(t, i - 1), F.substr(t, i + 1)))
        return F.when(F.length(t) > 0, left).otherwise(F.array().cast("array<string>"))

    found = last = F.array(term)
    for _ in range(edits):
        last = F.array_distinct(F.flatten(F.transform(last, without_one)))
        found = F.concat(found, last)
    return F.array_distinct(found)


def held_terms(stats: DataFrame, prefix: int) -> DataFrame:
    return stats.select("term", "df", F.left("term", F.lit(prefix)).alias("_head"), F.length("term").cast("int").alias("_n"))


def near_terms(stats: DataFrame, words: DataFrame, edits: int = 2, prefix: int = 1, vocabulary=None) -> DataFrame:
    """Pairs (word, term, distance) at 1 to ``edits`` edits that share their first ``prefix`` letters.

    A long term is cut into edits + 1 segments: with so few edits one of them, the j-th, stays whole in the
    word, with at most j edits before it and edits - j after it, which bounds how far it has moved.
    A short term and a word so close leave the same string after at most ``edits`` deletions each. So equi-joins on
    segments and on such strings find every pair, and no two terms are compared that share neither. ``vocabulary`` has the terms'
    side of both joins stored; without it that is made from ``stats``.
    """
    if vocabulary is not None and (vocabulary.edits, vocabulary.prefix) != (edits, prefix):
        raise ValueError(f"the vocabulary is for {vocabulary.edits} edits after {vocabulary.prefix} letters")
    held = held_terms(stats, prefix)
    short, longer = (short_terms(held, edits), long_terms(held, edits)) if vocabulary is None else (vocabulary.left, vocabulary.segments)
    asked = words.select("word", F.left("word", F.lit(prefix)).alias("_head"), F.length("word").alias("_size")).distinct()
    asked = cut(asked)
    pairs = _near_long(longer, asked, edits).union(_near_short(short, asked, edits))
    return (
        pairs.withColumn("distance", F.levenshtein("word", "term", edits))
        .filter(F.col("distance") > 0)
        .select("word", "term", "df", "distance")
        .distinct()
    )


def short_terms(held: DataFrame, edits: int) -> DataFrame:
    """Short terms under what deletions leave of them: (term, df, _head, _left)."""
    return held.filter(F.col("_n") <= SHORT).select("term", "df", "_head", F.explode(_deletions(F.col("term"), edits)).alias("_left"))


def long_terms(held: DataFrame, edits: int) -> DataFrame:
    """Longer terms under their edits + 1 segments: (term, df, _head, _n, _j, _seg)."""
    parts = edits + 1
    segments = F.array(*[_segment(F.col("term"), F.col("_n"), j, parts) for j in range(parts)])
    return held.filter(F.col("_n") > SHORT).select("term", "df", "_head", "_n", F.posexplode(segments).alias("_j", "_seg"))


def _near_short(terms: DataFrame, asked: DataFrame, edits: int) -> DataFrame:
    near = asked.filter(F.col("_size") <= SHORT + edits).select("word", "_head", F.explode(_deletions(F.col("word"), edits)).alias("_left"))
    # stored: Spark sees how few strings a few words make, and reads the terms for them
    return terms.join(cut(near), ["_head", "_left"]).select("word", "term", "df")


def _near_long(held: DataFrame, asked: DataFrame, edits: int) -> DataFrame:
    parts = edits + 1
    asked = asked.select("*", F.explode(F.sequence(F.greatest(F.col("_size") - edits, F.lit(1)), F.col("_size") + edits)).alias("_n"))
    asked = asked.filter(F.col("_n") > SHORT).select("*", F.explode(F.sequence(F.lit(0), F.lit(edits))).alias("_j"))
    asked = asked.select("*", F.explode(F.sequence(F.lit(-edits), F.lit(edits))).alias("_shift"))
    start = F.floor(F.col("_n") * F.col("_j") / parts)
    length = F.floor(F.col("_n") * (F.col("_j") + 1) / parts) - start
    asked = (
        asked.withColumn("_at", (start + F.col("_shift")).cast("int"))
        .withColumn("_len", length.cast("int"))
        .filter((F.col("_at") >= 0) & (F.col("_at") + F.col("_len") <= F.col("_size")))
        .filter(F.abs("_shift") <= F.col("_j"))
        .filter(F.abs(F.col("_shift") - (F.col("_size") - F.col("_n"))) <= edits - F.col("_j"))
        .select("word", "_head", "_n", "_j", F.substr(F.col("word"), F.col("_at") + 1, F.col("_len")).alias("_seg"))
        .distinct()
    )
    return held.join(cut(asked), ["_head", "_n", "_j", "_seg"]).select("word", "term", "df")


def spellcheck(
    stats: DataFrame,
    words: DataFrame,
    n_docs: Column,
    n: int,
    edits: int = 2,
    prefix: int = 1,
    min_length: int = 4,
    max_frequency: float = 0.01,
    accuracy: float = 0.5,
    vocabulary=None,
) -> DataFrame:
    """Suggestions per rare word: (word, suggestion, distance, df, rank), nearest then most frequent first."""
    own = stats.select(F.col("term").alias("word"), F.col("df").alias("_own"))
    rare = (
        words.select("word").distinct()
        .filter(F.length("word") >= min_length)
        .join(own, "word", "left")
        .filter(F.coalesce("_own", F.lit(0)) <= n_docs * max_frequency)
        .select("word")
    )
    close = near_terms(stats, rare, edits, prefix, vocabulary)
    similarity = 1 - F.col("distance") / F.least(F.length("word"), F.length("term"))
    order = Window.partitionBy("word").orderBy("distance", F.desc("df"), "term")
    return (
        close.filter(similarity >= accuracy)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("word", F.col("term").alias("suggestion"), "distance", "df", "rank")
    )


def word_breaks(stats: DataFrame, words: DataFrame) -> DataFrame:
    """Words that are two index terms run together: (word, left, right)."""
    n = F.length("word")
    cuts = (
        words.select("word").distinct()
        .filter(n >= 2)
        .select("word", F.explode(F.sequence(F.lit(1), n - 1)).alias("_i"))
        .select("word", F.left("word", F.col("_i")).alias("left"), F.substr(F.col("word"), F.col("_i") + 1).alias("right"))
    )
    first = stats.select(F.col("term").alias("left"), F.col("df").alias("left_df"))
    second = stats.select(F.col("term").alias("right"), F.col("df").alias("right_df"))
    return cuts.join(first, "left").join(second, "right").select("word", "left", "right", "left_df", "right_df")


def word_joins(stats: DataFrame, words: DataFrame) -> DataFrame:
    """Neighbouring query words ``(query_id, pos, word)`` that are one index term: (query_id, pos, term, df)."""
    following = words.select("query_id", (F.col("pos") - 1).alias("pos"), F.col("word").alias("_next"))
    return (
        words.join(following, ["query_id", "pos"])
        .select("query_id", "pos", F.concat("word", "_next").alias("term"))
        .join(stats.select("term", "df"), "term")
    )


def collate(words: DataFrame, suggestions: DataFrame, post: DataFrame, key: str) -> DataFrame:
    """The best corrected query that has hits: (query_id, rank_sum, corrected, hits).

    ``words``: (query_id, pos, word). A misspelt word (one with suggestions) takes any of them, the others stay. Of all
    combinations with hits the one with the least sum of ranks wins, then the first in order. Combinations are not
    enumerated: per document each place takes the best option that the document holds, which gives the best combination
    that hits it; the best of these is the best of all, and the documents that gave it are its hits.
    """
    ranked = suggestions.select("word", F.col("suggestion").alias("term"), "rank")
    options = cut(
        words.join(ranked, "word", "left").select(
            "query_id", "pos", F.coalesce("term", "word").alias("term"), F.coalesce("rank", F.lit(0)).alias("rank")
        )
    )
    need = cut(words.groupBy("query_id").agg(F.count_distinct("pos").alias("_need")))
    places = (
        post.select(key, "term").distinct().join(options, "term")
        .groupBy("query_id", key, "pos")
        .agg(F.min(F.struct("rank", "term")).alias("_best"))
    )
    found = places.groupBy("query_id", key).agg(
        F.count(F.lit(1)).alias("_got"),
        F.sum("_best.rank").cast("bigint").alias("rank_sum"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_best.term"))), lambda s: s["term"]), " ").alias("corrected"),
    )
    counted = (
        found.join(need, "query_id")
        .filter(F.col("_got") == F.col("_need"))
        .groupBy("query_id", "rank_sum", "corrected")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    best = counted.groupBy("query_id").agg(F.min(F.struct("rank_sum", "corrected", "hits")).alias("_b"))
    return best.select("query_id", "_b.rank_sum", "_b.corrected", "_b.hits")


def _masked(c: Column) -> Column:
    """The string with each of its letters hidden in turn."""
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.left(c, i - 1), F.lit("\u0001"), F.substr(c, i + 1)))


def suggest(df: DataFrame, field: str, weight: str, prefixes: DataFrame, n: int = 10) -> DataFrame:
    """Values that start with a prefix ``(query_id, prefix)``, one wrong letter allowed, heaviest first.

    Start and prefix are equally long, so they agree in all letters but one at most: an equi-join on strings with one letter
    hidden finds every candidate, and only such.
    """
    asked = prefixes.filter(F.length("prefix") > 0).select("query_id", "prefix", F.length("prefix").alias("_n"))
    lengths = asked.select(F.collect_set("_n")).scalar()
    values = df.filter(F.col(field).isNotNull()).groupBy(F.col(field).alias("value")).agg(F.max(weight).alias("weight"))
    held = (
        values.select("value", "weight", F.explode(lengths).alias("_n"))
        .filter(F.length("value") >= F.col("_n"))
        .select("value", "weight", F.explode(_masked(F.left("value", F.col("_n")))).alias("_hidden"))
    )
    pairs = (
        held.join(asked.select("query_id", "prefix", F.explode(_masked(F.col("prefix"))).alias("_hidden")), "_hidden")
        .select("query_id", "prefix", "value", "weight")
        .distinct()
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("weight"), "value")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

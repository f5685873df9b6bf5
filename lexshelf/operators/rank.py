"""Scores, ordering, paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.operators.postings import restrict, term_stats
from lexshelf.session import cut, join_by, spread_join

# the session's bound for row_number limits that Spark applies inside every map task before the shuffle
GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def term_weights(
    post: DataFrame, clauses: DataFrame, n_docs: Column, model: str = "tfidf", avg_len: Column | None = None, stats: DataFrame | None = None
) -> DataFrame:
    """Clauses with the weight of their term; one narrow row per clause. ``stats`` are stored term statistics, if there are.

    Worth storing before ``explain_scores``: then its size is known, and Spark broadcasts it or not
    by that.
    """
    keys = _keys(post, clauses)
    stats = term_stats(restrict(post, clauses)) if stats is None else stats
    rated = clauses.join(stats.select(*keys, "df"), keys).withColumn("_n", n_docs)
    if model == "tfidf":
        weight = F.pow(F.lit(1.0) + F.log(F.col("_n") / (F.col("df") + 1)), F.lit(2.0))
        return rated.withColumn("weight", weight).drop("_n", "df")
    if model == "bm25":
        weight = F.log(F.lit(1.0) + (F.col("_n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return rated.withColumn("weight", weight).withColumn("avg_len", avg_len).drop("_n", "df")
    raise ValueError(model)


def _keys(post: DataFrame, clauses: DataFrame) -> list[str]:
    return [c for c in ("field", "term") if c in post.columns and c in clauses.columns]


def explain_scores(
    post: DataFrame, weights: DataFrame, k1: float = 1.2, b: float = 0.75, frequency: DataFrame | None = None,
    key: str | None = None, parts: int | None = None,
) -> DataFrame:
    """What each term adds to each hit's score. A frequent term is split by its ``frequency`` ([field], term, n); see ``spread_join``.
    With ``key`` postings are dealt out by document instead, so that ``score`` shuffles nothing; see ``join_by``.

    tfidf: sqrt(tf) * (1 + ln(n / (df + 1)))^2 / sqrt(len); bm25, for weights with an average length:
    Okapi with k1 and b.
    """
    if "avg_len" in weights.columns:
        value = F.col("weight") * F.col("tf") * (k1 + 1) / (
            F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len"))
        )
    else:
        value = F.sqrt("tf") * F.col("weight") / F.sqrt("len")
    keys = _keys(post, weights)
    both = spread_join(post, weights, keys, frequency=frequency) if key is None else join_by(post, weights, keys, key, parts)
    return both.withColumn("value", value).drop("weight", "avg_len")


def score(parts: DataFrame, key: str) -> DataFrame:
    """Hits ``(query_id, key, score, n_terms)`` from score parts."""
    return parts.groupBy("query_id", key).agg(
        F.sum("value").alias("score"), F.count(F.lit(1)).alias("n_terms")
    )


def dismax(parts: DataFrame, key: str, weights: dict[str, float], clauses: DataFrame, match: float = 1.0) -> DataFrame:
    """Best weighted field per term, summed over terms; at least ``match`` of the terms must occur."""
    boost = F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("field"))
    best = parts.groupBy("query_id", key, "term").agg(F.max(F.col("value") * boost).alias("value"))
    need = cut(clauses.groupBy("query_id").agg(F.ceil(F.count_distinct("term") * match).alias("_need")))
    return score(best, key).join(need, "query_id").filter(F.col("n_terms") >= F.col("_need")).drop("_need")


def boost(hits: DataFrame, index: DataFrame, key: str, extra: Column) -> DataFrame:
    """Add a function of the document's fields to the score."""
    by = index.select(key, extra.alias("_extra"))
    return hits.join(by, key).withColumn("score", F.col("score") + F.col("_extra")).drop("_extra")


def sort_key(df: DataFrame, field: str, descending: bool) -> Column:
    """Sort expression; missing values last; a multi-valued field by its least or greatest value."""
    c = F.col(field)
    if df.schema[field].dataType.typeName() == "array":
        c = F.array_max(c) if descending else F.array_min(c)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def sort_hits(hits: DataFrame, field: str, key: str, descending: bool = True) -> DataFrame:
    """Total order; equal values by key."""
    return hits.orderBy(sort_key(hits, field, descending), F.col(key).asc())


def top_k(hits: DataFrame, k: int, key: str, by: str = "query_id", order: list[Column] | None = None) -> DataFrame:
    """The first ``k`` rows of each query with their rank.

    Each map task keeps at most k rows a query before the shuffle; for large k that is done here by
    ranking within slices first.
    """
    order = order or [F.desc("score")]
    full = [*order, F.col(key).asc()]
    if k > int(hits.sparkSession.conf.get(GROUP_LIMIT_KEY)):
        sliced = Window.partitionBy(by, "_slice").orderBy(*full)
        hits = (
            hits.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(64)))
            .withColumn("_rank", F.row_number().over(sliced))
            .filter(F.col("_rank") <= k)
            .drop("_slice", "_rank")
        )
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*full)))
    return ranked.filter(F.col("rank") <= k)


def page(hits: DataFrame, number: int, size: int, key: str, order: list[Column] | None = None) -> DataFrame:
    """Page ``number`` (from 1) of every query, with the query's total; ``hits``, read twice, should be stored."""
    total = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    rows = top_k(hits, number * size, key, order=order).filter(F.col("rank") > (number - 1) * size)
    return rows.join(total, "query_id")


def random_order(df: DataFrame, key: str, seed: int) -> DataFrame:
    """All rows with a number ``random`` to sort by: the same for the same seed."""
    return df.withColumn("random", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))


def elevate(hits: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Pinned documents first, in the order of the rules, also when they did not match; excluded ones gone.

    ``rules``: (query_id, key, pin_rank, excluded).
    """
    pins = rules.filter(~F.col("excluded")).select("query_id", key, "pin_rank")
    kept = hits.join(rules.filter("excluded").select("query_id", key), ["query_id", key], "left_anti")
    return kept.join(pins, ["query_id", key], "full")


def numbered(hits: DataFrame, order: list[Column], key: str) -> DataFrame:
    """All hits with their place 1, 2, ... in a total order.

    Sorted by ranges over all tasks; a place is the one within its range after the rows of the ranges before. The ranges are
    written first, so that both parts see the same ones.
    """
    full = [*order, F.col(key).asc()]
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(hits.repartitionByRange(parts, *full).withColumn("_slice", F.spark_partition_id()))
    counts = ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = counts.select("_slice", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*full))
    return ranged.withColumn("_at", within).join(starts, "_slice").withColumn(
        "place", (F.col("_start") + F.col("_at")).cast("bigint")
    ).drop("_slice", "_at", "_start")

"""Facet counts, groups and field statistics. Every count is a partial aggregation before its shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.functions.dates import LEAST_SECONDS, add_units, moment, parse_step
from lexshelf.operators.postings import restrict, term_stats
from lexshelf.operators.rank import top_k
from lexshelf.session import cut, spread_join


def facet_fields(index: DataFrame, fields: list[str], hits: DataFrame | None = None, key: str = "doc_id",
                 mincount: int = 1, by: list[str] | None = None) -> DataFrame:
    """Counts of the values of several fields in one pass over the matching documents."""
    rows = index
    by = by or []
    if hits is not None:
        by = [*by, "query_id"]
        rows = index.select(key, *fields).join(hits.select("query_id", key), key)
    pairs = [
        F.struct(
            F.lit(f).alias("field"),
            (F.col(f).cast("array<string>") if index.schema[f].dataType.typeName() == "array"
             else F.array(F.col(f).cast("string"))).alias("values"),
        )
        for f in fields
    ]
    values = rows.select(*by, F.explode(F.array(*pairs)).alias("_p")).select(
        *by, "_p.field", F.explode(F.array_distinct("_p.values")).alias("value")
    )
    counts = values.filter(F.col("value").isNotNull()).groupBy(*by, "field", "value").agg(
        F.count(F.lit(1)).alias("count")
    )
    return counts.filter(F.col("count") >= mincount) if mincount > 1 else counts


def facet_queries(index: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Documents per named predicate, all in one pass."""
    one = index.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])
    pairs = [F.struct(F.lit(n).alias("query"), F.col(n).alias("count")) for n in predicates]
    return one.select(F.inline(F.array(*pairs)))


def facet_range(index: DataFrame, column: str, start: float, end: float, gap: float, mincount: int = 0) -> DataFrame:
    """Counts per [start + i*gap, start + (i+1)*gap), with the rows before and after."""
    last = int(-((start - end) // gap)) - 1
    bucket = (
        F.when(F.col(column) < start, F.lit(-1))
        .when(F.col(column) >= start + (last + 1) * gap, F.lit(last + 1))
        .otherwise(F.floor((F.col(column) - start) / gap))
        .cast("int")
    )
    counts = index.filter(F.col(column).isNotNull()).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("_count")
    )
    return _fill(counts, last, mincount).select(
        F.when(F.col("bucket") < 0, "before").when(F.col("bucket") > last, "after").otherwise("range").alias("part"),
        F.when(F.col("bucket").between(0, last), F.lit(float(start)) + F.col("bucket") * F.lit(float(gap))).alias("low"),
        "count",
    )


def _fill(counts: DataFrame, last: int, mincount: int) -> DataFrame:
    """Empty buckets appear with 0 unless a least count is asked for."""
    if mincount > 0:
        return counts.select("bucket", F.col("_count").alias("count")).filter(F.col("count") >= mincount)
    slots = counts.sparkSession.range(-1, last + 2).select(F.col("id").cast(counts.schema["bucket"].dataType).alias("bucket"))
    return slots.join(counts, "bucket", "left").select("bucket", F.coalesce("_count", F.lit(0)).alias("count"))


def facet_date(index: DataFrame, column: str, start: str, end: str, gap: str, now: str | None = None, mincount: int = 0) -> DataFrame:
    """Counts per calendar step from ``start`` to ``end`` (not included), with the rows before and after.

    ``start`` and ``end`` are timestamps, or NOW with date math (``NOW/YEAR-10YEARS``); ``gap`` is a step such as ``+1MONTH``
    or ``+2DAYS``. A row's step is worked out from the calendar and set right by comparing with the edges beside it, each counted
    from ``start``, so the end of a short month falls where its edge says. The last step runs its whole length, as the numeric ranges do.
    """
    spark = index.sparkSession
    low, until = (moment(spark, text, now) for text in (start, end))
    number, unit = parse_step(gap)
    first = F.lit(low).cast("timestamp")

    def edge(step: Column) -> Column:
        amount = step * number
        return add_units(first, amount if unit in ("SECOND", "MILLISECOND") else amount.cast("int"), unit)

    def step_of(c: Column) -> Column:
        if unit in ("YEAR", "MONTH"):
            months = (F.year(c) - F.year(first)) * 12 + F.month(c) - F.month(first)
            guess = F.floor(months / (number * (12 if unit == "YEAR" else 1)))
        else:
            guess = F.floor((F.unix_micros(c) - F.unix_micros(first)) / (number * round(LEAST_SECONDS[unit] * 1_000_000)))
        guess = guess.cast("bigint")
        return F.when(edge(guess) > c, guess - 1).when(edge(guess + 1) <= c, guess + 1).otherwise(guess)

    stop = F.lit(until).cast("timestamp")
    last, exact = spark.range(1).select(step_of(stop), edge(step_of(stop)) == stop).first()
    last = max(last - exact, 0)
    c = F.col(column).cast("timestamp")
    bucket = F.greatest(F.lit(-1).cast("bigint"), F.least(F.lit(last + 1).cast("bigint"), step_of(c)))
    counts = index.filter(c.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("_count"))
    return _fill(counts, last, mincount).select(
        F.when(F.col("bucket") < 0, "before").when(F.col("bucket") > last, "after").otherwise("range").alias("part"),
        F.when(F.col("bucket").between(0, last), edge(F.col("bucket").cast("bigint"))).alias("low"),
        "count",
    )


def facet_pivot(index: DataFrame, columns: list[str]) -> DataFrame:
    """Nested counts: the first column alone, then with the second, and so on."""
    depth = len(columns)
    levels = reduce(lambda a, b: a + b, [F.when(F.grouping(c) == 0, 1).otherwise(0) for c in columns])
    return index.rollup(*columns).agg(
        F.count(F.lit(1)).alias("count"), levels.alias("level")
    ).filter((F.col("level") > 0) & (F.col("level") <= depth))


def group_results(hits: DataFrame, index: DataFrame, key: str, group: str, n: int,
                  order: list[Column] | None = None) -> DataFrame:
    """The first ``n`` hits of every group of a query, with the group's size and the query's matches.

    Hits without a value form a group of their own. ``hits`` is read three times: pass a stored table.
    """
    order = order or [F.desc("score")]
    rows = hits.join(index.select(key, F.col(group).alias("group_value")), key)
    sizes = rows.groupBy("query_id", "group_value").agg(F.count(F.lit(1)).alias("group_size"))
    matches = sizes.groupBy("query_id").agg(
        F.sum("group_size").alias("matches"), F.count(F.lit(1)).alias("n_groups")
    )
    w = Window.partitionBy("query_id", "group_value").orderBy(*order, F.col(key).asc())
    top = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    s, t = sizes.alias("s"), top.alias("t")
    sized = t.join(
        s, (F.col("t.query_id") == F.col("s.query_id")) & F.col("t.group_value").eqNullSafe(F.col("s.group_value"))
    ).select("t.*", "s.group_size")
    return sized.join(matches, "query_id")


def group_page(
    hits: DataFrame, index: DataFrame, key: str, group: str, number: int, size: int, n: int, digits: int = 6
) -> DataFrame:
    """Page ``number`` (from 1) of the groups of every query, ``size`` groups to a page, with the ``n`` best hits of each.

    Groups are ordered by their best hit, equal scores by key. The best hit, the size of every group and what a query has in all come from
    aggregations that sort nothing; only the groups of the page then have their hits ranked. Hits without a value form a group.
    Gives (query_id, key, score, group_value, group_rank, rank, group_size, matches, n_groups).
    """
    # null values need a name to be joined by
    rows = cut(
        hits.join(index.select(key, F.col(group).alias("group_value")), key).select(
            "query_id", key, F.round("score", digits).alias("score"), F.coalesce(F.concat(F.lit("="), F.col("group_value").cast("string")), F.lit("")).alias("_g"), "group_value"
        )
    )
    # the best score, then the least key that has it: the least struct of both would have all rows sorted
    by, least = ["query_id", "_g"], -F.col("score")
    sized = cut(rows.groupBy(*by).agg(F.when(F.count("score") == F.count(F.lit(1)), F.min(least)).alias("_s"), F.count(F.lit(1)).alias("group_size")))
    first = rows.join(sized, by).where(least.eqNullSafe(F.col("_s"))).groupBy(*by).agg(F.min(key).alias("_k"))
    groups = cut(sized.join(first, by).select(*by, F.struct("_s", "_k").alias("_best"), "group_size"))
    totals = groups.groupBy("query_id").agg(F.sum("group_size").alias("matches"), F.count(F.lit(1)).alias("n_groups"))
    ranked = top_k(groups, number * size, "_g", order=[F.asc("_best")]).where(F.col("rank") > (number - 1) * size)
    page = cut(ranked.select("query_id", "_g", F.col("rank").alias("group_rank"), "group_size").join(totals, "query_id"))
    order = Window.partitionBy("query_id", "_g").orderBy(F.desc("score"), key)
    best = rows.join(page, ["query_id", "_g"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return best.select("query_id", key, "score", "group_value", "group_rank", "rank", "group_size", "matches", "n_groups")


def field_stats(index: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """min, max, sum, count, missing, sum of squares, mean, standard deviation; per facet if asked."""
    c = F.col(column)
    return index.groupBy(*(by or [])).agg(
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.sum(c).alias("sum"),
        F.count(c).alias("count"),
        F.count_if(c.isNull()).alias("missing"),
        F.sum(c * c).alias("sum_of_squares"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
    )


def term_counts(post: DataFrame, clauses: DataFrame, key: str, stats: DataFrame | None = None) -> DataFrame:
    """For each query term and document: its frequency there, in all, and the documents holding it."""
    # one narrow row per clause, stored so that its size is known
    asked = cut(clauses.join(term_stats(restrict(post, clauses)) if stats is None else stats, "term"))
    return spread_join(post, asked, ["term"], frequency=asked.select("term", F.col("df").alias("n")).distinct()).select(
        "query_id", "term", key, "tf", "df", "ttf"
    )


def query_stop_words(queries: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Words of a query that the analysis drops: ``queries`` (query_id, term), ``stop_words`` (word)."""
    return queries.join(
        stop_words.select(F.lower("word").alias("term")).distinct(), "term", "left_semi"
    ).select("query_id", "term").distinct()

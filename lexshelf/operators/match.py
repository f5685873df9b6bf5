"""Matching query tables against postings, filters and document joins.

Queries come as clauses ``(query_id, [field], term)``, one row per term; matches are
``(query_id, key, [field], term, tf, len)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.functions.text import word_parts
from lexshelf.operators.postings import restrict
from lexshelf.operators.vocabulary import GRAM
from lexshelf.session import cut, join_by, spread_join


def match_terms(
    post: DataFrame, clauses: DataFrame, frequency: DataFrame | None = None, key: str | None = None, parts: int | None = None
) -> DataFrame:
    """Every (query, document, term) that agrees. A frequent term's postings are dealt over many tasks.

    ``frequency`` ([field], term, n) has the stored document frequencies; without it ``post`` is counted first, and should be stored.
    With ``key`` the wanted postings are dealt out by document instead, for matches that are counted or summed by it; see ``join_by``.
    """
    keys = [c for c in ("field", "term") if c in post.columns and c in clauses.columns]
    if key is not None:
        return join_by(post, clauses, keys, key, parts)
    return spread_join(post, clauses, keys, frequency=frequency)


def boolean_match(matches: DataFrame, clauses: DataFrame, key: str, op: str = "AND") -> DataFrame:
    """Documents that hold all (AND) or any (OR) of a query's terms; ``matches`` has one row per query, document and term.

    Clauses with a ``place`` hold alternatives: AND then wants every place met by one of its terms, and places are counted.
    """
    unit, name = ("place", "n_places") if "place" in clauses.columns else ("term", "n_terms")
    if unit == "place":
        matches = matches.groupBy("query_id", key, unit).agg(F.count(F.lit(1)).alias("_terms"))
    found = matches.groupBy("query_id", key).agg(F.count(F.lit(1)).alias(name))
    if op.upper() == "OR":
        return found
    need = cut(clauses.groupBy("query_id").agg(F.count_distinct(unit).alias("_need")))
    return found.join(need, "query_id").filter(F.col(name) == F.col("_need")).drop("_need")


def exclude(hits: DataFrame, post: DataFrame, unwanted: DataFrame, key: str) -> DataFrame:
    """Drop documents that hold any of a query's unwanted terms."""
    bad = match_terms(post, unwanted).select("query_id", key).distinct()
    return hits.join(bad, ["query_id", key], "left_anti")


def phrase_match(tokens: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """Places where a phrase ``(query_id, offset, term)`` stands word for word; terms of one offset are alternatives.

    Each phrase is looked up by the offset whose words are rarest together; the places found are then checked for the other
    words by one equi-join on (document, position, term). So a very frequent word costs no more
    than its own tokens, however many phrases hold it. Phrase leads and places are stored, so Spark
    knows their size when it plans the joins. ``tokens`` is read three times: pass a stored table, or search the position
    blocks of a stored index (``lookup.phrase_places``).
    """
    wanted = restrict(tokens, phrases).select(key, "pos", "term")
    frequency = cut(wanted.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    rated = cut(phrases.join(frequency, "term", "left").select("query_id", "offset", "term", F.coalesce("n", F.lit(0)).alias("_n")))
    places = rated.groupBy("query_id", "offset").agg(F.sum("_n").alias("_n"))
    leads = (
        places.groupBy("query_id")
        .agg(F.min(F.struct("_n", "offset")).alias("_lead"), F.count(F.lit(1)).alias("_words"))
        .filter(F.col("_lead._n") > 0)
        .select("query_id", "_words", F.col("_lead.offset").alias("offset"))
    )
    leads = cut(rated.join(leads, ["query_id", "offset"]).select("query_id", "_words", F.col("offset").alias("_offset"), "term"))
    starts = cut(
        spread_join(wanted, leads, ["term"], frequency=frequency).select(
            "query_id", key, (F.col("pos") - F.col("_offset")).cast("bigint").alias("start"), "_words"
        )
    )
    expected = cut(
        spread_join(starts, phrases.select("query_id", "offset", "term"), ["query_id"]).select(
            "query_id", key, "start", "_words", (F.col("start") + F.col("offset")).alias("pos"), "term"
        )
    )
    found = expected.join(wanted.withColumn("pos", F.col("pos").cast("bigint")), [key, "pos", "term"])
    return (
        found.groupBy("query_id", key, "start", "_words")
        .agg(F.count_distinct("pos").alias("_found"))
        .filter(F.col("_found") == F.col("_words"))
        .select("query_id", key, "start")
    )


#: Letters of a literal inside a pattern that terms are looked up by.
INSIDE = 3


def _like(pattern: Column) -> Column:
    """The pattern as LIKE writes it."""
    like = F.replace(F.replace(pattern, F.lit("\\"), F.lit("\\\\")), F.lit("%"), F.lit("\\%"))
    return F.translate(F.replace(like, F.lit("_"), F.lit("\\_")), "*?", "%_")


def expand_wildcards(stats: DataFrame, patterns: DataFrame, vocabulary=None) -> DataFrame:
    """Index terms each ``(query_id, pattern)`` stands for; ``*`` any run, ``?`` one character.

    Joined on the pattern's literal start or end, whichever is longer, or else on the first letters of its longest
    literal inside, then checked in full. A pattern without a literal is compared with all terms, which are dealt out.
    With a stored ``vocabulary`` a pattern that has three letters together is looked up by the three that fewest terms have.
    All terms are kept. What is found is stored before it is counted, so ``stats`` is read once.
    """
    if vocabulary is not None:
        patterns = cut(patterns)
        pieces = F.split("pattern", "[*?]")
        size = F.lit(GRAM)
        cuts = F.transform(pieces, lambda p: F.when(F.length(p) >= size, F.transform(F.sequence(F.lit(1), F.length(p) - size + 1), lambda i: F.substr(p, i, size))))
        asked = patterns.select("query_id", "pattern", F.explode(F.flatten(F.array_compact(cuts))).alias("gram"))
        # a run that no term has finds nothing, which is right
        rare = asked.join(vocabulary.often, "gram", "left").groupBy("query_id", "pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("_g"))
        rare = cut(rare.select("query_id", "pattern", F.col("_g.gram").alias("gram"), _like(F.col("pattern")).alias("_like")))
        by_gram = vocabulary.grams.join(rare, "gram").where(F.expr("term LIKE _like")).select("query_id", "pattern", *stats.columns)
        rest = patterns.join(rare.select("query_id", "pattern"), ["query_id", "pattern"], "left_anti")
        found = by_gram.unionByName(expand_wildcards(stats, rest).drop("n_terms"))
        found = cut(found)
        size = cut(found.groupBy("query_id", "pattern").agg(F.count(F.lit(1)).alias("n_terms")))
        return found.join(size, ["query_id", "pattern"]).select("query_id", "pattern", *stats.columns, "n_terms")
    star = F.regexp_replace(F.col("pattern"), r"[*?].*$", "")
    tail = F.regexp_replace(F.col("pattern"), r"^.*[*?]", "")
    inner = F.array_max(F.transform(F.split("pattern", "[*?]"), lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    side = F.when((star == "") & (tail == ""), "inside").when(F.length(tail) > F.length(star), "end").otherwise("start")
    keyed = patterns.withColumn("_side", side).withColumn(
        "_anchor", F.when(F.col("_side") == "inside", F.left(inner, F.lit(INSIDE))).when(F.col("_side") == "end", tail).otherwise(star)
    )
    keyed = keyed.withColumn("_n", F.length("_anchor"))
    like = _like(F.col("pattern"))
    plain = F.col("pattern") == F.when(F.col("_side") == "end", F.concat(F.lit("*"), "_anchor")).otherwise(F.concat("_anchor", F.lit("*")))
    # stored: Spark then knows how few patterns there are when it plans the join
    keyed = cut(keyed.withColumn("_like", F.when(~plain, like)))
    # the few (side, length) combinations the patterns use
    shapes = keyed.select(F.collect_set(F.struct("_side", "_n"))).scalar()
    term, n = F.col("term"), F.col("_shape._n")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(term) - n + 1, F.lit(1))), lambda i: F.substr(term, i, n))
    anchors = (
        F.when((F.col("_shape._side") == "inside") & (n > 0), F.array_distinct(runs))
        .when(F.col("_shape._side") == "end", F.array(F.right(term, n)))
        .otherwise(F.array(F.left(term, n)))
    )
    anchored = stats.select("*", F.explode(shapes).alias("_shape")).select(
        *stats.columns, F.col("_shape._side").alias("_side"), F.col("_shape._n").alias("_n"), F.explode(anchors).alias("_anchor")
    )
    found = anchored.join(keyed, ["_side", "_n", "_anchor"]).filter(F.expr("_like IS NULL OR term LIKE _like"))
    found = cut(found.select("query_id", "pattern", *stats.columns))
    size = cut(found.groupBy("query_id", "pattern").agg(F.count(F.lit(1)).alias("n_terms")))
    return found.join(size, ["query_id", "pattern"]).select("query_id", "pattern", *stats.columns, "n_terms")


def match_all(index: DataFrame, key: str) -> DataFrame:
    return index.select(key, F.lit(1.0).alias("score"))


def range_filter(
    c: Column, low=None, high=None, include_low: bool = True, include_high: bool = True
) -> Column:
    """``[a TO b]``, ``[a TO b}`` and open ends (None or ``*``)."""
    keep = F.lit(True) if low in (None, "*") and high in (None, "*") else None
    if low not in (None, "*"):
        keep = c >= F.lit(low) if include_low else c > F.lit(low)
    if high not in (None, "*"):
        top = c <= F.lit(high) if include_high else c < F.lit(high)
        keep = top if keep is None else keep & top
    return keep & c.isNotNull()


def _bins(low: Column, high: Column) -> Column:
    """Array of (level, node): the fewest bins of a power of two cells, at multiples of their size, that make up cells low to high."""

    def at(level: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        first = F.ceil(low / width).cast("bigint")
        last = (F.floor((high + 1) / width) - 1).cast("bigint")
        left = F.when((first <= last) & (F.abs(first) % 2 == 1), F.struct(level.alias("level"), first.alias("node")))
        right = F.when((first <= last) & (F.abs(last) % 2 == 0), F.struct(level.alias("level"), last.alias("node")))
        return F.array_compact(F.array(left, right))

    top = F.ceil(F.log2((high - low + 1).cast("double"))).cast("int")
    return F.when(low <= high, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(top, F.lit(0))), at)))


def range_table(df: DataFrame, column: str, ranges: DataFrame, unit: float, sums: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` beside every range that holds their value: the columns of both; with ``sums`` what ``range_sums`` gives.

    ``ranges`` has query_id, low, high (null: open end) and whether the ends count, include_low and include_high. Values fall into cells of
    ``unit``, a range is cut into bins of a power of two cells, about two for each level, and a value is looked up in the bin of each level
    that some range uses: an equi-join that finds each pair once, whose pairs are then checked with the ends. Open ends are
    closed at the least and greatest value there is.
    """
    if sums is not None:
        return range_sums(df, column, ranges, sums)
    value = F.col(column).cast("double")
    cell = F.floor(value / unit).cast("bigint")
    ends = df.agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    placed = ranges.crossJoin(ends).select(  # one row of ends
        *ranges.columns,
        F.floor(F.greatest(F.coalesce(low, "_least"), F.col("_least")) / unit).cast("bigint").alias("_a"),
        F.floor(F.least(F.coalesce(high, "_most"), F.col("_most")) / unit).cast("bigint").alias("_b"),
    )
    cut_up = cut(placed.select(*ranges.columns, F.inline(_bins(F.col("_a"), F.col("_b")))))
    levels = cut_up.select(F.collect_set("level")).scalar()
    rows = df.where(value.isNotNull()).withColumn("_cell", cell).select("*", F.explode(levels).alias("level"))
    node = F.call_function("shiftright", F.col("_cell"), F.col("level"))
    pairs = rows.withColumn("node", node).drop("_cell").join(cut_up, ["level", "node"])
    above = F.when(F.col("include_low"), value >= low).otherwise(value > low)
    below = F.when(F.col("include_high"), value <= high).otherwise(value < high)
    return pairs.where((low.isNull() | above) & (high.isNull() | below)).drop("level", "node")


def range_sums(df: DataFrame, column: str, ranges: DataFrame, sums: list[str]) -> DataFrame:
    """(query_id, n, one column for each of ``sums``): how many rows of ``df`` each query's ranges hold, and the sums of integer columns over them.

    What ``range_table`` followed by a count and sums gives, without its pairs: the rows with a value before a range's end, less those before
    its start. Values, added up first where they are equal, and ends are put in one order over all tasks; a running total within each slice
    of it goes on from the totals of the slices before. So each row and each end is moved once, however wide the ranges are.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    value, low, high = F.col(column).cast("double"), F.col("low").cast("double"), F.col("high").cast("double")
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    totals = [f"{kind}{i}" for kind in ("s", "k") for i in range(len(sums))]
    held = df.where(value.isNotNull()).groupBy(value.alias("x")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(whole(c)).alias(f"s{i}") for i, c in enumerate(sums)], *[F.count(c).alias(f"k{i}") for i, c in enumerate(sums)]
    )
    held = held.select("x", F.lit(1).alias("kind"), F.lit(None).cast(ranges.schema["query_id"].dataType).alias("query_id"), F.lit(0).alias("sign"), "n", *totals)
    # ends stand before (0) or behind (2) the rows of their own value; an open end has none
    some = low.isNull() | high.isNull() | (low < high) | ((low == high) & F.col("include_low") & F.col("include_high"))
    start = F.struct(low.alias("x"), F.when(F.col("include_low"), 0).otherwise(2).alias("kind"), F.lit(-1).alias("sign"))
    stop = F.struct(F.coalesce(high, F.lit(float("inf"))).alias("x"), F.when(high.isNull() | F.col("include_high"), 2).otherwise(0).alias("kind"), F.lit(1).alias("sign"))
    ends = ranges.where(some).select("query_id", F.inline(F.array(start, stop))).where("x IS NOT NULL")
    nothing = [F.lit(0).cast(held.schema[c].dataType).alias(c) for c in ("n", *totals)]
    rows = held.unionByName(ends.select("x", "kind", "query_id", "sign", *nothing))
    # many ends may be equal: any order among them will do
    rows = rows.withColumn("deal", F.xxhash64("query_id"))
    ranged = cut(rows.repartitionByRange(parts, "x", "kind", "deal").withColumn("slice", F.spark_partition_id()))
    names = ["n", *totals]
    sliced = ranged.groupBy("slice").agg(*[F.sum(c).alias(c) for c in names])
    ahead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    before = cut(sliced.select("slice", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"b_{c}") for c in names]))
    upto = Window.partitionBy("slice").orderBy("x", "kind", "deal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = ranged.select("slice", "query_id", "sign", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in names]).where("sign <> 0").join(before, "slice")
    found = run.groupBy("query_id").agg(*[F.sum(F.col("sign") * (F.col(c) + F.col(f"b_{c}"))).alias(c) for c in names]).where("n > 0")
    return found.select("query_id", F.col("n").cast("bigint").alias("n"), *[F.when(F.col(f"k{i}") > 0, F.col(f"s{i}")).cast("bigint").alias(c) for i, c in enumerate(sums)])


def doc_filter(hits: DataFrame, key: str, prefix: str) -> DataFrame:
    """Only one document and its sections: the key itself, and keys that go on after it with a full stop."""
    return hits.filter((F.col(key) == prefix) | F.col(key).startswith(prefix + "."))


def chosen_values(selections: DataFrame, sel: str = "selections") -> DataFrame:
    """(query_id, field, value) of JSON lists of URL-encoded ``field:value``; elements without a colon are skipped."""
    return (
        selections.select("query_id", F.explode(F.from_json(sel, "array<string>")).alias("_e"))
        .filter(F.instr("_e", ":") > 0)
        .select(
            "query_id",
            F.substring_index("_e", ":", 1).alias("field"),
            F.try_url_decode(F.expr("substring(_e, instr(_e, ':') + 1)")).alias("value"),
        )
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def drill_down(index: DataFrame, selections: DataFrame, key: str, fields: list[str], sel: str = "selections") -> DataFrame:
    """Documents per query that fit its chosen facet values: OR within a field, AND across fields.

    ``selections`` is ``(query_id, selections)`` with a JSON list of URL-encoded ``field:value``.
    Elements without a colon are skipped. Joined field by field, so a list may be long. Gives (query_id, key): fields are
    joined to that where they are wanted.
    """
    parts = cut(chosen_values(selections, sel))  # stored: few choices are brought to the values, many are joined by key
    need = cut(parts.groupBy("query_id").agg(F.count_distinct("field").alias("_need")))
    values = index.select(
        key,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), _as_array(index, f).alias("values"))
                    for f in fields
                ]
            )
        ).alias("_f"),
    ).select(key, F.col("_f.field").alias("field"), F.explode(F.array_distinct("_f.values")).alias("value"))
    matched = values.join(parts, ["field", "value"])
    return (
        matched.groupBy("query_id", key)
        .agg(F.count_distinct("field").alias("_got"))
        .join(need, "query_id")
        .filter(F.col("_got") == F.col("_need"))
        .drop("_got", "_need")
    )


def _as_array(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if df.schema[name].dataType.typeName() == "array":
        return c.cast("array<string>")
    return F.array(c.cast("string"))


def selection_filter(selections: dict[str, list], index: DataFrame) -> Column:
    """One user's drill-down as a plain predicate, pushed to the scan."""
    keep = F.lit(True)
    for field, values in selections.items():
        if index.schema[field].dataType.typeName() == "array":
            keep = keep & F.arrays_overlap(F.col(field), F.array(*[F.lit(v) for v in values]))
        else:
            keep = keep & F.col(field).isin(values)
    return keep


def with_filters(index: DataFrame, predicates: list[Column]) -> DataFrame:
    for predicate in predicates:
        index = index.filter(predicate)
    return index


def fetch_fields(hits: DataFrame, index: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Stored fields of the hits; call it after top-k so that only their rows are looked up.

    The hits are stored first: Spark then sees how few they are, and moves them rather than the index.
    """
    hits = cut(hits)
    wanted = [f for f in fields if f not in (key, "score")]
    return hits.join(index.select(key, *wanted), key).select(
        "query_id", *[f for f in (key, "score") if f in hits.columns], *wanted
    )


def get_by_ids(index: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return index.join(ids.select(key).distinct(), key, "left_semi")


def augment(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Constant or computed columns added to the output."""
    return df.withColumns(columns)


def join_docs(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Documents whose ``left_on`` occurs as ``right_on`` in the other set."""
    return left.join(
        right.select(F.col(right_on).alias(left_on)).filter(F.col(left_on).isNotNull()).distinct(), left_on, "left_semi"
    )


def sections_of(hits: DataFrame, docs: DataFrame, section_key: str, key: str) -> DataFrame:
    """Section hits with the fields of the document they belong to (key ``doc.section``)."""
    own = hits.withColumn(key, F.substring_index(section_key, ".", 1))
    return spread_join(own, docs, [key], "inner", by=F.xxhash64(section_key))


def label_facets(counts: DataFrame, labels: DataFrame, lang: str, fallback: str = "en") -> DataFrame:
    """Display label of each facet value in ``lang``, else in ``fallback``, else the value itself."""
    def of(language: str, name: str) -> DataFrame:
        return labels.filter(F.col("lang") == language).select("field", "value", F.col("label").alias(name))

    return (
        counts.join(of(lang, "_own"), ["field", "value"], "left")
        .join(of(fallback, "_other"), ["field", "value"], "left")
        .withColumn("label", F.coalesce("_own", "_other", F.col("value")))
        .drop("_own", "_other")
    )


def auto_phrases(words: DataFrame, word: str) -> DataFrame:
    """Phrases of the parts of those query words that split: (query_id = the word, offset, term)."""
    return (
        words.select(F.col(word).alias("query_id"), word_parts(F.col(word)).alias("_parts"))
        .select("query_id", F.size("_parts").alias("_n"), F.posexplode_outer("_parts").alias("offset", "term"))
        .filter(F.col("_n") > 1)
        .drop("_n")
        .withColumn("term", F.lower("term"))
    )


def wildcard_match(post: DataFrame, stats: DataFrame, patterns: DataFrame, key: str, vocabulary=None) -> DataFrame:
    """Documents per pattern; each scores 1, whatever the number of terms the pattern stands for."""
    found = expand_wildcards(stats, patterns, vocabulary).select("query_id", "term")
    return spread_join(post.select("term", key), found, ["term"], frequency=stats.select("term", F.col("df").alias("n"))).groupBy("query_id", key).agg(
        F.count(F.lit(1)).alias("n_terms"), F.lit(1.0).alias("score")
    )

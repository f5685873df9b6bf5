"""Searches that read a stored text index: alternatives at one place, boolean and phrase search, the best k.

Queries are clauses (query_id, place, term). Terms of one place are alternatives, as synonyms are: a place is met by any of them, and
a query that wants all its places is met when each is. Places are the positions of the analysed query, so gaps that stop words leave
stay gaps in a phrase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer, token_rows
from lexshelf.operators.rank import explain_scores, score, top_k
from lexshelf.operators.textindex import TextIndex
from lexshelf.session import cut, spread_join

#: Scores are compared after rounding to so many digits.
DIGITS = 6


def place_clauses(df: DataFrame, text: str, analyzer: Analyzer) -> DataFrame:
    """(other columns, place, term) of a table of queries; alternatives share their place."""
    return token_rows(df, text, analyzer).withColumnRenamed("pos", "place").distinct()


def _wanted(index: TextIndex, clauses: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the clauses' terms with the clauses beside them; a frequent term is split by its document frequency."""
    post = index.entries.select("term", *columns) if "positions" in columns else index.postings.select("term", *columns)
    return spread_join(post, clauses, ["term"], frequency=index.frequency)


def matching_places(index: TextIndex, clauses: DataFrame, op: str = "AND") -> DataFrame:
    """(query_id, key, n_places): documents in which all places of a query are met (AND), or any (OR).

    Places with the same alternatives are one. Rows are counted per query and document before the number of places is looked up.
    """
    sets = clauses.groupBy("query_id", "place").agg(F.array_join(F.sort_array(F.collect_set("term")), "\u0001").alias("_set"))
    rows = clauses.join(sets, ["query_id", "place"]).select("query_id", "_set", "term").distinct()
    rows = cut(rows)
    met = _wanted(index, rows, [index.key]).groupBy("query_id", index.key, "_set").agg(F.count(F.lit(1)).alias("_n"))
    found = met.groupBy("query_id", index.key).agg(F.count(F.lit(1)).alias("n_places"))
    if op.upper() == "OR":
        return found
    need = cut(rows.groupBy("query_id").agg(F.count_distinct("_set").alias("_need")))
    return found.join(need, "query_id").where(F.col("n_places") == F.col("_need")).drop("_need")


def phrase_places(index: TextIndex, clauses: DataFrame) -> DataFrame:
    """(query_id, key, start): where all places of a phrase stand at their distances, each met by any of its terms.

    The place that fewest documents can meet, by the stored statistics, leads: its position blocks give the documents and the
    possible starts. The other places are looked up in those documents only, a whole block of positions at a time, and starts
    are intersected within the row. A start belongs to the block its position lies in; a term may stand in that block or the next ones.
    """
    key, block = index.key, index.block
    first = clauses.groupBy("query_id").agg(F.min("place").alias("_first"))
    rated = (
        clauses.join(first, "query_id")
        .join(index.stats.select("term", "df"), "term", "left")
        .select("query_id", (F.col("place") - F.col("_first")).cast("bigint").alias("offset"), "term", F.coalesce("df", F.lit(0)).alias("df"))
    )
    rated = cut(rated)
    places = rated.groupBy("query_id", "offset").agg(F.sum("df").alias("df"))
    leads = places.groupBy("query_id").agg(F.min(F.struct("df", "offset")).alias("_lead"), F.count(F.lit(1)).alias("_places"))
    leads = cut(leads.where("_lead.df > 0").select("query_id", "_places", F.col("_lead.offset").alias("offset")))
    wanted = cut(rated.where("df > 0").join(leads.select("query_id", "_places", F.col("offset").alias("_lead")), "query_id"))

    def starts(rows: DataFrame) -> DataFrame:
        """A row per block of starts; starts before the text are left out."""
        begun = rows.withColumn("_starts", F.filter(F.transform("positions", lambda p: p - F.col("offset")), lambda s: s >= 0))
        begun = begun.where(F.size("_starts") > 0)
        low, high = F.floor(F.get("_starts", F.lit(0)) / block), F.floor(F.element_at("_starts", -1) / block)
        parts = F.transform(
            F.sequence(low, high), lambda b: F.struct(b.alias("at"), F.filter("_starts", lambda s: F.floor(s / block) == b).alias("starts"))
        )
        one = F.array(F.struct(low.alias("at"), F.col("_starts").alias("starts")))
        return begun.select(*[c for c in rows.columns if c != "positions"], F.inline(F.when(low == high, one).otherwise(parts)))

    lead = _wanted(index, wanted.where(F.col("offset") == F.col("_lead")), [key, "block", "positions"])
    lead = cut(starts(lead.select("query_id", key, "offset", "positions", "_places")).where(F.size("starts") > 0))
    there = lead.select("query_id", key, "at").distinct()
    others = spread_join(there, wanted.where(F.col("offset") != F.col("_lead")).select("query_id", "offset", "term"), ["query_id"])
    nearby = F.sequence(F.floor((F.col("at") * block + F.col("offset")) / block), F.floor((F.col("at") * block + block - 1 + F.col("offset")) / block))
    expected = cut(others.select("query_id", key, "at", "offset", "term", F.explode(nearby.cast("array<int>")).alias("block")))
    found = index.entries.select("term", key, "block", "positions").join(expected, ["term", key, "block"])
    begun = F.filter(F.transform("positions", lambda p: p - F.col("offset")), lambda s: F.floor(s / block) == F.col("at"))
    rest = found.select("query_id", key, "at", "offset", begun.alias("starts"))
    rows = lead.select("query_id", key, "at", "offset", "starts").unionByName(rest)
    # one array per place (of all its terms and blocks), then one per query, document and block: as many as the phrase has places
    each = rows.groupBy("query_id", key, "at", "offset").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))
    whole = each.groupBy("query_id", key, "at").agg(F.collect_list("starts").alias("all"))
    whole = whole.join(leads.select("query_id", "_places"), "query_id").where(F.size("all") == F.col("_places"))
    common = F.aggregate(F.slice("all", F.lit(2), F.size("all")), F.get("all", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    return whole.select("query_id", key, F.explode(common.cast("array<bigint>")).alias("start"))


def tfidf_weight(n_docs: Column) -> Column:
    return F.pow(F.lit(1.0) + F.log(n_docs / (F.col("df") + 1)), F.lit(2.0))


def best_documents(index: TextIndex, clauses: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, key, score, n_terms, rank): the k best documents of every query by tf-idf, as ``rank.score`` and ``rank.top_k`` give.

    Postings of the asked terms are dealt out by document, once. Each task then has the whole scores of its documents and keeps its k
    best of every query, so only those travel to the last choice.
    """
    rated = clauses.select("query_id", "term").distinct().join(index.stats.select("term", "df"), "term")
    rated = rated.select("query_id", "term", tfidf_weight(index.count()).alias("weight"))
    parts = explain_scores(index.postings, rated, key=index.key, parts=index.parts())
    return top_k(score(parts, index.key).withColumn("score", F.round("score", DIGITS)), k, index.key)

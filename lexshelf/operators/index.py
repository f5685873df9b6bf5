"""A stored index: postings by field and term, their statistics, and fielded searches that read only these."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer, token_rows
from lexshelf.operators.postings import postings, term_stats
from lexshelf.operators.rank import explain_scores, score
from lexshelf.session import cut


@dataclass(frozen=True)
class StoredIndex:
    """``postings`` (field, key, len, term, tf), ``stats`` (field, term, df, ttf), ``sizes`` (docs, len); all are files.

    Postings lie sorted by field and term over range partitions, so a reader of few terms skips most row groups, and a term
    in every document is split over several files.
    """

    key: str
    postings: DataFrame
    stats: DataFrame
    sizes: DataFrame


def build_index(values: DataFrame, key: str, analyzer: Analyzer, path: str) -> StoredIndex:
    """Write the index of (key, field, value) rows, several to a key and field, under ``path``."""
    spark = values.sparkSession
    tokens = token_rows(values.select("field", key, "value"), "value", analyzer).drop("pos")
    made = postings(tokens, key)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made.repartitionByRange(parts, "field", "term", key).sortWithinPartitions("field", "term", key).write.parquet(f"{path}/postings")
    stored = spark.read.schema(made.schema).parquet(f"{path}/postings")
    term_stats(stored).write.parquet(f"{path}/stats")
    # documents without a token count as well
    counted = values.select(key).distinct().agg(F.count(F.lit(1)).alias("docs"))
    length = stored.agg(F.coalesce(F.sum("tf"), F.lit(0))).scalar()
    counted.select("docs", length.alias("len")).write.parquet(f"{path}/sizes")
    return open_index(spark, key, path)


def open_index(spark, key: str, path: str) -> StoredIndex:
    return StoredIndex(key, *(spark.read.parquet(f"{path}/{name}") for name in ("postings", "stats", "sizes")))


def search(index: StoredIndex, clauses: DataFrame) -> DataFrame:
    """Hits (query_id, key, score, n_terms) of fielded clauses (query_id, field, term), by the stored statistics.

    The weighted clauses are stored: they are narrow and few, so Spark sees that and reads the postings for their terms.
    """
    docs = index.sizes.select("docs").scalar()
    weight = F.pow(F.lit(1.0) + F.log(docs / (F.col("df") + 1)), F.lit(2.0))
    rated = clauses.distinct().join(index.stats, ["field", "term"]).select("query_id", "field", "term", weight.alias("weight"))
    frequency = index.stats.select("field", "term", F.col("df").alias("n"))
    return score(explain_scores(index.postings, cut(rated), frequency=frequency), index.key)


def matching(hits: DataFrame, clauses: DataFrame) -> DataFrame:
    """Only hits that hold all clauses of their query."""
    need = clauses.distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("_need"))
    return hits.join(cut(need), "query_id").filter(F.col("n_terms") == F.col("_need")).drop("_need")

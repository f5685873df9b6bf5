"""What the terms of an index are looked up by, made once and stored: letters left by deletions, segments, runs of three letters.

``left``     (head, left, term, df): short terms under every string that deletions leave of them
``segments`` (head, n, j, seg, term, df): longer terms under their segments
``grams``    (gram, term, df, ttf): terms under each run of three letters in them; ``often`` (gram, n) counts their terms

The tables lie sorted by what is looked up, so few words or patterns read a small part of them. Each is written by the first search that asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.operators import spelling

GRAM = 3


@dataclass(frozen=True)
class Vocabulary:
    edits: int
    prefix: int
    path: str
    stats: DataFrame

    def _sorted(self, name: str, make, *order: str) -> DataFrame:
        """The table ``name``; what ``make`` gives is written in its order if it is not there."""
        spark, path = self.stats.sparkSession, f"{self.path}/{name}"
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # not written yet
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            # the stored statistics are few files, and every term makes many rows
            made = make(self.stats.repartition(parts, "term"))
            made.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
        return spark.read.schema(made.schema).parquet(path)

    @property
    def left(self) -> DataFrame:
        return self._sorted("left", lambda stats: spelling.short_terms(spelling.held_terms(stats, self.prefix), self.edits), "_head", "_left")

    @property
    def segments(self) -> DataFrame:
        return self._sorted("segments", lambda stats: spelling.long_terms(spelling.held_terms(stats, self.prefix), self.edits), "_head", "_n", "_j", "_seg")

    @property
    def grams(self) -> DataFrame:
        places = F.sequence(F.lit(1), F.length("term") - GRAM + 1)
        runs = F.array_distinct(F.transform(places, lambda i: F.substr(F.col("term"), i, F.lit(GRAM))))
        return self._sorted("grams", lambda stats: stats.where(F.length("term") >= GRAM).select(F.explode(runs).alias("gram"), "term", "df", "ttf"), "gram", "term")

    @property
    def often(self) -> DataFrame:
        return self._sorted("often", lambda _: self.grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram")


def build_vocabulary(stats: DataFrame, path: str, edits: int = 2, prefix: int = 1) -> Vocabulary:
    """The tables of (term, df, ttf) under ``path``; those that are there already are read."""
    return Vocabulary(edits, prefix, path, stats)

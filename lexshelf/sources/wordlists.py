"""Word lists from files, as tables: stop words, protected words, stems, synonyms, contractions, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One word or several on a line; ``#`` starts a comment, ``|`` a gloss: (word)."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\s*#.*$|\|.*$", "").alias("line"))
    return lines.select(F.explode(F.split(F.trim("line"), r"\s+")).alias("word")).filter("word != ''")


def read_stems(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``word stem`` lines: (word, stem)."""
    parts = F.split("value", "\t")
    return spark.read.text(path).filter(F.col("value").contains("\t") & ~F.col("value").startswith("#")).select(
        F.get(parts, 0).alias("word"), F.get(parts, 1).alias("stem")
    )


def read_synonyms(spark: SparkSession, path: str, expand: bool = True) -> DataFrame:
    """``a => b, c`` rewrites and ``x, y`` groups: (source, target), single words, lower-cased."""
    lines = spark.read.text(path).select(F.lower(F.trim("value")).alias("line")).filter(
        (F.col("line") != "") & ~F.col("line").startswith("#")
    )
    sides = F.split("line", "=>")
    words = lambda c: F.transform(F.split(c, ","), lambda w: F.trim(w))
    left = words(F.get(sides, 0))
    right = F.when(F.size(sides) > 1, words(F.get(sides, 1))).when(F.lit(expand), left).otherwise(F.slice(left, 1, 1))
    return lines.select(F.explode(left).alias("source"), right.alias("_r")).select(
        "source", F.explode("_r").alias("target")
    ).distinct()

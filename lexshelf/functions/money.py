"""Currency conversion by a rate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.functions import words as W
from lexshelf.session import literal_table


def default_rates(spark: SparkSession) -> DataFrame:
    return literal_table(spark, W.RATES, "from string, to string, rate double")


def all_rates(rates: DataFrame, base: str = "USD") -> DataFrame:
    """Every pair of currencies: itself, as listed, the inverse of a listed rate, or by way of ``base``."""
    listed = rates.select("from", "to", "rate", F.lit(1).alias("_way"))
    inverse = rates.select(
        F.col("to").alias("from"), F.col("from").alias("to"), (1 / F.col("rate")).alias("rate"), F.lit(2).alias("_way")
    )
    either = listed.union(inverse)
    into = either.filter(F.col("to") == base).select("from", F.col("rate").alias("_in"), "to")
    outof = either.filter(F.col("from") == base).select(F.col("from").alias("to"), F.col("to").alias("_to"), F.col("rate").alias("_out"))
    via = into.join(outof, "to").select(
        "from", F.col("_to").alias("to"), (F.col("_in") * F.col("_out")).alias("rate"), F.lit(3).alias("_way")
    )
    codes = either.select(F.col("from").alias("code")).union(either.select("to")).distinct()
    own = codes.select(F.col("code").alias("from"), F.col("code").alias("to"), F.lit(1.0).alias("rate"), F.lit(0).alias("_way"))
    return own.union(listed).union(inverse).union(via).groupBy("from", "to").agg(
        F.min_by("rate", "_way").alias("rate")
    )


def convert(df: DataFrame, amount: str, code: str, rates: DataFrame, to: str = "USD", name: str = "converted",
            default: str = "USD") -> DataFrame:
    """``amount`` in ``code`` (default currency if missing) expressed in ``to``; null without a rate."""
    table = all_rates(rates).filter(F.col("to") == to).select(F.col("from").alias("_code"), F.col("rate").alias("_rate"))
    return (
        df.withColumn("_code", F.coalesce(F.col(code), F.lit(default)))
        .join(table, "_code", "left")
        .withColumn(name, F.col(amount) * F.col("_rate"))
        .drop("_code", "_rate")
    )

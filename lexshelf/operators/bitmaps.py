"""Sets of documents as bitmaps: facet values, selections and hits, counted by intersection.

Documents are known by a number from 0 (``seq`` of a stored index). A bitmap covers SPAN numbers, so a set of documents is a row per
bucket in which it has any; rows of 4 KB are what is shuffled, however many documents they stand for. A value of few
documents costs one row per bucket too: bitmaps are for fields whose values are common.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.session import cut

#: Fixed value: bits of a bitmap as Spark's functions make them.
SPAN = 32768


def _as_values(df: DataFrame, name: str):
    c = F.col(name)
    return F.array_distinct(c.cast("array<string>")) if df.schema[name].dataType.typeName() == "array" else F.array(c.cast("string"))


def to_bitmaps(rows: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """(by, bucket, bits) of rows that name a document each; a document named twice counts once."""
    number = F.col(seq) + 1  # Spark's buckets begin at 1
    placed = rows.select(*by, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_bit"))
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def facet_bitmaps(docs: DataFrame, fields: list[str], seq: str = "seq") -> DataFrame:
    """(field, value, bucket, bits) of all values of several fields; a table to be stored. Documents without a value are in none."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), _as_values(docs, f).alias("values")) for f in fields])
    rows = docs.select(seq, F.explode(pairs).alias("_p")).select(seq, "_p.field", F.explode("_p.values").alias("value"))
    return to_bitmaps(rows.where("value IS NOT NULL"), ["field", "value"], seq)


def selected(facets: DataFrame, selections: DataFrame) -> DataFrame:
    """(query_id, bucket, bits): documents that have one of the chosen values in every chosen field.

    ``selections`` is (query_id, field, value). Values of a field are united, then fields intersected, bucket by bucket.
    """
    chosen = selections.where("value IS NOT NULL").distinct()
    need = cut(chosen.groupBy("query_id").agg(F.count_distinct("field").alias("_need")))
    united = facets.join(cut(chosen), ["field", "value"]).groupBy("query_id", "field", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    met = united.groupBy("query_id", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("_fields"))
    met = met.join(need, "query_id").where(F.col("_fields") == F.col("_need"))
    return met.where(F.bitmap_count("bits") > 0).select("query_id", "bucket", "bits")


def counted(facets: DataFrame, hits: DataFrame, by: str = "query_id", mincount: int = 1) -> DataFrame:
    """(by, field, value, count): documents of each set that have each value."""
    both = hits.select(by, "bucket", F.col("bits").alias("_hits")).join(facets, "bucket")
    pairs = both.select(by, "field", "value", "bucket", F.explode(F.array("_hits", "bits")).alias("bits"))
    common = pairs.groupBy(by, "field", "value", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("_n"))
    return common.groupBy(by, "field", "value").agg(F.sum("_n").alias("count")).where(F.col("count") >= mincount)


def documents_of(sets: DataFrame, by: str = "query_id") -> DataFrame:
    """(by, seq): the documents of bitmaps, one row each."""
    digits = F.hex("bits")
    number = lambda i: F.conv(F.substr(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
    filled = F.filter(
        F.transform(F.sequence(F.lit(0), F.octet_length("bits") - 1), lambda i: F.struct(i.alias("at"), number(i).alias("byte"))),
        lambda x: x["byte"] > 0,
    )
    rows = sets.select(by, "bucket", F.inline(filled))
    rows = rows.select(by, "bucket", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    rows = rows.where(F.expr("(shiftright(byte, bit) & 1) = 1"))
    return rows.select(by, ((F.col("bucket") - 1) * SPAN + F.col("at") * 8 + F.col("bit")).cast("bigint").alias("seq"))

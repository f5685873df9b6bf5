"""Incremental load in micro-batches.

Each micro-batch writes its changes under ``changes/batch=N``, replacing that folder, so a batch
that runs twice counts once and the target is never rewritten per batch. ``current_index`` gives the table
with all changes applied; ``compact`` folds them in and from then on only later batches are read. Folders of folded batches
may be deleted at any time after.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lexshelf.operators.build import apply_changes
from lexshelf.sources.store import current, publish


def stream_index(changes: DataFrame, root: str, seconds: int | None = None) -> StreamingQuery:
    """Start loading a stream of changes (the index columns, ``op`` and ``seq``).

    ``seconds`` is the commit interval; without it everything available is loaded and the query ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={number}")

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/stream")
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start()


def file_changes(spark: SparkSession, path: str, schema: str, max_files: int = 20) -> DataFrame:
    """New files under ``path`` as a stream, at most ``max_files`` to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def current_index(spark: SparkSession, root: str, base: DataFrame, key: str, doc: str, by_batch: bool = True) -> DataFrame:
    """``base`` with all loaded changes applied, the latest winning.

    Later batches win over earlier ones; with ``by_batch`` false ``seq`` alone decides, for feeds whose
    files may arrive out of order. After ``compact``, its version is the base, and older batches are not read.
    """
    folded = _folded(spark, root)
    changes = spark.read.parquet(f"{root}/changes").filter(F.col("batch").cast("bigint") > folded)
    if folded >= 0:
        base = current(spark, f"{root}/index")
    if by_batch:
        order = F.struct(F.col("batch").cast("bigint").alias("batch"), F.col("seq").alias("seq"))
        changes = changes.withColumn("seq", order)
    return apply_changes(base, changes.drop("batch"), key, doc)


def compact(spark: SparkSession, root: str, base: DataFrame, key: str, doc: str) -> DataFrame:
    """Publish the table with its changes as a new version, and mark their batches as folded in."""
    last = spark.read.parquet(f"{root}/changes").agg(F.max(F.col("batch").cast("bigint"))).first()[0]
    publish(current_index(spark, root, base, key, doc), f"{root}/index")
    spark.range(1).select(F.lit(last).cast("bigint").alias("batch")).write.mode("append").parquet(f"{root}/folded")
    return current(spark, f"{root}/index")


def _folded(spark: SparkSession, root: str) -> int:
    """The last batch that is part of the published version, -1 before the first."""
    try:
        return spark.read.schema("batch bigint").parquet(f"{root}/folded").agg(F.max("batch")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1

"""Versions of a table kept by key ranges: a change reads and writes only the ranges that its keys lie in.

Under ``root``: ``data/g=<version>/part=<n>`` has the files that a version wrote, ``manifest/v=<version>`` names the folder of every range
as that version sees it, ``pointer`` has a row per complete version. Files are never changed, so readers of an earlier
version are not disturbed; a version counts once its pointer row is there. One writer changes a root at a time.

The number of ranges is a parameter of the writer, and the manifest, with one row a range, is all that passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.session import cut


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` (None: from the first) up to the next range's; ``generation`` is the version that wrote it, 0: no rows."""

    part: int
    low: object
    generation: int
    rows: int


def latest(spark: SparkSession, root: str) -> int:
    """The version published last, 0 before the first."""
    try:
        return spark.read.schema("version int").parquet(f"{root}/pointer").agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def manifest(spark: SparkSession, root: str, version: int) -> list[Range]:
    rows = spark.read.parquet(f"{root}/manifest/v={version}").collect()
    return sorted((Range(r.part, r.low, r.generation, r.rows) for r in rows), key=lambda r: (r.low is not None, r.low))


def _part_of(key: Column, ranges: list[Range]) -> Column:
    """The range a key lies in, as a tree of comparisons; null keys lie in the first."""
    if len(ranges) == 1:
        return F.lit(ranges[0].part)
    half = len(ranges) // 2
    return F.when(key >= F.lit(ranges[half].low), _part_of(key, ranges[half:])).otherwise(_part_of(key, ranges[:half]))


def _paths(root: str, ranges: list[Range]) -> list[str]:
    return [f"{root}/data/g={r.generation}/part={r.part}" for r in ranges if r.generation]


def _commit(spark: SparkSession, root: str, version: int, ranges: list[Range], kind: str) -> int:
    rows = [(r.part, r.low, r.generation, r.rows) for r in ranges]
    spark.createDataFrame(rows, f"part int, low {kind}, generation int, rows long").coalesce(1).write.parquet(f"{root}/manifest/v={version}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/pointer")
    return version


def publish_ranges(df: DataFrame, root: str, key: str, ranges: int) -> int:
    """Make ``df`` the current version, cut into ``ranges`` ranges of ``key`` of about equal size."""
    spark, version = df.sparkSession, latest(df.sparkSession, root) + 1
    dealt = cut(df.repartitionByRange(ranges, F.col(key).asc_nulls_first()).withColumn("part", F.spark_partition_id()))
    found = dealt.groupBy("part").agg(F.min(key).alias("low"), F.count(F.lit(1)).alias("rows")).orderBy(F.col("low").asc_nulls_first()).collect()
    kept = [Range(r.part, r.low if i else None, version, r.rows) for i, r in enumerate(found)] or [Range(0, None, 0, 0)]
    dealt.repartition("part").write.partitionBy("part").parquet(f"{root}/data/g={version}")
    return _commit(spark, root, version, kept, df.schema[key].dataType.simpleString())


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the one published last."""
    version = version or latest(spark, root)
    if not version:
        raise FileNotFoundError(f"nothing published at {root}")
    found = _paths(root, manifest(spark, root, version))
    if found:
        return spark.read.parquet(*found)
    first = next(p for v in range(version - 1, 0, -1) if (p := _paths(root, manifest(spark, root, v))))
    return spark.read.parquet(first[0]).where("false")


def changed_ranges(spark: SparkSession, root: str, version: int) -> tuple[int, int]:
    """(written, all): how many ranges a version wrote anew, of how many it has."""
    ranges = manifest(spark, root, version)
    return sum(r.generation == version for r in ranges), len(ranges)


def change_ranges(root: str, key: str, adds: DataFrame, deletes: DataFrame | None = None, most: int | None = None) -> int:
    """A new version: rows of every key in ``adds`` or ``deletes`` go, then all rows of ``adds`` are there.

    Only the ranges in which those keys lie are read and written. A range that would have more than ``most`` rows (by default twice the mean of
    the version before) is cut into several. A null key is a key like others.
    """
    spark, have = adds.sparkSession, latest(adds.sparkSession, root)
    if not have:
        raise FileNotFoundError(f"nothing published at {root}")
    old, kind = manifest(spark, root, have), adds.schema[key].dataType.simpleString()
    version = have + 1
    place = _part_of(F.col(key), old)
    keys = adds.select(key) if deletes is None else adds.select(key).union(deletes.select(key))
    keys = cut(keys.distinct())
    touched = {r.part for r in keys.select(place.alias("part")).distinct().collect()}
    rows = adds
    if before := _paths(root, [r for r in old if r.part in touched]):
        gone = keys.withColumnRenamed(key, "_key")
        kept = spark.read.parquet(*before)
        kept = kept.join(gone, kept[key].eqNullSafe(gone["_key"]), "left_anti")
        rows = kept.unionByName(adds)
    rows = cut(rows.withColumn("part", place))
    sizes = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}
    most = most or max(1, 2 * sum(r.rows for r in old) // max(1, len(old)))
    ranges, free = [], max(r.part for r in old) + 1
    for r in old:
        if r.part not in touched:
            ranges.append(r)
            continue
        pieces = -(-sizes.get(r.part, 0) // most)
        ranges.append(Range(r.part, r.low, version, 0))
        if pieces > 1:
            steps = [i / pieces for i in range(1, pieces)]
            lows = _lows(rows.where(F.col("part") == r.part), key, steps)
            ranges += [Range(free + i, low, version, 0) for i, low in enumerate(lows)]
            free += len(lows)
    rows = rows.withColumn("part", _part_of(F.col(key), ranges))
    sizes = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}
    if sizes:
        rows.repartition("part").write.partitionBy("part").parquet(f"{root}/data/g={version}")
    ranges = [r if r.generation < version else Range(r.part, r.low, version if sizes.get(r.part) else 0, sizes.get(r.part, 0)) for r in ranges]
    return _commit(spark, root, version, ranges, kind)


def _lows(rows: DataFrame, key: str, steps: list[float]) -> list:
    """Keys at the given shares of the rows, each once and above the least key."""
    pieces = len(steps) + 1
    dealt = rows.select(key).repartitionByRange(pieces, F.col(key).asc_nulls_first()).withColumn("_p", F.spark_partition_id())
    found = [r.low for r in dealt.groupBy("_p").agg(F.min(key).alias("low")).orderBy(F.col("low").asc_nulls_first()).collect()]
    return [low for low in found[1:] if low is not None]

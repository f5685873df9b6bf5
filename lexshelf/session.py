"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
SCAN_KEY = "lexshelf.scan.partitions"


def local_session(cores: int | str = 8, app: str = "lexshelf", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config(SCAN_KEY, str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` or the context names it.

    Only a local session, whose one process has all executors, may go without: it gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexshelf-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from that.

    For results read more than once, or whose partitioning must be the very same each time, also
    after an executor was lost.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lexshelf-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(frequency: DataFrame, on: list[str], share: int = 16) -> DataFrame:
    """(on, ways) of the keys that have more than one part in ``share`` * partitions of all rows, and how many ways each is split.

    ``frequency`` has the rows ``n`` of every key. At most ``share`` * partitions keys can be that frequent, whatever the data, and their
    ways add up to twice that at most: the table is small enough to broadcast, and so is what it multiplies.
    """
    parts = int(frequency.sparkSession.conf.get("spark.sql.shuffle.partitions")) * share
    total = frequency.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    ways = F.ceil(F.col("n") * parts / total).cast("int")
    return frequency.where(F.col("n") * parts > total).select(*on, ways.alias("_ways"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    by: Column | None = None,
    frequency: DataFrame | None = None,
    ways: int | None = None,
) -> DataFrame:
    """Equi-join whose hot left keys are split by how frequent they are; ``right`` is repeated for those keys alone.

    For a ``right`` side with few narrow rows per key and a ``left`` side in which one key may hold a large part of all rows.
    ``frequency`` (on, n) says how many rows the left keys have, such as stored document frequencies; without it they are counted, so
    ``left`` is read twice and should be a stored table. A key with less than a sixteenth of a partition's mean load is not split, one with a third of all rows is dealt over
    more parts than there are partitions. The repeated ``right`` is stored, so that Spark sees how small it is and brings it to the rows of ``left``,
    which then stay where they are. ``by`` says how left rows of one key are dealt out. ``ways`` splits every
    key so many times and counts nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the left side must be the kept side")
    columns = [F.col(c) for c in left.columns if c not in on]
    dealt = by if by is not None else F.xxhash64(*(columns or [F.col(c) for c in on]))
    if ways is not None:
        salted = left.withColumn("_salt", F.pmod(dealt, F.lit(ways)).cast("int"))
        copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
        return salted.join(copies, [*on, "_salt"], how).drop("_salt")
    if frequency is None:
        frequency = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(cut(hot_keys(frequency, on)))
    salt = F.coalesce(F.pmod(dealt, F.col("_ways")), F.lit(0)).cast("int")
    salted = left.join(hot, on, "left").withColumn("_salt", salt).select(*left.columns, "_salt")
    copies = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)))
    copies = cut(copies.select(*right.columns, "_salt"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_by(left: DataFrame, right: DataFrame, on: list[str], key: str, parts: int | None = None) -> DataFrame:
    """Equi-join on ``on`` whose rows are counted or summed by ``key`` of ``left`` next, such as matches by document.

    The rows of ``left`` that ``right`` asks for are dealt out by ``key``, once, before they are multiplied; ``right`` is stored, so that Spark sees
    how small it is and brings it to them. What follows by ``key`` then needs no shuffle, and no value of ``on`` meets in one task. A
    ``right`` too large for that is met by sort and merge.
    """
    right = cut(right)
    wanted = left.join(cut(right.select(*on).distinct()), on, "left_semi")
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(parts, key).join(right, on).select(*on, *[c for c in [*left.columns, *right.columns] if c not in on])


def deal(df: DataFrame, key: str) -> DataFrame:
    """Deal a scan out by ``key`` over the session's shuffle partitions, or as many as it names in ``lexshelf.scan.partitions``.

    A file splits no finer than its row groups, so without this a few tasks would analyse all texts, however many cores there are.
    """
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get(SCAN_KEY, None) or conf.get("spark.sql.shuffle.partitions")), key)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short fixed table written into the plan, so that Spark sees how small it is."""
    fields = [column.split() for column in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))

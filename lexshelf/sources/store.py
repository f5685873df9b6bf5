"""Document store and published index versions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.functions.text import html_escape
from lexshelf.operators.build import section_key


#: Fixed value: the element of a stored section, and its attribute.
SECTION, NUMBER = "Sec", "gs2:id"


def doc_store(sections: DataFrame) -> DataFrame:
    """Section records of full text, markup kept but escaped: (doc_oid, docOID, sec_no, xml)."""
    return sections.select(
        "doc_oid",
        section_key().alias("docOID"),
        "sec_no",
        F.concat(
            F.lit(f'<{SECTION} {NUMBER}="'), F.col("sec_no").cast("string"), F.lit('">'), html_escape(F.col("text")), F.lit(f"</{SECTION}>")
        ).alias("xml"),
    )


def write_doc_store(sections: DataFrame, path: str, by: list[str] = ()) -> None:
    doc_store(sections).write.mode("overwrite").partitionBy(*by).parquet(path)


def publish(df: DataFrame, root: str, mode: str = "rebuild", partition_by: list[str] = ()) -> int:
    """Make ``df`` the current version (rebuild), or that version and ``df`` together (append), as a new version.

    A version is complete before the one row that names it is written, and none is changed once written, so readers never
    see a half-built index. One writer publishes to a root at a time.
    """
    spark = df.sparkSession
    if mode not in ("rebuild", "append"):
        raise ValueError(mode)
    have = _latest(spark, root)
    if mode == "append" and have:
        df = current(spark, root).unionByName(df)
    df.write.partitionBy(*partition_by).parquet(f"{root}/v={have + 1}")
    spark.range(1).select(F.lit(have + 1).alias("version")).write.mode("append").parquet(f"{root}/pointer")
    return have + 1


def _latest(spark: SparkSession, root: str) -> int:
    """Number of the version published last, 0 before the first."""
    try:
        rows = spark.read.schema("version int").parquet(f"{root}/pointer")
        return rows.agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def current(spark: SparkSession, root: str) -> DataFrame:
    version = _latest(spark, root)
    if not version:
        raise FileNotFoundError(f"nothing published at {root}")
    return spark.read.parquet(f"{root}/v={version}")

"""Reading records and web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexshelf.functions.text import HTML_BLOCKS, html_strip


def read_records(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None, **options: str) -> DataFrame:
    """JSON, CSV (with a header) or XML records (``rowTag``, default ``doc``)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options = {"header": "true", "multiLine": "true", "escape": '"', **options}
    elif fmt == "xml":
        options = {"rowTag": "doc", **options}
    elif fmt != "json":
        raise ValueError(fmt)
    return reader.options(**options).format(fmt).load(path)


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sections stored as JSON lines, in the shape the index build takes."""
    return spark.read.schema(
        "doc_oid string, sec_path string, sec_no int, doc_type string, text string, meta map<string, array<string>>"
    ).json(path)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def extract_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Title, body text and links of web pages."""
    page = F.regexp_replace(F.col(html), HTML_BLOCKS, " ")
    title = F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1)
    body = F.regexp_replace(page, r"(?is)<head[^>]*>.*?</head>", " ")
    links = F.regexp_extract_all(page, F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"']*)[\"']"), F.lit(1))
    return pages.select(
        *keep, squeeze(html_strip(title)).alias("title"), squeeze(html_strip(body)).alias("text"), links.alias("links")
    )


def rename_extracted(df: DataFrame, known: list[str], renames: dict[str, str]) -> DataFrame:
    """Lower-case names, apply renames, mark fields that are not known with ``ignored_``."""
    out = []
    for name in df.columns:
        low = name.lower()
        target = renames.get(low, low)
        out.append(F.col(name).alias(target if target in known else f"ignored_{target}"))
    return df.select(*out)

"""A stored index of one text per key: postings with positions, term statistics with score bounds, documents in their order.

Built once, read by every search after it. All tables are files:

``rows``     (key, len, term, tf, head, block, positions): a row per term, document and block of BLOCK positions, document by document, as the
             tasks that analyse the texts write them; ``head`` marks the first block of a term in a document, so the heads alone are the
             postings; a text without a token has one row without a term
``entries``  the same rows, with a term, sorted by term, key and block over range partitions, so a reader of few terms skips most row groups and
             a term of every document lies in several files; written by the first search that looks terms up
``stats``    (term, df, ttf): documents and occurrences
``bounds``   (term, size, df, top): the greatest sqrt(tf / len) among documents whose length has the logarithm ``size``; written by the first
             search that asks for it
``docs``     (key, len, seq): every key of the input, also of empty texts; ``seq`` numbers them from 0 in index order
``sizes``    (docs, tokens): one row
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer
from lexshelf.operators.rank import numbered

BLOCK = 4096
TABLES = ("rows", "stats", "docs", "sizes")
#: Rows of an Arrow batch that a task hands back.
HANDED = 1 << 18
#: Documents of a task that works on whole documents.
DOCUMENTS = 1 << 14


@dataclass(frozen=True)
class TextIndex:
    key: str
    path: str
    rows: DataFrame
    stats: DataFrame
    docs: DataFrame
    sizes: DataFrame
    block: int = BLOCK

    @property
    def entries(self) -> DataFrame:
        spark, path = self.rows.sparkSession, f"{self.path}/entries"
        made = self.rows.where("term IS NOT NULL").select("term", self.key, "len", "tf", "head", "block", "positions")
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # not written yet
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            sorted_rows = made.repartitionByRange(parts, "term", self.key).sortWithinPartitions("term", self.key, "block")
            sorted_rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(made.schema).parquet(path)

    @property
    def bounds(self) -> DataFrame:
        spark, path = self.rows.sparkSession, f"{self.path}/bounds"
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # not written yet
            by_size = self.rows.where("head").groupBy("term", length_class(F.col("len")).alias("size"))
            made = by_size.agg(F.count(F.lit(1)).alias("df"), F.max(F.sqrt("tf") / F.sqrt("len")).alias("top"))
            made.write.mode("overwrite").parquet(path)
        return spark.read.schema(made.schema).parquet(path)

    @property
    def postings(self) -> DataFrame:
        """(key, len, term, tf): one row per document and term; positions are not read."""
        return self.rows.where("head").select(self.key, "len", "term", "tf")

    @property
    def tokens(self) -> DataFrame:
        """(key, len, pos, term): one row per token, as ``postings.tokenize`` gives, without a second analysis of the texts."""
        return self.rows.where("term IS NOT NULL").select(self.key, "len", F.explode("positions").alias("pos"), "term")

    def parts(self) -> int:
        """Partitions for work on whole documents: the session's number, or more for more than DOCUMENTS in each."""
        known = self.sizes.first()["docs"]
        return max(int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // DOCUMENTS))

    @property
    def frequency(self) -> DataFrame:
        """(term, n): how many postings a term has, for joins that split frequent ones."""
        return self.stats.select("term", F.col("df").alias("n"))

    def count(self) -> Column:
        return self.sizes.select("docs").scalar()

    def mean_length(self) -> Column:
        """Over documents that have a token."""
        return self.docs.where("len > 0").select(F.avg("len")).scalar()


def length_class(length: Column) -> Column:
    return F.floor(F.log2(F.greatest(length, F.lit(1)))).cast("int")


def _counted(block: int, stacked: bool):
    """Rows of the documents of every Arrow batch from their token arrays."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["key", "len", "term", "tf", "head", "block", "positions"]
        for batch in batches:
            keys, tokens = batch.column(0), batch.column(1)
            owner = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.list_flatten(tokens)
            if stacked:
                terms, pos = values.field(0), values.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
            else:
                sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                terms, pos = values, np.arange(len(values)) - (np.cumsum(sizes) - sizes)[owner]
            kept = pc.fill_null(pc.not_equal(terms, ""), False)
            mask = kept.to_numpy(zero_copy_only=False)
            owner, pos, coded = owner[mask], pos[mask], terms.filter(kept).dictionary_encode()
            length = np.bincount(owner, minlength=len(keys))
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(owner * max(len(coded.dictionary), 1) + code, kind="stable")
            owner, pos, code = owner[order], pos[order].astype(np.int32), code[order]
            at = pos // block
            fresh = np.append(True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1]))[: len(owner)]
            first = np.flatnonzero(fresh | np.append(True, at[1:] != at[:-1])[: len(owner)])
            heads = np.flatnonzero(fresh)
            times = np.diff(np.append(heads, len(owner)))
            tf = times[np.cumsum(fresh) - 1][first]
            columns = [
                keys.take(pa.array(owner[first])), pa.array(length[owner[first]], pa.int64()), coded.dictionary.take(pa.array(code[first])),
                pa.array(tf, pa.int64()), pa.array(fresh[first]), pa.array(at[first], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.append(first, len(owner)), pa.int32()), pa.array(pos, pa.int32())),
            ]
            made = pa.RecordBatch.from_arrays(columns, names)
            for start in range(0, made.num_rows, HANDED):
                yield made.slice(start, HANDED)
            bare = np.flatnonzero(length == 0)
            if len(bare):
                gone = [pa.nulls(len(bare), c.type) for c in columns[2:]]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(bare)), pa.array(np.zeros(len(bare), np.int64)), *gone], names)

    return run


def entry_rows(df: DataFrame, key: str, text: str, analyzer: Analyzer, block: int = BLOCK) -> DataFrame:
    """(key, len, term, tf, head, block, positions), counted batch by batch; a text without a token gives one row without a term."""
    tokens = analyzer(F.col(text))
    if analyzer.stacked:
        tokens = F.flatten(F.transform(tokens, lambda slot, i: F.transform(slot, lambda t: F.struct(t.alias("term"), i.alias("pos")))))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), tokens.alias("tokens")).mapInArrow(
        _counted(block, analyzer.stacked), f"key {kind}, len bigint, term string, tf bigint, head boolean, block int, positions array<int>"
    )
    return rows.withColumnRenamed("key", key)


def build_text_index(df: DataFrame, key: str, text: str, analyzer: Analyzer, path: str, block: int = BLOCK) -> TextIndex:
    """Write the index of a table with one text per key under ``path``. Texts are analysed once; ``block`` positions make a block."""
    spark = df.sparkSession
    rows = entry_rows(df, key, text, analyzer, block)
    rows.write.parquet(f"{path}/rows")
    made = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    made.where("head").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf")).write.parquet(f"{path}/stats")
    docs = numbered(made.groupBy(key).agg(F.max("len").alias("len")), [], key)
    docs.select(key, "len", (F.col("place") - 1).alias("seq")).write.parquet(f"{path}/docs")
    sizes = spark.read.parquet(f"{path}/docs").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("len"), F.lit(0)).alias("tokens"))
    sizes.write.parquet(f"{path}/sizes")
    return open_text_index(spark, key, path, block)


def open_text_index(spark: SparkSession, key: str, path: str, block: int = BLOCK) -> TextIndex:
    return TextIndex(key, path, *(spark.read.parquet(f"{path}/{name}") for name in TABLES), block)

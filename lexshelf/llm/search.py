"""Ranked lexical search with hashed max-sketches: the best documents for every item of a query table.

A document gives every term an impact, a whole number. Its sketch has SLOTS coordinates; a term belongs to one by its hash, and a
coordinate holds the greatest weighted impact of the document's terms there. Impacts and weights are never negative, so the sum of a
query's coordinates bounds its score from above. Documents are taken in batches: the sketches of a batch answer all queries of a
block at once, and each query rescores the batch exactly in descending order of the bounds until no bound can reach the
best k that the task has seen. The best k of all tasks meet in two steps, first by part of the ids, then by query.

Queries are taken in blocks of about BLOCK characters; a block is what every task holds, and the documents are read once more for
each. Only terms of the block's queries are sketched and counted. Document frequencies come from a pass over all documents.

Nulls and empty texts have no term: such documents are neither counted nor found, such queries find nothing. Rows with equal id are
documents of their own. Documents without an id are counted but not ranked. Queries are the different rows (id, text); equal
scores are ordered by id. A long text is read whole; a batch ends where its texts reach BATCH_BYTES. An empty table on either side gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.llm.arrow import pieces, raw_text
from lexshelf.session import cut

SLOTS = 4096
BLOCK = 1 << 22
BATCH_ROWS, BATCH_BYTES = 512, 1 << 23
PARTS = 64
#: ASCII letters in lower case, digits and all bytes above 127; every other byte parts terms.
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Queries of one block: their terms as numbers, how often each occurs, and the slot of every term."""

    def __init__(self, texts: list[bytes], slots: int = SLOTS):
        self.vocabulary: dict[bytes, int] = {}
        self.queries: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            counts = Counter(terms(text))
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in counts]
            self.queries.append((np.array(ids, np.int64), np.array(list(counts.values()), np.int64)))
        self.slots = slots
        self.slot = np.array([xxhash.xxh64_intdigest(t) % slots for t in self.vocabulary], np.int64)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of batches with bounded rows and bytes, or one longer text."""
    offsets, data = raw_text(column)
    for start, end in pieces(offsets, BATCH_BYTES):
        for at in range(start, end, BATCH_ROWS):
            stop = min(at + BATCH_ROWS, end)
            yield at, [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(at, stop)]


def _counting(block: Block) -> Callable:
    """One row per task and term of the block: (term, df); term -1 has documents with a term, term -2 all terms."""
    vocabulary = block.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for _, texts in _texts(batch.column(0)):
                for text in texts:
                    found = terms(text)
                    df[-1] += bool(found)
                    df[-2] += len(found)
                    there = vocabulary.keys() & set(found)
                    df[[vocabulary[t] for t in there]] += 1
        number = np.append(np.arange(len(vocabulary)), [-2, -1])
        some = df > 0
        yield pa.RecordBatch.from_arrays([pa.array(number[some]), pa.array(df[some])], ["term", "df"])

    return run


def _impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    normal = 25 + 75 * length * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * normal)


def best_of(best: list, bounds: np.ndarray, ids: np.ndarray, exact: Callable[[int], int], k: int) -> int:
    """Put what a batch adds into the heap ``best`` of (score, -id); how many documents were rescored.

    Documents come by descending bound; a bound below the k-th score ends the search, an equal one counts where the id is smaller.
    """
    floor = max(best[0][0] if len(best) == k else 0, 1)
    able = np.flatnonzero(bounds >= floor)
    rescored = 0
    for at in able[np.lexsort((ids[able], -bounds[able]))].tolist():
        if len(best) == k:
            if bounds[at] < best[0][0]:
                break
            if (int(bounds[at]), -int(ids[at])) <= best[0]:
                continue
        rescored += 1
        score = exact(at)
        if score > 0:
            entry = (score, -int(ids[at]))
            if len(best) < k:
                heapq.heappush(best, entry)
            else:
                heapq.heappushpop(best, entry)
    return rescored


def _ranking(block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in block.queries]
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            names = batch.column(0).to_numpy()
            for first, texts in _texts(batch.column(1)):
                owner, term, tf, length = [], [], [], []
                for row, text in enumerate(texts):
                    found = terms(text)
                    counts = Counter(t for t in found if t in block.vocabulary)
                    owner += [row] * len(counts)
                    term += map(block.vocabulary.__getitem__, counts)
                    tf += counts.values()
                    length.append(len(found))
                if not owner:
                    continue
                rows, term = np.array(owner), np.array(term)
                value = weights[term] * _impacts(np.array(tf), np.array(length)[rows], n_docs, n_terms)
                sketch = np.zeros((block.slots, len(texts)), np.int64)
                np.maximum.at(sketch, (block.slot[term], rows), value)
                edges = np.searchsorted(rows, np.arange(len(texts) + 1))
                whole: dict[int, dict[int, int]] = {}
                ids = names[first : first + len(texts)]
                for (wanted, times), heap in zip(block.queries, best, strict=True):
                    if not len(wanted):
                        continue
                    bounds = times @ sketch[block.slot[wanted]]
                    pairs = list(zip(wanted.tolist(), times.tolist(), strict=True))

                    def exact(at: int, pairs: list = pairs) -> int:
                        if at not in whole:
                            span = slice(edges[at], edges[at + 1])
                            whole[at] = dict(zip(term[span].tolist(), value[span].tolist(), strict=True))
                        get = whole[at].get
                        return sum(n * get(t, 0) for t, n in pairs)

                    best_of(heap, bounds, ids, exact, k)
        rows = [(q, -name, score) for q, heap in enumerate(best) for score, name in heap]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["query", "doc_id", "score"])

    return run


def _kept(rows: DataFrame, by: list, k: int) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = cut(items.select("item_id", F.col("text").cast("string")).where("text IS NOT NULL").distinct())
    ways = -(-int(items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // block)
    out = None
    for part in range(ways):
        taken = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(ways)) == part).collect()
        queries = Block([r.text.encode() for r in taken], slots)
        counted = docs.select("text").mapInArrow(_counting(queries), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = {r.term: r.df for r in counted.collect()}
        n_docs, n_terms = df.get(-1, 0), df.get(-2, 0)
        if not n_terms:
            continue
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(queries.vocabulary))], np.int64)
        found = docs.mapInArrow(_ranking(queries, weights, n_docs, n_terms, k), "query long, doc_id long, score long")
        found = found.withColumn("n", _kept(found, ["query", F.pmod("doc_id", F.lit(PARTS))], k)).where(F.col("n") <= k)
        found = found.withColumn("rank", _kept(found, ["query"], k)).where(F.col("rank") <= k)
        kind = items.schema["item_id"].dataType
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(taken)], f"query long, item_id {kind.simpleString()}")
        named = found.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.union(named)
    if out is None:
        return items.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out

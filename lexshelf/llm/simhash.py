"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, classes.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 3 of 6 blocks, so every close pair meets
under one of the 20 choices of three blocks. A group under such a key agrees in 32 bits; where it is large,
the other 32 bits are cut into 6 blocks again, which leaves 16 free bits, so no group exceeds 65,536 distinct
fingerprints whatever the data. Within a group, each newly reached fingerprint is compared with all that are not yet
reached; the group gives one link per member, never all pairs.

Nulls, empty texts and texts without a word have fingerprint zero and are linked like any other. Rows with equal
doc_id are one document for the classes; a null doc_id is never the class id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import runs, texts_of
from lexshelf.llm.components import components
from lexshelf.session import cut

SEED = 42
WORDS = 3
BITS = 3
BLOCKS = 6
HOT = 4096


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The majority of every bit over the hashes of all word shingles, repeats included."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate(([0], ends[:-words]))
        cuts = map(slice, starts.tolist(), (ends[words - 1 :] - 1).tolist())
        values = map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED))
        hashes = np.fromiter(values, np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp): one row per document, in the same task that reads its text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, words) for t in texts_of(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, fp long")


def _masks(widths: list[tuple[int, int]], agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks, as signed 64-bit numbers; blocks are (start, width)."""
    blocks = [((1 << width) - 1) << start for start, width in widths]
    unsigned = [sum(choice) for choice in combinations(blocks, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in unsigned]


def _split(start: int, width: int, parts: int) -> list[tuple[int, int]]:
    edges = [start + width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _keys(masks: list[int], fp: Column) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])


def _stars(found: np.ndarray) -> Iterator[tuple[int, int]]:
    """(centre, member) positions: one link per member of every class of fingerprints within BITS steps."""
    left = np.arange(len(found))
    while len(left) > 1:
        centre, left = int(left[0]), left[1:]
        reached = [centre]
        while reached and len(left):
            near = np.bitwise_count(found[left] ^ found[reached.pop()]) <= BITS
            if near.any():
                new = left[near]
                left = left[~near]
                for member in new.tolist():
                    yield centre, member
                    reached.append(member)


def _link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, ["t", "k", "t2", "k2"]):
        new = np.ones(table.num_rows + 1, bool)
        new[1:-1] = False
        for key in ("t", "k", "t2", "k2"):
            values = table.column(key).to_numpy()
            new[1:-1] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        found = table.column("fp").to_numpy()
        a, b = [], []
        for i in np.flatnonzero(np.diff(starts) > 1):
            members = found[starts[i] : starts[i + 1]]
            for centre, member in _stars(members.view(np.uint64)):
                a.append(members[centre])
                b.append(members[member])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within BITS bits of each other, directly or in steps."""
    widths = _split(0, 64, BLOCKS)
    choices = list(combinations(range(BLOCKS), 3))
    masks = _masks(widths, 3)
    keyed = nodes.select("fp", F.inline(_keys(masks, F.col("fp"))))
    large = cut(keyed.groupBy("t", "k").count().where(F.col("count") > hot).select("t", "k"))
    rest = []
    for choice in choices:
        halves = [part for i in range(BLOCKS) if i not in choice for part in _split(*widths[i], 2)]
        rest.append(_masks(halves, 3))
    again = F.lit(None).cast("array<struct<t2:int,k2:bigint>>")
    for i, inner in enumerate(rest):
        again = F.when(F.col("t") == i, _keys(inner, F.col("fp")).cast("array<struct<t2:int,k2:bigint>>")).otherwise(again)
    small = keyed.join(large, ["t", "k"], "left_anti").select("fp", "t", "k", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("k2"))
    finer = keyed.join(large, ["t", "k"], "left_semi").select("fp", "t", "k", F.inline(again))
    groups = small.union(finer).repartition("t", "k", "t2", "k2").sortWithinPartitions("t", "k", "t2", "k2")
    return groups.mapInArrow(_link_groups, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, hot: int = HOT) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``: component_id is the least doc_id of its class.

    Fingerprints are written once; equal ones are one node, so copies are never compared with each other.
    """
    rows = cut(fingerprints(docs, words))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes, hot))
    rooted = cut(nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(classes, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` without the documents whose class has a smaller doc_id. Rows without a doc_id stay."""
    copies = near_duplicates(docs, words).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(cut(copies), "doc_id", "left_anti").select(*docs.columns)

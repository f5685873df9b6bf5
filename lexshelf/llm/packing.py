"""Token ids packed into rows of a fixed length, by best-fit decreasing within lanes.

Every text is encoded where it is read. Its ids are cut into segments of at most `width` ids, without loss: the segments of a
document, put together by their starts, are its ids. Segments are dealt over lanes of about LANE bytes of text, so a lane is a
bounded task whatever the corpus, and one shuffle of squeezed ids is all. A document's segments, and copies of a row, are
dealt one by one, so no document or group of copies fills a lane.

In a lane, segments are placed longest first into the row with the least room that still holds them. A segment tree over the
capacities 0 to `width` counts open rows by their room; the least sufficient capacity is found in a logarithm of the width.

A row of the result: its ids (little-endian, padded), the documents and starts of its segments, their cumulative lengths, and
the places where positions start again from 0. Null and empty texts have no ids and no segment; a null doc_id stays null. An
empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import runs
from lexshelf.llm.bpe import read_ranks

WIDTH = 2048
LANE = 16 << 20


class Capacities:
    """A segment tree that counts open rows by the room they have left."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.counts = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.counts[at] += n
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The row with the least room of ``least`` or more, and that room."""
        at = least + self.size
        if not self.counts[at]:
            while at > 1 and (at & 1 or not self.counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.counts[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Places of segments by row; ``lengths`` are in decreasing order."""
    open_rows, rows = Capacities(width), []
    for i, n in enumerate(lengths):
        found = open_rows.take(n)
        if found is None:
            rows.append([i])
            row, room = len(rows) - 1, width
        else:
            row, room = found
            rows[row].append(i)
        if room > n:
            open_rows.put(room - n, row)
    return rows


def _segments(ranks: dict[bytes, int], pattern: str, width: int, lanes: int, kind: str):
    """(lane, doc_id, start, n, ids): every text cut into segments, dealt over the lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        squeeze = zstandard.ZstdCompressor(level=1)
        task, number = TaskContext.get().partitionId(), 0
        schema = pa.schema([("lane", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("ids", pa.binary())])
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoding.encode_to_numpy(text, disallowed_special=()).astype(kind) if text else ()
                for start in range(0, len(ids), width):
                    part = ids[start : start + width]
                    number += 1
                    rows.append((xxhash.xxh64_intdigest(f"{task} {number}") % lanes, doc, start, len(part), squeeze.compress(part.tobytes())))
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


_ROWS = pa.schema([
    ("lane", pa.int32()), ("row", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ("cu_seqlens", pa.list_(pa.int32())), ("resets", pa.list_(pa.int32())), ("ids", pa.binary()),
])
_SCHEMA = "lane int, row long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, resets array<int>, ids binary"


def _pack(width: int, pad: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for table in runs(batches, ["lane"]):
            lane = table.column("lane").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, lane[1:] != lane[:-1])), len(lane))
            for a, b in zip(edges, edges[1:], strict=False):
                group = table.slice(a, b - a)
                lengths, docs, starts = (group.column(c).to_pylist() for c in ("n", "doc_id", "start"))
                ids = group.column("ids")
                made = []
                for number, places in enumerate(best_fit(lengths, width)):
                    ends = np.cumsum([lengths[i] for i in places]).tolist()
                    filled = np.full(width, pad, kind)
                    for i, end in zip(places, ends, strict=True):
                        filled[end - lengths[i] : end] = np.frombuffer(unzip.decompress(ids[i].as_py()), kind)
                    made.append((int(lane[a]), number, ends[-1], [docs[i] for i in places], [starts[i] for i in places], [0, *ends], [0, *ends[:-1]], filled.tobytes()))
                    if len(made) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), _ROWS, strict=True)], schema=_ROWS)
                        made = []
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), _ROWS, strict=True)], schema=_ROWS)

    return run


def packed(docs: DataFrame, path: str, width: int = WIDTH, pattern: str = public_tokenizers.PATTERN, lane: int = LANE) -> DataFrame:
    """Rows of ``width`` ids of the rank file at ``path``; ids have 16 bits where they fit, the id after the last one pads."""
    ranks = read_ranks(path)
    pad = max(ranks.values()) + 1
    kind = "<u2" if pad < 1 << 16 else "<u4"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lanes = size // lane + 1
    cuts = texts.mapInArrow(_segments(ranks, pattern, width, lanes, kind), "lane int, doc_id long, start long, n int, ids binary")
    ordered = cuts.repartition(lanes, "lane").sortWithinPartitions("lane", F.desc("n"), "doc_id", "start")
    return ordered.mapInArrow(_pack(width, pad, kind), _SCHEMA)


def write_matrix(rows: DataFrame, path: str) -> None:
    """Packed rows as Parquet; the column ids is a matrix of one row per record."""
    rows.write.mode("overwrite").parquet(path)


def positions(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Position of every id in its segment; padding goes on counting from 0."""
    starts = np.array([*cu_seqlens[:-1], cu_seqlens[-1]] if cu_seqlens[-1] < width else cu_seqlens[:-1])
    return np.arange(width) - np.repeat(starts, np.diff(np.append(starts, width)))

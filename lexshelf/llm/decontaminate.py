"""Benchmark passages in documents within an edit budget, by the q-gram lemma.

Items are cut into overlapping segments of SEGMENT characters. A place where a segment of m characters stands with at
most k edits shares at least m - q + 1 - q * k character q-grams with it, all on diagonals of one of the
overlapping bands of width BAND + k. Shared q-grams are counted by (document, segment, band); bands that reach the bound
are aligned within the band, and places with at most k edits are matches. k is RATE of the segment, or less for short
segments, so that the bound stays 1 or more. Items under Q characters have no q-gram: they are found where they stand exactly,
with no letter or digit on either side.

Letters are compared in lower case and white space as blanks, one for one, so positions are those of the text.
The index of one slice of the benchmark goes to the tasks; a slice has at most SLICE characters, and a larger benchmark is
taken in as many slices as it needs. Documents are never shuffled; long ones are scanned in overlapping blocks.

Null and empty texts and items match nothing, repeated rows are judged one by one, and a null id stays null. Columns
beside doc_id, text, item_id pass or are ignored. With an empty benchmark nothing is found and every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.session import cut

Q = 8
SEGMENT = 100
RATE = 0.1
BAND = 16
SLICE = 1 << 20
BLOCK = 1 << 19
TABLE_BITS = 22
#: Stands between texts; no character has this code.
GAP = 0xFFFFFFFF
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _plain_letters() -> np.ndarray:
    """Lower case and blanks for the first code points, one for one."""
    table = np.arange(0x3001, dtype=np.uint32)
    for i in range(0x3001):
        low = chr(i).lower()
        table[i] = 32 if chr(i).isspace() else ord(low) if len(low) == 1 else i
    return table


def codes_of(text: str, plain: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(raw < len(plain), plain[np.minimum(raw, len(plain) - 1)], raw)


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for the Q characters from every position on."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    wide, span = codes.astype(np.uint64), 1
    while span < Q:
        wide = (wide[:-span] * _MUL) ^ (wide[span:] + (wide[:-span] >> np.uint64(29)))
        span *= 2
    return wide * _MUL


def places_of(part: np.ndarray, codes: np.ndarray) -> list[int]:
    """Where ``part`` stands in ``codes`` with no letter or digit right before or after it."""
    if len(codes) < len(part):
        return []
    starts = np.flatnonzero(codes[: len(codes) - len(part) + 1] == part[0])
    for i in range(1, len(part)):
        starts = starts[codes[starts + i] == part[i]]
    inside = lambda i: 0 <= i < len(codes) and codes[i] != GAP and chr(codes[i]).isalnum()
    return [s for s in starts.tolist() if not inside(s - 1) and not inside(s + len(part))]


class Index:
    """Q-grams of one slice of the benchmark, and its segments."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE, segment: int = SEGMENT):
        self.plain = _plain_letters()
        self.item, self.begin, self.size, self.edits, texts = [], [], [], [], []
        posted, offset, owner = [], [], []
        for number, (_, text) in enumerate(items):
            codes = codes_of(text, self.plain)
            last = max(0, len(codes) - segment)
            for at in sorted({*range(0, last + 1, max(1, segment // 2)), last}) if len(codes) >= Q else []:
                part = codes[at : at + segment]
                found = grams(part)
                owner.append(np.full(len(found), len(self.item)))
                offset.append(np.arange(len(found)))
                posted.append(found)
                self.item.append(number)
                self.begin.append(at)
                self.size.append(len(part))
                self.edits.append(min(int(rate * len(part)), (len(part) - Q) // Q))
                texts.append(part)
        self.ids = [i for i, _ in items]
        self.short = [(n, c) for n, c in ((n, codes_of(t, self.plain)) for n, (_, t) in enumerate(items)) if 0 < len(c) < Q]
        self.item, self.begin, self.size, self.edits = (np.array(x, np.int64) for x in (self.item, self.begin, self.size, self.edits))
        self.bound = self.size - Q + 1 - Q * self.edits
        self.most = int(self.edits.max()) if len(texts) else 0
        self.longest = int(self.size.max()) if len(texts) else 0
        self.texts = np.zeros((len(texts), self.longest), np.uint32)
        for i, t in enumerate(texts):
            self.texts[i, : len(t)] = t
        values = np.concatenate(posted) if posted else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.values, starts = np.unique(values[order], return_index=True)
        self.starts = np.append(starts, len(values))
        self.owner = np.concatenate(owner)[order] if posted else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset)[order] if posted else np.zeros(0, np.int64)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.values >> np.uint64(64 - TABLE_BITS)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, number of a q-gram) of the shared q-grams that stand close enough to others to matter."""
        value = grams(codes)
        at = np.flatnonzero(self.table[value >> np.uint64(64 - TABLE_BITS)])
        number = np.searchsorted(self.values, value[at])
        number[number == len(self.values)] = 0
        same = self.values[number] == value[at]
        at, number = at[same], number[same]
        reach = self.longest + self.most
        dense = np.searchsorted(at, at + reach, side="right") - np.searchsorted(at, at - reach)
        close = dense >= int(self.bound.min())
        return at[close], number[close]

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, first diagonal of the band) where enough q-grams are shared."""
        at, number = self.hits(codes)
        counts = self.starts[number + 1] - self.starts[number]
        place = np.repeat(self.starts[number], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        segment = self.owner[place]
        diagonal = np.repeat(at, counts) - self.offset[place] + self.longest
        band = diagonal // BAND
        also = (diagonal % BAND < self.edits[segment]) & (band > 0)
        width = (len(codes) + 2 * self.longest) // BAND + 2
        keys, shared = np.unique(np.concatenate((segment * width + band, (segment * width + band - 1)[also])), return_counts=True)
        segment = keys // width
        enough = shared >= self.bound[segment]
        return segment[enough], (keys % width)[enough] * BAND - self.longest

    def align(self, codes: np.ndarray, segment: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edits, start, end) of the best place of each segment within its band; all candidates row by row together."""
        width = BAND + self.most
        pad = self.longest + width
        padded = np.concatenate((np.zeros(pad, np.uint32), codes, np.zeros(2 * pad, np.uint32)))
        lanes = np.arange(width)
        edit = 1 << 10
        cost = np.broadcast_to(lanes, (len(segment), width)).astype(np.int64)
        beyond = diagonal[:, None] + lanes
        cost = np.where((beyond < 0) | (beyond > len(codes)), edit << 10, cost)
        best = cost.copy()
        for row in range(self.longest):
            where = diagonal[:, None] + row + lanes
            real = (where >= 0) & (where < len(codes))
            same = (padded[np.clip(where + pad, 0, len(padded) - 1)] == self.texts[segment, row][:, None]) & real
            down = np.append(cost[:, 1:], np.full((len(segment), 1), edit << 10), axis=1) + edit
            cost = np.minimum(np.where(same, cost, np.where(real, cost + edit, edit << 10)), down)
            cost = np.minimum.accumulate(cost - edit * lanes, axis=1) + edit * lanes
            np.copyto(best, cost, where=(self.size[segment] == row + 1)[:, None])
        lane = best.argmin(axis=1)
        least = best[np.arange(len(segment)), lane]
        return least // edit, diagonal + least % edit, diagonal + lane + self.size[segment]

    def search(self, codes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item number, start, end, edits) of every segment found."""
        for number, part in self.short:
            for start in places_of(part, codes):
                yield number, start, start + len(part), 0
        if len(codes) < Q or not len(self.values):
            return
        segment, diagonal = self.candidates(codes)
        for at in range(0, len(segment), 2048):
            part, lines = segment[at : at + 2048], diagonal[at : at + 2048]
            edits, start, end = self.align(codes, part, lines)
            for i in np.flatnonzero(edits <= self.edits[part]).tolist():
                yield int(self.item[part[i]]), max(0, int(start[i])), int(end[i]), int(edits[i])


def scan(index: Index, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item number, start, end, least edits): the stretch from the first to the last segment found."""
    margin = 2 * (index.longest + index.most + BAND)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}

    def flush(rows: list[tuple[int, int, np.ndarray]]) -> None:
        gap = np.full(margin, GAP, np.uint32)
        codes = np.concatenate([x for _, _, part in rows for x in (part, gap)])
        begins = np.cumsum([0] + [len(part) + margin for _, _, part in rows])
        for item, start, end, edits in index.search(codes):
            # Either end may reach into a gap by some edits, but a stretch is shorter than a gap: it meets one text only.
            i = int(np.searchsorted(begins, end - 1, side="right")) - 1
            row, skipped, part = rows[i]
            a, b = max(0, start - int(begins[i])) + skipped, min(len(part), end - int(begins[i])) + skipped
            old = found.get((row, item), (a, b, edits))
            found[row, item] = (min(a, old[0]), max(b, old[1]), min(edits, old[2]))

    held, size = [], 0
    for row, text in enumerate(texts):
        codes = codes_of(text or "", index.plain)
        for at in range(0, max(1, len(codes) - margin), BLOCK):
            part = codes[at : at + BLOCK + margin]
            held.append((row, at, part))
            size += len(part) + margin
            if size > BLOCK:
                flush(held)
                held, size = [], 0
    if held:
        flush(held)
    for (row, item), (start, end, edits) in sorted(found.items()):
        yield row, item, start, end, edits


def _slices(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in slices of at most SLICE characters or one item."""
    items = cut(benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), F.xxhash64("item_id", "text").alias("deal")))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-2 * total // SLICE) or 0
    for i in range(parts):
        rows = items.where(F.pmod("deal", F.lit(parts)) == i).orderBy("item_id", "text").collect()
        held, size = [], 0
        for r in rows:
            if held and size + len(r.text) > SLICE:
                yield held
                held, size = [], 0
            held.append((r.item_id, r.text))
            size += len(r.text)
        if held:
            yield held


def _find(items: list[tuple[int | None, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, rate)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[r], index.ids[item], a, b, e) for r, item, a, b, e in scan(index, batch.column(1).to_pylist())]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "edits"])

    return run


def _keep(items: list[tuple[int | None, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, rate)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[r for r, *_ in scan(index, batch.column("text").to_pylist())]] = False
            yield batch.filter(pa.array(clean))

    return run


def passages(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, start, end, edits) of every item of which a segment stands in a document.

    start and end are characters of the text around all segments found; edits is the least number for one of them.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, start long, end long, edits long"
    found = [texts.mapInArrow(_find(items, rate), schema) for items in _slices(benchmark)]
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return reduce(lambda left, items: left.mapInArrow(_keep(items, rate), schema), _slices(benchmark), docs)

"""Language identification with bit-sliced Bloom filters over character n-grams.

Letters are taken in lower case and everything else as one blank; an n-gram is GRAM bytes of that. Over all training
documents, n-grams are counted by language. Those that make up SHARE or more of a language's n-grams are its set; a language has
at most 1 / SHARE of them, so the sets are bounded whatever the corpus. One table of slots serves all languages: every
slot holds one bit per language, an n-gram sets its language's bit in HASHES slots, and the AND of those slots is the mask
of all languages that contain an n-gram. A text's n-grams are counted per language; the count is corrected by the rate of
false positives that the fill of the language's slice gives, and the highest one decides (ties: the first in order).

A null text or one without a letter is `und`, and so is everything when nothing was learned. Repeated rows are judged one
by one and count as often as they stand there. Rows with a null language are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import pieces, raw_text
from lexshelf.session import cut

GRAM = 4
SHARE = 2e-5
HASHES = 3
SLOTS_PER_GRAM = 16
BLOCK = 1 << 20
HELD = 1 << 22
UNKNOWN = "und"

_PLAIN = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def letters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one blank before each and between runs of letters: (bytes, bounds)."""
    sizes = np.diff(bounds)
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    out = np.full(len(data) + len(sizes), 32, np.uint8)
    plain = _PLAIN[data]
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    plain[accented] += 32
    out[at] = plain
    kept = np.ones(len(out), bool)
    kept[1:] = (out[1:] != 32) | (out[:-1] != 32)
    starts = bounds[:-1] + np.arange(len(sizes))
    kept[starts] = True
    places = np.append(0, np.cumsum(kept))
    return out[kept], np.append(places[starts], places[-1])


def grams(data: np.ndarray) -> np.ndarray:
    """GRAM bytes from every position on, as one number."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint32)
    return np.ndarray((len(data) - GRAM + 1,), "<u4", np.ascontiguousarray(data).tobytes(), strides=(1,)).copy()


def text_grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, text number) of all n-grams within the texts."""
    plain, edges = letters(data, bounds)
    found = grams(plain)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[: len(found)]
    inside = np.arange(len(found)) + GRAM <= edges[1:][owner]
    return found[inside], owner[inside]


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, bounds) in pieces; a very long text is one piece."""
    bounds, data = raw_text(column)
    for first, last in pieces(bounds, BLOCK):
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, gram, n) of a task; what is held is merged before it outgrows HELD entries."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        return values, np.bincount(where, np.concatenate([n for _, n in parts]), len(values)).astype(np.int64)

    size = 0
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for first, last, data, bounds in blocks(batch.column(1)):
            values, owner = text_grams(data, bounds)
            names, code = np.unique(langs[first:last].astype(str), return_inverse=True)
            for i, name in enumerate(names.tolist()):
                found = np.unique(values[code[owner] == i], return_counts=True)
                held.setdefault(name, []).append(found)
                size += len(found[0])
        if size > HELD:
            held = {name: [merged(parts)] for name, parts in held.items()}
            size = sum(len(parts[0][0]) for parts in held.values())
            if size > HELD // 2:
                yield from _rows({name: parts[0] for name, parts in held.items()})
                held, size = {}, 0
    yield from _rows({name: merged(parts) for name, parts in held.items()})


def _rows(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for name, (values, n) in counts.items():
        for at in range(0, len(values), 1 << 16):
            part = slice(at, at + (1 << 16))
            columns = [pa.array([name] * len(values[part])), pa.array(values[part].astype(np.int64)), pa.array(n[part])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


class Filters:
    """One Bloom filter per language, bit-sliced: a slot is a mask of languages."""

    def __init__(self, sets: dict[str, list[int]]):
        self.langs = sorted(sets)
        most = max((len(s) for s in sets.values()), default=0)
        self.bits = max(10, int(SLOTS_PER_GRAM * most).bit_length())
        self.slots = np.zeros((-(-len(self.langs) // 64) or 1, 1 << self.bits), np.uint64)
        for i, lang in enumerate(self.langs):
            for where in self.places(np.array(sets[lang], np.int64).astype(np.uint32)):
                self.slots[i // 64, where] |= np.uint64(1 << i % 64)
        fill = [np.count_nonzero(self.slots[i // 64] & np.uint64(1 << i % 64)) / (1 << self.bits) for i in range(len(self.langs))]
        self.false = np.array(fill) ** HASHES

    def places(self, values: np.ndarray) -> Iterator[np.ndarray]:
        wide = values.astype(np.uint64) + np.uint64(1)
        for i in range(HASHES):
            mixed = wide * np.uint64((0x9E3779B97F4A7C15 + 0x5851F42D4C957F2E * i) & (2**64 - 1) | 1)
            yield (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.bits)

    def counts(self, values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """(text, language): n-grams that the language contains, corrected for false positives."""
        places = list(self.places(values))
        out = np.zeros((texts, len(self.langs)))
        for word, slots in enumerate(self.slots):
            mask = slots[places[0]]
            for where in places[1:]:
                mask &= slots[where]
            for i in range(64 * word, min(64 * word + 64, len(self.langs))):
                out[:, i] = np.bincount(owner[(mask >> np.uint64(i % 64)) & np.uint64(1) == 1], minlength=texts)
        total = np.bincount(owner, minlength=texts)[:, None]
        return np.maximum(0, (out - total * self.false) / (1 - self.false)) / np.maximum(total, 1)

    def judge(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of every text: the score is the corrected share of its n-grams in that language."""
        names, scores = [], []
        for first, last, data, bounds in blocks(column):
            share = self.counts(*text_grams(data, bounds), last - first) if self.langs else np.zeros((last - first, 1))
            best = share.argmax(axis=1)
            ascii_letter = (data | 32) - np.uint8(97) < 26
            some = np.append(0, np.cumsum(ascii_letter))[bounds]
            for i in range(last - first):
                known = self.langs and (some[i + 1] > some[i] or any(map(str.isalpha, column[first + i].as_py() or "")))
                names.append(self.langs[best[i]] if known else UNKNOWN)
                scores.append(min(1.0, share[i, best[i]]) if known else 0.0)
        return names, np.array(scores)


def learned(docs: DataFrame) -> Filters:
    """Filters from all rows of ``docs`` (lang, text) that have a language."""
    rows = docs.where("lang is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = cut(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg((SHARE * F.sum("n")).alias("least"))
    langs = rows.select("lang").distinct().collect()
    sets = {r.lang: [] for r in langs}
    for r in counts.join(cut(totals), "lang").where("n >= least").select("lang", "gram").collect():
        sets[r.lang].append(r.gram)
    return Filters(sets)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) from (doc_id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names, scores = filters.judge(batch.column(2))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", F.col("text").cast("string")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(doc_id: Column, modulus: int) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2. A null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from documents that are not held out, predicted for all."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 4).alias("held_out"), "lang", "text")
    return predict(rows, learned(rows.where("not held_out").select("lang", "text")))

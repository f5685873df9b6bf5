"""Exact removal of byte strings that also start earlier in the corpus, by prefix-free parsing.

**Parse.** A rolling hash runs over every text; the trigger of a LENGTH-byte window is the position in it whose
TRIGGER-byte hash is least. Triggers depend on content alone, and every window has one. A phrase is the text
under neighbouring windows with the same trigger, so it ends LENGTH - 1 bytes inside the next one and every
window lies whole in one phrase. Equal windows have equal triggers, so they can only meet under one trigger hash.

**Dictionary and parse.** Phrase occurrences (in corpus order: the parse) are dealt out by trigger hash. Of equal
phrases the first stays, and all windows of the others are repeats. Only first occurrences of different
phrases under one trigger send their text. There, suffixes of these dictionary phrases are ranked by prefix doubling,
and rank and place in the parse together put equal windows in corpus order: all but the first are repeats.

**Skew.** Within each Arrow batch equal phrases are combined before the shuffle, so a hot passage costs one entry
per batch. A trigger with more than HOT different phrases (a common passage amid different texts) sends single windows,
combined and dealt out by their own hash, in place of phrases. Both ways are exact.

Nulls and empty texts are empty; a text shorter than LENGTH has no window. doc_id names the document: rows with one
doc_id are one document whose marks hold for each row, and a null doc_id comes before all others. Other columns pass.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import pieces, raw_text, runs, texts_of
from lexshelf.session import cut

LENGTH = 100
TRIGGER = 32
BLOCK = 1 << 20
HOT = 2048
#: Single windows and phrases that a task holds at a time.
HELD = 1 << 16
NO_ID = -(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Roller:
    """Polynomial hashes of all stretches of a block, modulo 2**64, over random byte values."""

    def __init__(self, most: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 60)) * 8 + 5
        self.values = rng.integers(0, (1 << 64) - 1, 256, np.uint64, endpoint=True)
        self.powers, self.inverse = (
            np.cumprod(np.append(np.uint64(1), np.full(most, step, np.uint64))) for step in (base, pow(base, -1, 1 << 64))
        )

    def read(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        sums = self.sums[length:] - self.sums[:-length]
        return mix(sums * self.inverse[: len(sums)])

    def stretches(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :])


def parse(roller: Roller, data: np.ndarray, bounds: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, ...]:
    """Phrases of the texts in one block: (trigger hash, phrase hash, text number, start in the block, windows)."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    roller.read(data)
    hashes = roller.windows(trigger)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    chosen = sliding_min(keys, length - trigger + 1).astype(np.uint32)
    inside = np.zeros(len(chosen) + 1, np.int8)
    lengths = np.diff(bounds)
    long = lengths >= length
    inside[bounds[:-1][long]] = 1
    ends = bounds[1:][long] - length + 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(chosen)))
    kept = inside[starts]
    starts, counts = starts[kept], counts[kept]
    whole = roller.stretches(starts, starts + counts + length - 1)
    return hashes[chosen[starts]], whole, np.searchsorted(bounds, starts, side="right") - 1, starts, counts


def _parse_docs(length: int, trigger: int, parts: int):
    """Entries (trigger hash, phrase hash, doc, offset, windows), combined within an Arrow batch, by part of the hash."""

    def entries(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, roller: Roller) -> Iterator[tuple[np.ndarray, ...]]:
        for first, last in pieces(bounds, BLOCK):
            low, high = int(bounds[first]), int(bounds[last])
            step = BLOCK - length + 1
            for at in range(0, max(1, high - low - length + 1), step) if high - low > BLOCK else [0]:
                end = min(high, low + at + BLOCK)
                block = np.array([0, end - low - at]) if high - low > BLOCK else bounds[first : last + 1] - low
                h, g, text, start, n = parse(roller, data[low + at : end], block, length, trigger)
                yield h, g, ids[first + text], (start - block[text] + at).astype(np.uint32), n.astype(np.uint32)

    def row(part: int, h, g, doc, off, n) -> dict:
        return {"part": part, "h": h.tobytes(), "g": g.tobytes(), "doc": doc.tobytes(), "off": off.tobytes(), "n": n.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(BLOCK)
        none = np.zeros(0, np.uint64)
        for batch in batches:
            bounds, data = raw_text(batch.column(1))
            found = list(entries(batch.column(0).to_numpy(), bounds, data, roller))
            if not found:
                continue
            h, g, doc, off, n = (np.concatenate(x) for x in zip(*found, strict=True))
            if not ((doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (off[1:] >= off[:-1]))).all():
                order = np.lexsort((off, doc))
                h, g, doc, off, n = (x[order] for x in (h, g, doc, off, n))
            # equal phrases side by side, the first of them ahead
            order = np.argsort(g, kind="stable")
            h, g, doc, off, n = (x[order] for x in (h, g, doc, off, n))
            same = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
            first = np.append(True, ~same) if len(h) else np.zeros(0, bool)
            head = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
            later = (doc != doc[head]) | (off != off[head])
            known = [x[later] for x in (doc, off, n)]
            rows = [row(i, none, none, *(x[i::parts] for x in known)) for i in range(min(parts, len(known[0])))]
            h, g, doc, off, n = (x[first] for x in (h, g, doc, off, n))
            part = (h & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)  # the upper half is a minimum, so not even
            order = np.argsort(part, kind="stable")
            h, g, doc, off, n = (x[order] for x in (h, g, doc, off, n))
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            for i in np.flatnonzero(np.diff(edges)).tolist():
                s = slice(edges[i], edges[i + 1])
                rows.append(row(i, h[s], g[s], doc[s], off[s], n[s]))
            for at in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[at : at + 256], _ENTRIES)

    return run


_ENTRIES = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("h", "g", "doc", "off", "n"))])
_MARKS = "doc long, off long, n int, key long, single boolean"


def _marks(doc, off, n, key=None, single=None) -> pa.RecordBatch:
    size = len(doc)
    columns = [pa.array(doc, pa.int64()), pa.array(np.asarray(off).astype(np.int64)), pa.array(np.asarray(n).astype(np.int32))]
    columns.append(pa.nulls(size, pa.int64()) if key is None else pa.array(key.view(np.int64)))
    columns.append(pa.nulls(size, pa.bool_()) if single is None else pa.array(single))
    return pa.RecordBatch.from_arrays(columns, ["doc", "off", "n", "key", "single"])


def _judge(hot: int):
    """Marks of one part: windows that repeat (key null), and first phrases whose text has to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"h": np.uint64, "g": np.uint64, "doc": np.int64, "off": np.uint32, "n": np.uint32}
        for table in runs(batches, ["part"]):
            number = table.column("part").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number))
            columns = {c: table.column(c).to_pylist() for c in kinds}
            for a, b in zip(edges, edges[1:], strict=False):
                known = [i for i in range(a, b) if not columns["h"][i]]
                fresh = [i for i in range(a, b) if columns["h"][i]]
                pick = lambda c, rows: np.frombuffer(b"".join(columns[c][i] for i in rows), kinds[c])
                if known:
                    yield _marks(*(pick(c, known) for c in ("doc", "off", "n")))
                h, g, doc, off, n = (pick(c, fresh) for c in kinds)
                if not len(h):
                    continue
                order = np.lexsort((off, doc, g, h))
                h, g, doc, off, n = (x[order] for x in (h, g, doc, off, n))
                new_h = np.append(True, h[1:] != h[:-1])
                new = new_h | np.append(True, g[1:] != g[:-1])
                head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
                later = (doc != doc[head]) | (off != off[head])
                yield _marks(doc[later], off[later], n[later])
                trigger = np.cumsum(new_h) - 1
                different = np.bincount(trigger[new])[trigger]
                text = new & (different > 1)
                yield _marks(doc[text], off[text], n[text], h[text], different[text] > hot)

    return run


def _phrase_texts(length: int, held: int = HELD):
    """Texts of the phrases to compare, keyed by trigger; of single windows keyed by their hash. No text: a known repeat.

    Equal windows are combined among ``held`` rows, or those of one document.
    """

    def handed(rows: list, windows: dict) -> Iterator[pa.RecordBatch]:
        rows += [(xxhash.xxh64_intdigest(w) >> 1, d, at, 1, w) for w, (d, at) in windows.items()]
        for at in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_pylist([dict(zip(_PHRASES.names, r, strict=True)) for r in rows[at : at + 4096]], _PHRASES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list = []
            windows: dict[bytes, tuple[int, int]] = {}
            for i in range(batch.num_rows):
                doc, packed, wanted = (batch.column(c)[i].as_py() for c in ("doc", "packed", "wanted"))
                text = unzip.decompress(packed)
                for w in wanted:
                    off, n = w["off"], w["n"]
                    if not w["single"]:
                        rows.append((w["key"], doc, off, n, text[off : off + n + length - 1]))
                        continue
                    for at in range(off, off + n):
                        this, window = (doc, at), text[at : at + length]
                        best = windows.setdefault(window, this)
                        if this != best:
                            windows[window], later = min(best, this), max(best, this)
                            rows.append((xxhash.xxh64_intdigest(repr(later)) >> 1, *later, 1, None))
                if len(rows) + len(windows) >= held:
                    yield from handed(rows, windows)
                    rows, windows = [], {}
            yield from handed(rows, windows)

    return run


_PHRASES = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("off", pa.int64()), ("n", pa.int32()), ("text", pa.binary())])


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of ``data`` by their first ``depth`` bytes (16 or more), by prefix doubling.

    A rank is how many suffixes are less, so one that is told apart from all others keeps its rank and is not sorted again.
    """
    step, size = 8, len(data)
    padded = np.append(data, np.zeros(step, np.uint8))
    eight = np.ndarray((size,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    rank = np.zeros(size + 1, np.int64)
    order = np.argsort(eight)
    open_ = _ranked(rank, order, eight[order], np.zeros(size, np.int64))
    while step < depth and len(open_):
        shift = min(step, depth - step)
        key = rank[open_] * (size + 1) + rank[np.minimum(open_ + shift, size)]
        order = np.argsort(key)
        open_ = _ranked(rank, open_[order], key[order], rank[open_[order]])
        step += shift
    return rank[:-1]


def _ranked(rank: np.ndarray, order: np.ndarray, key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Write ranks of suffixes in the order of their keys, each within its old rank ``group``; suffixes that are still alike."""
    places = np.arange(len(order))
    new = np.append(True, key[1:] != key[:-1])[: len(order)]
    own = np.append(True, group[1:] != group[:-1])[: len(order)]
    rank[order] = group + np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(own, places, 0))
    return order[~(new & np.append(new[1:], True)[: len(order)])]


def _compare(length: int):
    """Marks of the windows that repeat among the dictionary phrases of whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["key"]):
            known = table.column("text").is_null().to_numpy()
            doc, off, n = (table.column(c).to_numpy() for c in ("doc", "off", "n"))
            if known.any():
                yield _marks(doc[known], off[known], n[known])
            doc, off, n = doc[~known], off[~known], n[~known]
            if len(doc) < 2:
                continue
            texts = table.column("text").drop_null().to_pylist()
            base = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            n = np.diff(base) - length + 1
            phrase = np.repeat(np.arange(len(n)), n)
            inner = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
            rank = suffix_ranks(np.frombuffer(b"".join(texts), np.uint8), length)[base[phrase] + inner]
            doc, start = doc[phrase], off[phrase] + inner
            order = np.lexsort((start, doc, rank))
            rank, doc, start = rank[order], doc[order], start[order]
            head = np.maximum.accumulate(np.where(np.append(True, rank[1:] != rank[:-1]), np.arange(len(rank)), 0))
            later = (doc != doc[head]) | (start != start[head])
            doc, start = doc[later], start[later]
            order = np.lexsort((start, doc))
            doc, start = doc[order], start[order]
            new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1))[: len(doc)])
            ends = np.append(new[1:], len(doc)) - 1
            yield _marks(doc[new], start[new], start[ends] - start[new] + 1 if len(new) else new)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zipped = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        text = pa.array([zipped.compress(t) for t in texts_of(batch.column("text"))], pa.binary())
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), text], [*rest, "packed"])


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with its text squeezed for the way through a shuffle."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "packed binary"])
    return docs.mapInArrow(_pack, schema)


def repeated_windows(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc, off, n): n neighbouring windows from byte off on that also start earlier in the corpus."""
    trigger = min(TRIGGER, max(1, length // 3))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("string").alias("text"))
    parts = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = keyed.mapInArrow(_parse_docs(length, trigger, parts), "part int, h binary, g binary, doc binary, off binary, n binary")
    judged = cut(entries.repartition("part").sortWithinPartitions("part").mapInArrow(_judge(hot), _MARKS))
    asked = judged.where("key is not null").groupBy("doc").agg(F.collect_list(F.struct("off", "n", "key", "single")).alias("wanted"))
    texts = _packed(keyed).join(asked, "doc").mapInArrow(_phrase_texts(length), "key long, doc long, off long, n int, text binary")
    compared = cut(texts.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(length), _MARKS))
    return judged.where("key is null").select("doc", "off", "n").union(compared.select("doc", "off", "n"))


def _remove(length: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, spans, sizes = [], [], []
            for packed, marks in zip(batch.column("packed").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                text = unzip.decompress(packed)
                sizes.append(len(text))
                if not marks:
                    kept.append(text)
                    spans.append([])
                    continue
                at = np.array(sorted((m["off"], m["off"] + m["n"] - 1 + length) for m in marks))
                reach = np.maximum.accumulate(at[:, 1])
                new = np.flatnonzero(np.append(True, at[1:, 0] > reach[:-1]))
                starts = np.minimum(at[new, 0], len(text)).tolist()
                ends = np.minimum(reach[np.append(new[1:], len(at)) - 1], len(text)).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True) if a < b])
                kept.append(b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)], strict=True)))
            rest = [c for c in batch.schema.names if c not in ("packed", "marks", "doc")]
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            stay = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            columns = [*(batch.column(c) for c in rest), stay, pa.array(spans, spans_type), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "kept", "removed", "n_bytes"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, as_text: bool = False) -> DataFrame:
    """``docs`` without text, and kept (bytes that stay, binary), removed (maximal runs start, end) and n_bytes.

    Every byte under a ``length``-byte string that also starts earlier (smaller doc_id, or the same document) goes.
    With ``as_text`` kept is a string: a character of which only some bytes stay goes as well.
    """
    found = repeated_windows(docs, length, hot)
    marks = found.groupBy("doc").agg(F.collect_list(F.struct("off", "n")).alias("marks"))
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"], F.col("text").cast("string").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    joined = _packed(named).join(marks, "doc", "left")
    rest = [(f"c{i}", f) for i, f in enumerate(docs.schema.fields) if f.name != "text"]
    schema = ", ".join([*(f"{c} {f.dataType.simpleString()}" for c, f in rest), f"kept {'string' if as_text else 'binary'}", "removed array<struct<start:long,end:long>>", "n_bytes long"])
    return joined.mapInArrow(_remove(length, as_text), schema).withColumnsRenamed({c: f.name for c, f in rest})


def shortened(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the text that stays, and its number of characters where there is a column n_chars. No row goes."""
    plain = docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"x{i}") for i, c in enumerate(docs.columns)])
    found = remove_repeats(plain, length, as_text=True)
    values = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long"), "doc_id": F.col("doc_id")}
    return found.select(*[values.get(c, F.col(f"x{i}")).alias(c) for i, c in enumerate(docs.columns)])

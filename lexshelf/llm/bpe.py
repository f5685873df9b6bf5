"""Byte-level BPE by DuckDB queries inside each task: recursive contraction encodes, ordered aggregation decodes.

**Encode.** A text is cut at blanks that stand before something else than white space: no match of the pattern crosses
such a place. Stretches and pattern matches that a task has met before are looked up; new matches go to DuckDB in blocks. There
a word is a list of tokens, its token positions join the merge table, and the leftmost pair of least rank is
contracted, until no pair of the word is in the table. Matches of more than LONG bytes would take as many rounds as they have
tokens; the same contractions are then done with a heap.

**Decode.** Token positions join the vocabulary and their bytes are put together in order.

A task holds its memory of known words below KNOWN entries, and blocks of BLOCK bytes of text. A null or empty text has no
tokens; decoding gives empty bytes. A long text is encoded stretch by stretch and decoded POSITIONS tokens at a time. Repeated rows are rows
like any other; an empty table gives an empty result. Columns beside the given ones pass through, but for those named as the result's own.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LONG = 200
#: Token positions that one decoding query holds.
POSITIONS = 1 << 19
KNOWN = 400_000
BLOCK = 4 << 20
WORDS = 30_000

#: Marks the first stretch of a text; no other stretch starts with a blank.
FIRST = " "
#: Signs that are one match together after a word.
MARKS = ".,;:!?*#$%&|"

#: White space as the tokenizer library takes it.
SPACE, NOT_SPACE = r"\p{White_Space}", r"\P{White_Space}"

ENCODE = """
WITH RECURSIVE state(word, tokens, step) AS (
    SELECT word, list(token ORDER BY pos), 0 FROM bytes GROUP BY word
    UNION ALL
    (WITH pairs AS (
        SELECT word, unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b, generate_subscripts(tokens[2:], 1) AS pos
        FROM state WHERE len(tokens) > 1
     ), best AS (
        SELECT word, min(merged * 65536::BIGINT + pos) AS least, least // 65536 AS merged, least % 65536 AS pos
        FROM pairs JOIN merges USING (a, b) GROUP BY word
     )
     SELECT word, tokens[:pos - 1] || [merged::INTEGER] || tokens[pos + 2:], step + 1 FROM best JOIN state USING (word))
)
SELECT word, arg_max(tokens, step) AS tokens FROM state GROUP BY word ORDER BY word
"""
DECODE = "SELECT doc, string_agg(text, '' ORDER BY pos) AS text FROM tokens JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one task: a DuckDB database in memory with the merges and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern.replace(r"\s", SPACE).replace(r"\S", NOT_SPACE))
        self.odd = regex.compile(rf" (?:\s|{SPACE}|$)")
        self.starts = regex.compile(r"(?= [^\s\p{White_Space}])")
        self.matches: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        a, b, merged = np.array(merges, np.int32).reshape(-1, 3).T
        self._table("merges", a=a, b=b, merged=merged)
        self._table("vocabulary", id=np.array(list(ranks.values()), np.int32), text=[t.decode("latin-1") for t in ranks])

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _run(self, sql: str, name: str, **columns) -> pa.Table:
        self.db.register(name, pa.table(columns))
        found = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return found

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Token ids of every word, as little-endian 32-bit numbers."""
        lengths = np.array([len(w) for w in words])
        tokens = self.single[np.frombuffer(b"".join(words), np.uint8)]
        if len(tokens) and tokens.min() < 0:
            raise ValueError("the rank file lacks a byte of the text")
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        found = self._run(ENCODE, "bytes", word=word, pos=pos, token=tokens).column("tokens").combine_chunks()
        ids = found.flatten().to_numpy().astype("<u4").tobytes()
        bounds = (4 * found.offsets.to_numpy()).tolist()
        return [ids[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]

    def contract_long(self, word: bytes) -> bytes:
        """The same contractions, least rank and then leftmost first, with a heap of pairs."""
        ranks, parts = self.ranks, [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))

        def pair(i: int) -> tuple[int, int, bytes] | None:
            both = parts[i] + parts[after[i]] if after[i] < len(parts) else b""
            return (ranks[both], i, both) if both in ranks else None

        heap = [p for i in range(len(parts)) if (p := pair(i))]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            if not parts[i] or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = both, b"", after[gone]
            if after[i] < len(parts):
                before[after[i]] = i
            for at in (before[i], i):
                if at >= 0 and (p := pair(at)):
                    heapq.heappush(heap, p)
        return np.array([ranks[p] for p in parts if p], "<u4").tobytes()

    def cut(self, text: str) -> list[str]:
        """Stretches that no match crosses. All but the first follow a blank that is left out and belongs to their first match."""
        if self.odd.search(text):
            first, *rest = self.starts.split(text)
            return [FIRST + first, *[s[1:] for s in rest]]
        first, *rest = text.split(" ")
        return [FIRST + first, *rest]

    def split(self, stretch: str) -> list[str]:
        """The matches of a stretch."""
        if stretch.isascii() and stretch[:1] != FIRST:
            word = stretch.rstrip(MARKS)
            if word.isalpha():
                return [" " + word, stretch[len(word) :]] if len(word) < len(stretch) else [" " + word]
        return self.pattern.findall(stretch[1:] if stretch[:1] == FIRST else " " + stretch)

    def learn(self, stretches: set[str]) -> None:
        """Encode the stretches that are not known yet."""
        split = {s: self.split(s) for s in stretches}
        fresh = set(chain.from_iterable(split.values())).difference(self.matches)
        todo: list[tuple[str, bytes]] = []
        for match in fresh:
            raw = match.encode()
            if raw in self.ranks:
                self.matches[match] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > LONG:
                self.matches[match] = self.contract_long(raw)
            else:
                todo.append((match, raw))
        for at in range(0, len(todo), WORDS):
            part = todo[at : at + WORDS]
            for (match, _), ids in zip(part, self.contract([raw for _, raw in part]), strict=True):
                self.matches[match] = ids
        for stretch, found in split.items():
            self.known[stretch] = b"".join(map(self.matches.__getitem__, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        for memory in (self.known, self.matches):
            if len(memory) > KNOWN:
                memory.clear()
        cuts = [self.cut(t) for t in texts]
        self.learn(set(chain.from_iterable(cuts)).difference(self.known))
        return [b"".join(map(self.known.__getitem__, c)) for c in cuts]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        lengths = np.array([len(i) // 4 for i in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        out: list[list[bytes]] = [[] for _ in ids]
        # a block of positions at a time: a query holds no more, however long a text is
        for at in range(0, len(flat), POSITIONS):
            part = slice(at, at + POSITIONS)
            found = self._run(DECODE, "tokens", doc=doc[part], pos=np.arange(len(flat[part]), dtype=np.int32), id=flat[part])
            for i, text in zip(found.column("doc").to_pylist(), found.column("text").to_pylist(), strict=True):
                out[i].append(text.encode("latin-1"))
        return [b"".join(parts) for parts in out]


def blocks(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch whose values in ``column`` have about ``most`` bytes together."""
    values = batch.column(column).cast(pa.binary() if pa.types.is_binary(batch.column(column).type) else pa.string())
    sizes = np.cumsum(np.diff(np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]))
    start = 0
    while start < len(values):
        done = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(start, end - start), values.slice(start, end - start).to_pylist()
        start = end


def codec_steps(ranks: dict[bytes, int], pattern: str, steps: tuple[str, ...]):
    """A function over Arrow batches that adds ids to text, or decoded to ids, or both in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern)
        for whole in batches:
            if not whole.num_rows:
                continue
            for batch, values in blocks(whole, "text" if "encode" in steps else "ids", BLOCK):
                names, columns = list(batch.schema.names), list(batch.columns)
                ids = codec.encode([v or "" for v in values]) if "encode" in steps else [v or b"" for v in values]
                if "encode" in steps:
                    columns[names.index("text")] = pa.array(ids, pa.binary())
                    names[names.index("text")] = "ids"
                if "decode" in steps:
                    names.append("decoded")
                    columns.append(pa.array(codec.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _apply(rows: DataFrame, path: str, pattern: str, steps: tuple[str, ...]) -> DataFrame:
    """The rank file has a fixed size, so it travels with the tasks. Columns that the result makes anew are left out."""
    made = [name for name, step in (("ids", "encode"), ("decoded", "decode")) if step in steps]
    rows = rows.drop(*made)
    names, kinds = [], []
    for f in rows.schema.fields:
        names.append("ids" if f.name == "text" and "encode" in steps else f.name)
        kinds.append("binary" if f.name == "text" and "encode" in steps else f.dataType.simpleString())
    if "decode" in steps:
        names.append("decoded")
        kinds.append("binary")
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    return rows.mapInArrow(codec_steps(read_ranks(path), pattern, steps), schema)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ids (little-endian unsigned 32-bit numbers) in place of text."""
    return _apply(docs, path, pattern, ("encode",))


def decode(rows: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``rows`` with decoded, the bytes that ids stand for."""
    return _apply(rows, path, pattern, ("decode",))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Both in one task: ids in place of text, and decoded."""
    return _apply(docs, path, pattern, ("encode", "decode"))

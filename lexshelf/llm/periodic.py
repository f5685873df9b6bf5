"""Periodic runs of words by internal pattern matching.

A run is a stretch with smallest period q, at least max(LEAST, 2 q) words long, that cannot be extended with that period. A run of
period q holds a block of 2^k words that starts at a multiple of 2^k, with 2 * 2^k <= q + 1, and the same block again q words later. So for
every dyadic block the occurrences in the window that its size allows are asked for:

- ranks of all stretches of 2^k words come from prefix doubling, which ends in the suffix array; a block's rank is the start of its
  interval there, and equal ranks make longest common extensions exact in both directions;
- a wavelet matrix over the suffix array answers the range successor: the next place at or after x among the block's occurrences;
- three occurrences with equal gaps of half a block or less are a progression: it is followed to its end at once. If the block
  itself lies in the same progression its members are multiples of a smaller period and are left out, else each is a candidate.

Each candidate is extended to both sides; of equal stretches the smallest period stays. All queries of one block size are
answered together in numpy, over many short texts at once, parted by words that occur nowhere else; a text is never cut. Memory is
about 4 log2(n) bytes a word.

Nulls, empty texts and texts without a word have no run. Every row stands for itself, also with equal or missing ids. An empty table gives an
empty result; columns other than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import texts_of

LEAST = 12
#: Words of short texts that are searched together.
TOGETHER = 1 << 17
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Wavelet:
    """Wavelet matrix over a permutation of 0..n-1; all queries take and return arrays."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            small = np.packbits(zero, bitorder="little")
            packed[: len(small)] = small
            packed = packed.view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(int(zero.sum()))
            values = np.concatenate((values[zero], values[~zero]))

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are less than x."""
        count, over = np.zeros(len(x), np.int64), x >= self.n
        whole = high - low
        for level in range(self.bits):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            a, b = self._rank(level, low), self._rank(level, high)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, self.zeros[level] + low - a, a), np.where(one, self.zeros[level] + high - b, b)
        return np.where(over, whole, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest value of [low, high), from 0."""
        value = np.zeros(len(nth), np.int64)
        for level in range(self.bits):
            a, b = self._rank(level, low), self._rank(level, high)
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            low, high = np.where(one, self.zeros[level] + low - a, a), np.where(one, self.zeros[level] + high - b, b)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value of [low, high) that is x or more; n if there is none."""
        nth = self.below(low, high, x)
        there = nth < high - low
        out = np.full(len(x), self.n, np.int64)
        out[there] = self.smallest(low[there], high[there], nth[there])
        return out


def dyadic_ranks(values: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(ranks, suffix array): ranks[k][i] is where the suffixes begin that share 2^k values with suffix i."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    new = np.append(True, values[order][1:] != values[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, width = [rank.astype(np.int32)], 1
    sizes = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(sizes[rank] > 1)
    while len(open_):
        after = open_ + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        key = rank[open_] * (n + 1) + second + 1
        sort = np.argsort(key, kind="stable")
        open_, key = open_[sort], key[sort]
        old, place = rank[open_], np.arange(len(open_))
        first = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        same = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), place, 0))
        order[old + place - first] = open_
        rank = rank.copy()
        rank[open_] = old + same - first
        ranks.append(rank.astype(np.int32))
        sizes = np.bincount(same, minlength=len(open_))
        open_ = open_[sizes[same] > 1]
        width *= 2
    return ranks, order


def common_after(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many values agree from i and j on; the last value must be unique."""
    n, start = len(ranks[0]), i
    for k in range(len(ranks) - 1, -1, -1):
        step = (ranks[k][np.minimum(i, n - 1)] == ranks[k][np.minimum(j, n - 1)]) << k
        i, j = i + step, j + step
    return i - start


def common_before(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many values agree right before i and j, where i < j."""
    end = i
    for k in range(len(ranks) - 1, -1, -1):
        a = i - (1 << k)
        step = ((a >= 0) & (ranks[k][np.maximum(a, 0)] == ranks[k][np.maximum(j - (1 << k), 0)])) << k
        i, j = i - step, j - step
    return end - i


def _candidates(ranks: list[np.ndarray], wavelet: Wavelet, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(p, q): blocks of 2^level values at p that occur again at p + q, for the periods of this block size."""
    n, size = len(ranks[0]), 1 << level
    rank = ranks[level]
    p = np.arange(0, n - size + 1, size)
    low = rank[p].astype(np.int64)
    high = low + np.bincount(rank, minlength=n)[low]
    some = high - low > 1
    p, low, high = p[some], low[some], high[some]
    x, limit = p + (1 if level == 1 else 2 * size - 1), np.minimum(p + 4 * size - 2, n - 1)
    back1 = back2 = np.full(len(p), -1, np.int64)
    out_p, out_q = [], []
    while len(p):
        found = wavelet.successor(low, high, x)
        some = found <= limit
        p, low, high, limit, back1, back2, found = (v[some] for v in (p, low, high, limit, back1, back2, found))
        out_p.append(p)
        out_q.append(found - p)
        gap = found - back1
        steps = np.flatnonzero((back2 >= 0) & (back1 - back2 == gap) & (2 * gap <= size))
        last = found.copy()
        if len(steps):
            at, r, block = found[steps], gap[steps], p[steps]
            end = at + r + common_after(ranks, at, at + r)
            own = block + r + common_after(ranks, block, block + r)
            final = np.minimum((end - size - at) // r, (limit[steps] - at) // r)
            last[steps] = at + final * r
            many = np.where(own == end, 0, final)
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
            out_p.append(np.repeat(block, many))
            out_q.append(np.repeat(at - block, many) + nth * np.repeat(r, many))
        back2, back1 = np.where(last > found, -1, back1), np.where(last > found, -1, found)
        x = last + 1
    return (np.concatenate(out_p), np.concatenate(out_q)) if out_p else (p, p)


def runs_of(values: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period. The last value must occur once."""
    ranks, suffixes = dyadic_ranks(values)
    none = np.zeros(0, np.int64)
    start, length, period = [none], [none], [none]
    wavelet = Wavelet(suffixes) if len(ranks) > 1 else None
    for level in range(1, len(ranks)):
        p, q = _candidates(ranks, wavelet, level)
        after, before = common_after(ranks, p, p + q), common_before(ranks, p, p + q)
        long = after + before + q >= np.maximum(least, 2 * q)
        start.append((p - before)[long])
        length.append((after + before + q)[long])
        period.append(q[long])
    s, n, q = (np.concatenate(v) for v in (start, length, period))
    order = np.lexsort((q, n, s))
    s, n, q = s[order], n[order], q[order]
    first = np.append(True, (s[1:] != s[:-1]) | (n[1:] != n[:-1]))[: len(s)]
    s, n, q = s[first], n[first], q[first]
    order = np.lexsort((q, s))
    return s[order], n[order], q[order]


class _Numbers(dict):
    """Different words by order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _search(texts: list[bytes], least: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """(runs, collapsed text) of every text; all are searched as one sequence, each ended by a value of its own."""
    words = [t.split() for t in texts]
    numbers = _Numbers()
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes)
    values = np.fromiter(map(numbers.__getitem__, chain.from_iterable(chain(w, (b"",)) for w in words)), np.int64, int(ends[-1]))
    values[ends - 1] = len(numbers) + np.arange(len(words))
    start, length, period = runs_of(values, least)
    owner = np.searchsorted(ends, start, side="right")
    change = np.zeros(len(values) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change) == 0
    edges = np.searchsorted(owner, np.arange(len(words) + 1))
    begins = ends - sizes
    for i, of in enumerate(words):
        part = slice(edges[i], edges[i + 1])
        found = list(zip((start[part] - begins[i]).tolist(), length[part].tolist(), period[part].tolist(), strict=True))
        if found:
            of = [of[at] for at in np.flatnonzero(kept[begins[i] : ends[i] - 1]).tolist()]
        yield found, b" ".join(of)


def _batches(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts with about TOGETHER words, or one longer text."""
    held, size = [], 0
    for text in texts:
        words = len(text) // 6
        if held and size + words > TOGETHER:
            yield held
            held, size = [], 0
        held.append(text)
        size += words
    if held:
        yield held


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) for every row: runs (start, length, period) by start and period, words numbered from 0.

    ``collapsed`` has the words that no run contains after its first period, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _batches(texts_of(batch.column(1))):
                found, left = zip(*_search(texts, least), strict=True)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in each] for each in found]
                collapsed = pa.array(left, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(rows, pa.list_(RUN)), collapsed], ["doc_id", "runs", "collapsed"])
                at += len(texts)

    shape = "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, shape)

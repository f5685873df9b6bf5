"""Bit predictions by online logistic mixing of hashed contexts.

A text (A-Z in lower case) is a row of pieces: white space, word, white space, ..., and an empty word at its end. A piece is
its bytes and one byte that ends it, each byte 8 binary decisions. For every decision, ORDERS contexts inside the piece (the last 1
to 5 bytes, and all bytes so far) are hashed to slots that hold how often either bit came in training. Their log odds are mixed
by weights; a gate, the longest context seen and how often, picks the set of weights. Weights are learned online, bit errors in,
piece after piece, each piece without its own counts. A table by gate and odds, adapted in the same pass, refines the result. Learners of
parts of the pieces are merged: weights by the squared slopes that each gathered, tables by their counts.
Contexts stay within a piece, so equal pieces cost equal bits anywhere and need to be scored once.
"""

from __future__ import annotations

import numpy as np

from lexshelf.llm.substrings import Roller

ORDERS = 6
SLOT_BITS = 20
SEEN = 4
STEPS = 33
RATE = 0.08
#: Log odds are kept between these bounds, as 1 / SCALE of a unit.
MOST, SCALE = 11.0, 2048
DELTA = 0.05
#: Pieces of one step of learning.
STEP = 128
WORD, BLANK = b"w", b"s"


class Bits:
    """All binary decisions of some pieces: which piece, which bit, and the slot of every context."""

    def __init__(self, pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces], np.int64)
        lead = np.full(len(pieces), 5, np.int64)
        spans = lead + sizes
        starts = np.cumsum(spans) - spans
        is_word = np.array([p[:1] == WORD for p in pieces])
        total = int(spans.sum())
        owner = np.repeat(np.arange(len(pieces)), spans)
        inner = np.arange(total) - starts[owner]
        data = np.where(is_word, 32, 0).astype(np.uint8)[owner]
        body = inner >= 5
        ends = inner == spans[owner] - 1
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        firsts = np.cumsum(sizes) - sizes
        keep = np.ones(len(raw), bool)
        keep[firsts] = False
        data[body & ~ends] = raw[keep]
        roller = Roller(total)
        roller.read(data)
        coded = np.flatnonzero(body)
        self.piece = owner[coded]
        self.byte = data[coded]
        flag = np.where(is_word, np.uint64(0x1234567), np.uint64(0x89ABCDE))[self.piece]
        contexts = []
        packed = np.zeros(len(coded), np.uint64)
        for order in range(1, ORDERS):
            packed = (packed << np.uint64(8)) | data[coded - order]
            contexts.append(packed + flag + (np.uint64(order) << np.uint64(56)))
        contexts.append(roller.stretches(starts[self.piece], coded) ^ flag)
        self.contexts = [((c ^ (c >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32) for c in contexts]

    def slots(self, order: int, bit: int) -> np.ndarray:
        node = (np.uint32(1 << bit) | (self.byte >> np.uint8(8 - bit) if bit else np.zeros_like(self.byte))).astype(np.uint32)
        return ((self.contexts[order] ^ (node * np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - SLOT_BITS)

    def bit(self, bit: int) -> np.ndarray:
        return (self.byte >> np.uint8(7 - bit)) & np.uint8(1)


def count(totals: np.ndarray, pieces: list[bytes], counts: np.ndarray, frequent: float) -> None:
    """Add the decisions of all pieces to totals[order, 2 * slot + bit]; whole prefixes only of frequent pieces."""
    if not pieces:
        return
    bits = Bits(pieces)
    weights = counts[bits.piece].astype(np.float64)
    for order in range(ORDERS):
        chosen = weights >= frequent if order == ORDERS - 1 else slice(None)
        places = np.concatenate([(2 * bits.slots(order, b) + bits.bit(b))[chosen] for b in range(8)])
        totals[order] += np.bincount(places, np.tile(weights[chosen], 8), 2 << SLOT_BITS)


def odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + DELTA) / (n0 + DELTA)), -MOST, MOST)


def seen(n: np.ndarray) -> np.ndarray:
    """How often a context was seen: 0 never, then once or twice, up to 30 times, more."""
    return (n > 0.5).astype(np.uint8) + (n > 2.5) + (n > 30.5)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def gate(levels: list[np.ndarray]) -> np.ndarray:
    """The longest context that was seen, and how often."""
    found = np.zeros(len(levels[0]), np.uint8)
    for order, level in enumerate(levels):
        found = np.where(level > 0, np.uint8(SEEN * order) + level, found)
    return found


class Learner:
    """Mixing weights by gate and the refining table, learned online from pieces."""

    def __init__(self):
        self.weights = np.full((SEEN * ORDERS, ORDERS), 1.6 / ORDERS)
        self.squares = np.full_like(self.weights, 1e-3)
        centres = squash((np.arange(STEPS) - STEPS // 2) * (2 * MOST / (STEPS - 1)))
        self.hits = np.tile(20 * centres, (SEEN * ORDERS, 1))
        self.tries = np.full((SEEN * ORDERS, STEPS), 20.0)

    def learn_all(self, totals: np.ndarray, pieces: list[tuple[bytes, int]], frequent: float) -> None:
        for at in range(0, len(pieces), STEP):
            self.learn(totals, pieces[at : at + STEP], frequent)

    def state(self) -> bytes:
        return np.concatenate([x.ravel() for x in (self.weights, self.squares, self.hits, self.tries)]).tobytes()

    @staticmethod
    def merged(states: list[bytes]) -> Learner:
        """One learner for those of several parts, whatever their number; without any, the one before learning."""
        out, parts = Learner(), []
        shapes = [x.shape for x in (out.weights, out.squares, out.hits, out.tries)]
        ends = np.cumsum([a * b for a, b in shapes])
        for state in states:
            split = np.split(np.frombuffer(state, np.float64), ends[:-1])
            parts.append([x.reshape(shape) for x, shape in zip(split, shapes, strict=True)])
        if parts:
            out.weights = sum(w * q for w, q, _, _ in parts) / sum(q for _, q, _, _ in parts)
            out.squares = sum(q for _, q, _, _ in parts)
            first = Learner()
            out.hits = first.hits + sum(h - first.hits for _, _, h, _ in parts)
            out.tries = first.tries + sum(t - first.tries for _, _, _, t in parts)
        return out

    def learn(self, totals: np.ndarray, part: list[tuple[bytes, int]], frequent: float) -> None:
        """One step of online learning, with the counts that the rest of the corpus gives."""
        bits = Bits([p for p, _ in part])
        own = np.array([n for _, n in part], np.float32)[bits.piece]
        x, levels = [], []
        bit = np.concatenate([bits.bit(b) for b in range(8)])
        own = np.tile(own, 8)
        for order in range(ORDERS):
            slots = np.concatenate([bits.slots(order, b) for b in range(8)])
            n0, n1 = totals[order].reshape(-1, 2)[slots].T
            mine = np.where(own >= frequent, own, 0) if order == ORDERS - 1 else own
            n0 = np.maximum(0, n0 - np.where(bit, 0, mine))
            n1 = np.maximum(0, n1 - np.where(bit, mine, 0))
            x.append(odds(n0, n1))
            levels.append(seen(n0 + n1))
        gates, x = gate(levels), np.array(x)
        mixed = np.clip((self.weights[gates].T * x).sum(axis=0), -MOST, MOST)
        gain = np.minimum(own, 20) ** 0.5 * (bit - squash(mixed))
        slope = np.stack([np.bincount(gates, gain * odd, len(self.weights)) for odd in x], axis=1)
        self.squares += slope**2
        self.weights += RATE * slope / np.sqrt(self.squares)
        step = np.round((mixed + MOST) * (STEPS - 1) / (2 * MOST)).astype(np.int64)
        places = gates.astype(np.int64) * STEPS + step
        self.hits += np.bincount(places, bit, self.hits.size).reshape(self.hits.shape)
        self.tries += np.bincount(places, minlength=self.tries.size).reshape(self.tries.shape)


class Model:
    """Slots as log odds and level in one number, mixing weights by gate, and the refining table."""

    def __init__(self, totals: np.ndarray, pieces: list[tuple[bytes, int]], frequent: float, learner: Learner | None = None):
        """Learns from ``pieces``, after what a ``learner`` has learned, if one is given."""
        learner = learner or Learner()
        learner.learn_all(totals, pieces, frequent)
        self.weights = learner.weights
        n0, n1 = totals[:, ::2], totals[:, 1::2]
        self.table = (np.round(odds(n0, n1) * SCALE).astype(np.int32) << 2) | seen(n0 + n1)
        self.refined = learner.hits / learner.tries

    def score(self, pieces: list[bytes]) -> np.ndarray:
        """log10 of the probability of every piece."""
        if not pieces:
            return np.zeros(0)
        bits = Bits(pieces)
        weights = self.weights.astype(np.float32) / SCALE
        refined = self.refined.astype(np.float32)
        total = np.zeros(len(pieces))
        for b in range(8):
            entries = [self.table[order][bits.slots(order, b)] for order in range(ORDERS)]
            gates = gate([(e & 3).astype(np.uint8) for e in entries])
            mixed = np.zeros(len(gates), np.float32)
            for order, entry in enumerate(entries):
                mixed += weights[gates, order] * (entry >> 2)
            np.clip(mixed, -MOST, MOST, out=mixed)
            step = ((mixed + MOST) * ((STEPS - 1) / (2 * MOST)) + 0.5).astype(np.int64)
            p = 0.5 * (squash(mixed) + refined[gates, step])
            p = np.where(bits.bit(b) == 1, p, 1 - p)
            total += np.bincount(bits.piece, np.log10(np.maximum(p, 1e-7)), len(pieces))
        return total

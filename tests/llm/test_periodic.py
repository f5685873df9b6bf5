"""Periodic runs against brute force over all periods."""

import random

import numpy as np
import pytest

from lexshelf.llm import periodic


def plain_runs(words, least=periodic.LEAST):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                best.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(kind, rng):
    size = rng.randint(0, 110)
    if kind < 3:
        return [rng.randint(0, kind) for _ in range(size)]
    if kind == 3:
        unit = [0] * rng.randint(1, 40) + [1]
        return (unit * rng.randint(1, 4) + [0] * rng.randint(0, 40)) * rng.randint(1, 3)
    out = []
    while len(out) < size:
        out += [rng.randint(0, 2) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
    return out


@pytest.mark.parametrize("kind", range(5))
def test_runs_against_brute_force(kind):
    rng = random.Random(kind)
    for _ in range(250):
        words = words_of(kind, rng)
        got = [v.tolist() for v in periodic.runs_of(np.array(words + [99]))]
        assert list(zip(*got)) == plain_runs(words), words


def test_wavelet_successor():
    rng = random.Random(2)
    for n in (1, 2, 63, 64, 65, 130):
        values = list(range(n))
        rng.shuffle(values)
        tree = periodic.Wavelet(np.array(values))
        for _ in range(100):
            low = rng.randint(0, n)
            high, x = rng.randint(low, n), rng.randint(0, n + 2)
            want = min((v for v in values[low:high] if v >= x), default=n)
            assert tree.successor(np.array([low]), np.array([high]), np.array([x])).tolist() == [want]


def test_long_repetition():
    unit = np.arange(700)
    values = np.concatenate([np.array([9000]), np.resize(unit, 200_000), np.array([9001])])
    assert [v.tolist() for v in periodic.runs_of(values)] == [[1], [200_000], [700]]


def test_operator_with_odd_rows(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a " * 12, "a " * 11, "x " + "a b c " * 5 + "y", "é   " * 8, "a b " * 40000]
    texts += [" ".join(map(str, words_of(kind, rng))) for kind in range(5)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "q " * 13, "x"), (3, "a " * 12, "x"), (3, "a " * 12, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()]
    want = []
    for doc, text, _ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        found = [(0, 80000, 2)] if doc == 7 else plain_runs(words)
        want.append((doc, found, collapsed(words, found)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic.periodic_runs(docs.where("false")).collect() == []

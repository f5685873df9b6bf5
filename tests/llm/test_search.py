"""Ranked search by max-sketches against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from lexshelf.llm import search

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(docs, items, k):
    found = [(d, PATTERN.findall(lower(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(t for _, ts in found for t in set(ts))
    out = set()
    for item, text in items:
        scores = []
        for doc, ts in found:
            tf, m = Counter(ts), 25 + 75 * len(ts) * n_docs // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in PATTERN.findall(lower(text))
                if tf[t]
            )
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out |= {(item, r, doc, -score) for r, (score, doc) in enumerate(sorted(scores)[:k], 1)}
    return out


def corpus(rng, rows, vocabulary):
    words = [f"w{i}" for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(vocabulary)], k=rng.randint(0, 60)))) for i in range(rows)]


@pytest.mark.parametrize("slots, block", [(4096, 1 << 22), (3, 1 << 22), (16, 200)])
def test_against_plain_scores(spark, slots, block):
    rng = random.Random(slots)
    docs = corpus(rng, 150, 80)
    docs += [(1000 + i, docs[i % 20][1]) for i in range(60)] + [(None, docs[3][1]), (7, docs[3][1])]
    docs += [(2000, None), (2001, ""), (2002, "-- !"), (2003, "W1 w2-W3_Ää " * 3000)]
    items = [(i, t) for i, t in corpus(rng, 25, 90)] + [(30, None), (31, ""), (32, "Ää w1 w1"), (33, "unknown")]
    left = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, score int").repartition(5)
    right = spark.createDataFrame([(d, t, 0) for d, t in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in search.ranked(left, right, slots=slots, block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(docs, items, 10)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a")], "item_id string, text string")
    got = search.ranked(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and [r.doc_id for r in got.collect()] == [1]
    assert search.ranked(docs.where("false"), items).collect() == []
    assert search.ranked(docs, items.where("false")).collect() == []


def test_rescoring_stops_at_the_threshold():
    import numpy as np

    bounds = np.array([100, 90, 80, 70, 60, 50])
    best, asked = [], []

    def exact(at):
        asked.append(at)
        return int(bounds[at]) - 15

    search.best_of(best, bounds, np.arange(6), exact, 2)
    assert asked == [0, 1, 2] and sorted(best) == [(75, -1), (85, 0)]

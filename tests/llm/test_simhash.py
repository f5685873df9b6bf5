"""SimHash near-duplicates against brute force."""

import random

import pytest
import xxhash

from lexshelf.llm import components, simhash
from lexshelf.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, bits=3):
    """[(doc_id, fp)] -> least doc_id that can be reached, by comparing all with all."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, (doc, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), doc), doc)
    return [best[find(i)] for i in range(len(rows))]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [(d, plain_fingerprint(t)) for d, t in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(rows, plain_classes(rows))}
    assert {tuple(r) for r in QUERIES["op8_simhash"](spark, sf).collect()} == want


@pytest.mark.parametrize("hot", [4096, 2])
def test_close_fingerprints_meet_also_in_large_groups(spark, hot):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(25):
            s ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(s)
    rows = sorted(enumerate(fps))
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for _, f in rows], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(frame, hot)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for _, f in rows]
    want = plain_classes([(s, f) for s, (_, f) in zip(signed, rows)])
    assert [found.get(s, s) for s in signed] == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", None), (3, " \n", "x"), (None, "a b", "x"), (4, "a b", "x"), (4, "a b", "x"), (5, "A B", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect()))
    assert got == [(0, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 4]
    assert simhash.near_duplicates(docs.where("false")).collect() == []


def test_chains_of_links(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(chain).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}

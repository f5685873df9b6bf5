"""Near-duplicates by the signature join against comparison of all pairs of sets."""

import random

import pytest

from lexshelf.llm import minhash
from lexshelf.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, database


def plain_set(text, words):
    parts = (text or "").encode().lower().split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def plain_classes(rows, words):
    """{(doc_id, n_shingles, component_id)} by comparing all with all."""
    sets = [plain_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            best[find(i)] = min(best.get(find(i), doc), doc)
    return sorted(((d, len(sets[i]), best.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def families(rng, count, size, rates):
    """Texts with many near copies of themselves, and a passage that all share."""
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    out = []
    for _ in range(count):
        base = rng.choices(vocabulary, k=rng.randint(15, 120))
        base = base + passage if rng.random() < 0.5 else base
        for _ in range(size):
            rate = rng.choice(rates)
            out.append(" ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in base))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("words, shingles_each, sets_each", [(2, 1 << 18, 512), (2, 900, 5), (5, 1 << 18, 512), (5, 3000, 4)])
def test_against_brute_force(spark, words, shingles_each, sets_each):
    rng = random.Random(words * sets_each)
    texts = families(rng, 6, 40, [0, 0.01, 0.03, 0.06, 0.1]) + families(rng, 60, 3, [0.02, 0.08])
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = minhash.near_duplicates(docs, words, shingles_each, sets_each).collect()
    assert sorted(map(tuple, got), key=str) == plain_classes(rows, words)


def test_large_family_without_its_first_text(spark):
    """Islands around one large class: all are looked at, none is linked wrongly, no link is lost."""
    rng = random.Random(4)
    rows = list(enumerate(families(rng, 1, 500, [0.02, 0.04, 0.05, 0.07])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, minhash.near_duplicates(docs, 2, 4000, 40).collect()), key=str)
    want = plain_classes(rows, 2)
    assert got == want and len({r[2] for r in want}) > 10


def test_query_against_twin(spark):
    sf = "/root/testdata/sf0.01"
    ok, message = compare(database(sf), spark, sf, QUERIES["op12_minhash"], ORACLES["op12_minhash"])
    assert ok, message


def test_odd_rows(spark):
    long = "x y " * 100_000
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a b"), (4, "A B"), (5, "A"), (6, "a"), (None, "only here"), (7, long), (8, long + "z")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, keys int")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == plain_classes(rows, 2)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 4, 5, 7, 8]
    assert minhash.near_duplicates(docs.where("false")).collect() == []


def test_sets_of_repeated_rows(spark, monkeypatch, capsys):
    """One set for each node, though a doc_id has its text twice; and whole sets are not moved to see to that."""
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "A b  c d"), (2, "e f g"), (2, "other words"), (None, "h i j"), (None, "h i j"), (3, "k l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = [(n, minhash.hash_of(minhash.shingles(t.encode(), 2, minhash._Words())), d) for n, (d, t) in enumerate([rows[0], rows[3], rows[5], rows[7]])]
    nodes = spark.createDataFrame([(n, bytearray(h), d) for n, h, d in wanted], "node long, hash binary, least long")
    plans = []

    def seen(df, cut=minhash.cut):
        if "found" in df.columns:
            capsys.readouterr()
            df.explain()
            plans.append(capsys.readouterr().out)
        return cut(df)

    monkeypatch.setattr(minhash, "cut", seen)
    got = minhash._sets_of(docs, nodes, nodes.select("node").where("node < 3"), 2).collect()
    assert sorted((r.node, len(r.found)) for r in got) == [(0, 3), (1, 2), (2, 2)]
    assert plans and not any("hashpartitioning(node" in p for p in plans)

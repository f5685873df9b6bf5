"""Removal of repeated byte strings against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from lexshelf.llm import substrings
from lexshelf.llm.queries import QUERIES


def plain(rows, length=100):
    """{doc_id: (bytes, removed bytes, runs, kept)}; one row per doc_id."""
    first, out = {}, {}
    rows = sorted((d, (t or "").encode()) for d, t in rows)
    for d, t in rows:
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], (d, i))
    for d, t in rows:
        gone = [False] * len(t)
        reach = 0
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] != (d, i):
                for j in range(max(i, reach), i + length):
                    gone[j] = True
                reach = i + length
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(t), sum(gone), n_spans, bytes(b for b, g in zip(t, gone) if not g))
    return out


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, (n, r, s, k) in plain(rows).items()}
    assert {tuple(r) for r in QUERIES["op2_substrings"](spark, sf).collect()} == want


@pytest.mark.parametrize("hot", [2048, 3])
def test_copies_passages_and_periods(spark, hot):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, whole = text(60), text(150)
    docs = [(i, text(rng.randint(0, 60)) + passage[rng.randint(0, 9) :] + text(rng.randint(0, 50))) for i in range(25)]
    docs += [(100 + i, whole) for i in range(4)] + [(200, "ab" * 300), (201, "x" * 500), (202, "ba" * 200 + whole + "x" * 100)]
    docs += [(203, None), (204, ""), (205, whole[:99]), (206, whole[:100]), (-7, passage)]
    rng.shuffle(docs)
    want = plain(docs)
    got = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), hot=hot).collect()
    for r in got:
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), bytes(r.kept)) == want[r.doc_id], r.doc_id
    assert len(got) == len(docs)


def test_blocks_of_one_long_text(spark):
    rng = random.Random(9)
    line = "".join(rng.choice("abcdefgh ") for _ in range(700))
    long = "".join(rng.choice("abcdefghijkl ") for _ in range(substrings.BLOCK - 300)) + line + "".join(rng.choice("xyz") for _ in range(400_000))
    docs = [(1, long), (2, line), (3, long[-5000:])]
    got = {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (len(long), long.encode()), 2: (700, b""), 3: (5000, b"")}


def test_odd_rows(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(None, text, 1), (1, text, 2), (1, text, 3), (2, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = substrings.remove_repeats(docs).toDF("doc_id", "extra", "kept", "removed", "n_bytes").collect()
    assert sorted((r.extra, len(r.kept)) for r in got) == [(1, 150), (2, 0), (3, 0), (4, 0)]
    assert substrings.remove_repeats(docs.where("false").drop("kept")).collect() == []


def test_suffix_ranks():
    data = np.frombuffer(b"banana bandana banana bandana" * 3, np.uint8)
    rank = substrings.suffix_ranks(data, 20)
    text = data.tobytes()
    usable = range(len(text) - 20)
    assert sorted(usable, key=lambda i: (rank[i], i)) == sorted(usable, key=lambda i: (text[i : i + 20], i))


def test_single_windows_are_handed_on_in_parts():
    rng = random.Random(6)
    texts = [bytes(rng.choices(b"abcdefgh", k=400)) for _ in range(60)]
    wanted = [[{"off": 0, "n": 301, "key": 1, "single": True}] for _ in texts]
    kind = pa.list_(pa.struct([("off", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("single", pa.bool_())]))
    squeezed = [zstandard.ZstdCompressor().compress(t) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(squeezed, pa.binary()), pa.array(wanted, kind)], ["doc", "packed", "wanted"])

    def peak(**options):
        tracemalloc.start()
        rows = sum(b.num_rows for b in substrings._phrase_texts(100, **options)(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return rows, most

    (rows, most), (all_rows, all_most) = peak(held=1000), peak()
    assert rows == all_rows == 60 * 301 and 3 * most < all_most


def test_repeats_within_a_batch_are_dealt_out_once():
    """A batch writes as many rows as it has repeated phrases at most, not one for every part, and ranks agree with sorting."""
    rng = random.Random(8)
    text = bytes(rng.choices(b"abcdefgh", k=900)).decode()
    batch = pa.RecordBatch.from_arrays([pa.array([3, 1, 2], pa.int64()), pa.array([text, "x", text])], ["doc", "text"])
    rows = [r for b in substrings._parse_docs(100, 32, 5000)(iter([batch])) for r in b.to_pylist()]
    later = [r for r in rows if not r["h"]]
    fresh = sum(len(r["h"]) // 8 for r in rows)
    assert len(later) == fresh and {int.from_bytes(r["doc"], "little") for r in later} == {3}
    data = np.frombuffer(bytes(rng.choices(b"ab", k=700)) + b"ab" * 60 + b"a" * 90, np.uint8)
    rank, raw = substrings.suffix_ranks(data, 100), data.tobytes()
    usable = [raw[i : i + 100] for i in range(len(raw) - 99)]
    for i in range(0, len(usable), 7):
        assert [rank[j] < rank[i] for j in range(len(usable))] == [t < usable[i] for t in usable]

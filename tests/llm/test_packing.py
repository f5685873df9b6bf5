"""Packed rows: an exact round trip, and best fit against a plain search."""

import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from lexshelf.llm import packing
from lexshelf.llm.bpe import read_ranks
from lexshelf.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_best_fit(lengths, width):
    rows, room = [], []
    for i, n in enumerate(lengths):
        fits = [r for r in range(len(rows)) if room[r] >= n]
        if fits:
            best = min(fits, key=lambda r: room[r])
            rows[best].append(i)
            room[best] -= n
        else:
            rows.append([i])
            room.append(width - n)
    return rows, room


def test_best_fit_against_a_plain_search():
    rng = random.Random(3)
    for width in (1, 7, 64, 100):
        lengths = sorted((rng.randint(1, width) for _ in range(300)), reverse=True)
        got = packing.best_fit(lengths, width)
        want, room = plain_best_fit(lengths, width)
        assert sorted(i for r in got for i in r) == list(range(300))
        assert all(sum(lengths[i] for i in r) <= width for r in got)
        assert len(got) == len(want)
        assert sorted(width - sum(lengths[i] for i in r) for r in got) == sorted(room)


def unpacked(rows, kind="<u2"):
    docs = {}
    for r in rows:
        ids = np.frombuffer(r.ids, kind)
        assert r.cu_seqlens[-1] == r.n_tokens <= len(ids) and r.resets == r.cu_seqlens[:-1]
        assert (ids[r.n_tokens :] == 50256).all()
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            docs.setdefault(doc, []).append((start, ids[a:b].tolist()))
    return docs


def test_query_is_lossless(spark):
    sf = "/root/testdata/sf0.001"
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
    want = {r.doc_id: library.encode_ordinary(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text}
    rows = QUERIES["op10_packed_ids"](spark, sf).collect()
    got = unpacked(rows)
    assert {d: [i for _, part in sorted(parts) for i in part] for d, parts in got.items()} == want
    assert all(len(part) <= packing.WIDTH for parts in got.values() for _, part in parts)
    assert sum(r.n_tokens for r in rows) > 0.95 * packing.WIDTH * (len(rows) - 1)


def test_odd_rows(spark, tmp_path):
    docs = [(1, None), (2, ""), (None, "a b c"), (3, "word " * 5000), (3, "word " * 5000), (4, "<|endoftext|>")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS lane", "2 AS ids").repartition(2)
    rows = packing.packed(frame, PATH, width=64, lane=1000)
    packing.write_matrix(rows, str(tmp_path / "matrix"))
    got = unpacked(spark.read.parquet(str(tmp_path / "matrix")).collect())
    assert set(got) == {None, 3, 4}
    assert sorted(s for s, _ in got[3]) == sorted(2 * list(range(0, sum(len(p) for _, p in got[3]) // 2, 64)))
    assert packing.packed(frame.where("false"), PATH).collect() == []


@pytest.mark.parametrize("ends,width", [([0, 2, 5], 5), ([0, 2, 5], 8), ([0, 4], 4)])
def test_positions(ends, width):
    want = [i - max(e for e in ends if e <= i) for i in range(width)]
    assert packing.positions(ends, width).tolist() == want

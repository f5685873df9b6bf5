"""BPE by DuckDB against the tokenizer library, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lexshelf.llm import bpe
from lexshelf.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.add((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op9_byte_bpe"](spark, sf).collect()} == want


def test_odd_texts_against_the_library(library):
    rng = random.Random(2)
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    signs = ["a", "Zq", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", " ", "　", " ", "'s", "'re", "'", "9", "½", "٣", "é", "漢字", "🙂", "é", "_", "!!", "\x00", "ǅ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["", " ", "  ", "a ", " a", "\n\n a  ", "ab" * 400, "x" * 1000, "=" * 301, " " * 500, "the " * 500]
    ids = codec.encode(texts)
    for text, found in zip(texts, ids):
        assert np.frombuffer(found, "<u4").tolist() == library.encode_ordinary(text), repr(text)
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "a b", None), (2, "word " * 30000, "y")], "doc_id long, text string, decoded string")
    made = bpe.encode(docs.drop("decoded"), PATH)
    assert made.columns == ["doc_id", "ids"]
    back = {(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(made, PATH).collect()}
    assert back == {(1, ""), (None, "a b"), (2, "word " * 30000)}
    assert bpe.round_trip(docs.where("false").drop("decoded"), PATH).collect() == []


def test_long_text_and_clashing_columns(spark):
    """32 MB in one text; columns that the result makes anew are left out."""
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = "the word " * 3_600_000
    ids = codec.encode([text, "a"])
    assert codec.decode([ids[0], b"", ids[1]]) == [text.encode(), b"", b"a"]
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, ids string, decoded string")
    found = bpe.round_trip(docs, PATH)
    assert found.columns == ["doc_id", "ids", "decoded"] and bytes(found.first().decoded) == b"a b"
    assert bpe.encode(docs, PATH).columns == ["doc_id", "ids", "decoded"]

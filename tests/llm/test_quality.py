"""Quality rules against plain Python, and the posterior against labels."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from lexshelf.llm import quality
from lexshelf.llm.queries import QUERIES


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_quality"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in BASE) == plain(texts[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)


def test_odd_texts(spark):
    eight = " ".join("abcdefgh")
    texts = [None, "", " \n\t", "é\x0bé\x85x a", "a\nb\na\n\na", f"{eight} {eight} x", f"{eight} y {eight}", "z " * 40, "# <b>|", "a b c d e f g h i " * 3, "\r\nx\r\n\r\nx\r\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judged(docs).collect():
        assert tuple(r[c] for c in BASE) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert not r.kept
    assert quality.judged(docs.where("false")).collect() == []


def plain_em(patterns, rounds):
    import math

    n_rules = len(patterns[0][0])
    share, good, bad = quality.PRIOR_GOOD, [quality.GOOD_RIGHT] * n_rules, [quality.BAD_RIGHT] * n_rules
    odds = lambda cast: math.log(share / (1 - share)) + sum(
        math.log(g / (1 - b)) if v else math.log((1 - g) / b) for v, g, b in zip(cast, good, bad) if v is not None
    )
    for _ in range(rounds):
        r = [1 / (1 + math.exp(-odds(cast))) for cast, _ in patterns]
        k = quality.PRIOR_VOTES
        new = []
        for j in range(n_rules):
            voted = [(cast[j], n, p) for (cast, n), p in zip(patterns, r) if cast[j] is not None]
            sure = sum(n * p for v, n, p in voted)
            g = (sum(n * p for v, n, p in voted if v) + (k + sure) * quality.GOOD_RIGHT) / (2 * sure + k)
            b = (sum(n * (1 - p) for v, n, p in voted if not v) + k * quality.BAD_RIGHT) / (sum(n * (1 - p) for v, n, p in voted) + k)
            new.append((g, b))
        share = (sum(n * p for (_, n), p in zip(patterns, r)) + k * quality.PRIOR_GOOD) / (sum(n for _, n in patterns) + k)
        good, bad = zip(*new)
    return [1 / (1 + math.exp(-odds(cast))) for cast, _ in patterns]


def test_estimates_against_plain_em(spark):
    patterns = [((True, True, None), 70.0), ((True, False, True), 9.0), ((False, False, None), 15.0), ((False, True, False), 6.0), ((None, None, None), 3.0)]
    one = spark.createDataFrame([([(list(c), n) for c, n in patterns],)], "p array<struct<cast:array<boolean>,n:double>>")
    weighed = one.select("p", quality.estimated(F.col("p"), 3, 7).alias("w"))
    got = weighed.select(F.transform("p", lambda p: quality.posterior(p["cast"], F.col("w"))).alias("r")).first().r
    assert got == pytest.approx(plain_em(patterns, 7))


def test_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "good")
    found = QUERIES["op5_quality"](spark, sf).join(labels, "doc_id").collect()
    share = lambda rows: sum(r.kept for r in rows) / len(rows)
    assert share([r for r in found if r.good == 1 and not r.base_failed]) > 0.98
    assert share([r for r in found if r.good == 0]) < 0.25


def test_the_stage_returns_its_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("kept", F.lit(1)).withColumn("words", F.lit(2))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and 100 < kept.count() < 200

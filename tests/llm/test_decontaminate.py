"""Benchmark passages against brute-force alignment."""

import random
import re

import numpy as np

from lexshelf.llm import decontaminate
from lexshelf.llm.queries import QUERIES


def least_edits(pattern, text):
    """Least edits between the pattern and any stretch of the text."""
    last = np.zeros(len(text) + 1, np.int64)
    codes = np.array([ord(c) for c in text])
    steps = np.arange(len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = np.append(i, np.minimum(last[:-1] + (codes != ord(c)), last[1:] + 1))
        last = np.minimum.accumulate(row - steps) + steps
    return int(last.min())


def plain_text(text):
    return "".join(" " if c.isspace() else c.lower() if len(c.lower()) == 1 else c for c in text or "")


def segments(text):
    size, text = decontaminate.SEGMENT, plain_text(text)
    last = max(0, len(text) - size)
    for at in sorted({*range(0, last + 1, size // 2), last}) if len(text) >= decontaminate.Q else []:  # shorter: see brute
        part = text[at : at + size]
        yield part, min(int(decontaminate.RATE * len(part)), (len(part) - decontaminate.Q) // decontaminate.Q)


def brute(docs, items):
    out = set()
    for d, text in docs:
        for i, item in items:
            if any(least_edits(part, plain_text(text)) <= most for part, most in segments(item)):
                out.add((d, i))
            if 0 < len(item) < decontaminate.Q and re.search(rf"(?<![^\W_]){re.escape(plain_text(item))}(?![^\W_])", plain_text(text)):
                out.add((d, i))
    return out


def test_query_against_exact_substrings_and_alignment(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, sf).collect()}
    assert {(d, i) for d, t in docs for i, x in items if x in (t or "")} <= got
    some = [(d, t[:1500]) for d, t in docs[::9]]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    found = decontaminate.passages(frame, spark.read.parquet(f"{sf}/benchmark.parquet").limit(12))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == brute(some, items[:12])


def test_edited_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(4, 50))) for i in range(20)] + [(30, "short"), (31, None), (32, "")]
    docs = []
    for n in range(80):
        chars = list(items[n % 20][1])
        for _ in range(int(len(chars) * rng.choice([0, 0.03, 0.08, 0.1, 0.15]))):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "\n"])
        docs.append((n, text(rng.randint(0, 30)) + "".join(chars).upper() + text(rng.randint(0, 30))))
    docs += [(100, None), (101, ""), (102, items[3][1][:60])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.passages(frame, bench).collect()
    want = brute(docs, [(i, t) for i, t in items if t])
    assert {(r.doc_id, r.item_id) for r in rows} == want
    texts = dict(docs)
    assert all(0 <= r.start < r.end <= len(texts[r.doc_id]) for r in rows)
    clean = decontaminate.keep_clean(frame, bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(texts) - {d for d, _ in want})


def test_blocks_and_slices(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(30))) for i in range(6)]
    filler = "".join(rng.choice("hijklmno ") for _ in range(1_300_000))
    cuts = [524_000, 524_288, 900_000]
    text = filler[: cuts[0]] + items[0][1] + filler[cuts[0] : cuts[1]] + items[1][1] + filler[cuts[1] :]
    frame = spark.createDataFrame([(1, text), (2, items[5][1]), (None, items[4][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "SLICE", 400)
    got = {(r.doc_id, r.item_id): (r.start, r.end) for r in decontaminate.passages(frame, bench).collect()}
    assert got[1, 0] == (cuts[0], cuts[0] + len(items[0][1]))
    assert set(got) == {(1, 0), (1, 1), (2, 5), (None, 4)}
    assert decontaminate.keep_clean(frame, bench).collect() == []


def test_texts_that_begin_or_end_inside_an_item(spark):
    rng = random.Random(5)
    item = "".join(rng.choice("abcdefgh ") for _ in range(100))
    clean = "".join(rng.choice("ijklmnop ") for _ in range(300))
    docs = []
    for cut in range(1, 11):
        docs += [(len(docs), clean), (len(docs) + 1, item[cut:]), (len(docs) + 2, ""), (len(docs) + 3, item[:-cut]), (len(docs) + 4, None), (len(docs) + 5, item[cut:] + clean)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(7, item), (8, "\0" * 40)], "item_id long, text string")
    want = {d: t for d, t in docs if t and t[:20] in item}
    rows = decontaminate.passages(frame, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(d, 7) for d in sorted(want)]
    assert all(0 <= r.start < r.end <= len(want[r.doc_id]) for r in rows)
    assert sorted(r.doc_id for r in decontaminate.keep_clean(frame, bench).collect()) == sorted({d for d, _ in docs} - set(want))


def test_short_items_are_found_exactly(spark):
    docs = [(0, "Answer"), (1, "the answer."), (2, "answers"), (3, "an swer"), (4, "4 + 4 = 8"), (5, "48"), (6, "x\nyes no"), (7, None), (8, "reanswer answer_")]
    items = [(1, "answer"), (2, "8"), (3, "yes\tno"), (4, "?"), (5, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.passages(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 1), (1, 1), (4, 2), (6, 3), (8, 1)} == brute(docs, items)
    assert {(r.start, r.end) for r in rows if r.doc_id == 1} == {(4, 10)}
    assert {r.doc_id for r in decontaminate.keep_clean(frame, bench).collect()} == {2, 3, 5, 7}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text that is long enough", "y")], "doc_id long, text string, item_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.passages(docs, none).collect() == []
    assert decontaminate.keep_clean(docs, none).columns == docs.columns
    assert decontaminate.passages(docs.where("false"), docs.selectExpr("1L item_id", "text")).collect() == []

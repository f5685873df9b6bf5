"""Licence scans against brute force over all blocks."""

import random
import re
import time

from lexshelf.llm import licenses
from lexshelf.llm.queries import QUERIES


def tokens(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, threshold=licenses.THRESHOLD):
    words = tokens(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    blocks = set()
    for label, notice in licenses.NOTICES:
        n, wanted, group = len(tokens(notice)), set(tokens(notice)), []
        for start in range(len(words)):
            if words[start] not in wanted:
                continue
            shared = len(wanted & set(words[start : start + 2 * n]))
            if shared >= threshold * len(wanted) - 1e-9:
                if group and start >= group[-1][1] + 2 * n:
                    blocks.add((label, *min(group)[1:]))
                    group = []
                group.append((-shared, start, shared / len(wanted)))
        if group:
            blocks.add((label, *min(group)[1:]))
    starts = [i for i, _ in places]
    base = {label for _, label in places}
    best = max([c for *_, c in blocks] + [1.0] * bool(places), default=0.0)
    row = (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {b[0] for b in blocks})), best)
    return row, blocks


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op4_licenses"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == brute(texts[r.doc_id])[0]
    assert any("cc-by-nc" in r.labels for r in rows)


def test_damaged_notices(spark):
    rng = random.Random(6)
    docs = [(None, "MIT License, MIT license"), (1, None), (2, ""), (3, "été License 2.0"), (4, "x " * 50_000 + "Apache-License"), (4, "the GENERAL PUBLIC LICENSE")]
    for i in range(60):
        words = licenses.NOTICES[i % len(licenses.NOTICES)][1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["the", "software", "zzz", "license"])
        docs.append((10 + i, "filler " * rng.randint(0, 40) + "\n".join(words) + " more" * rng.randint(0, 40)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    rows = licenses.scan(frame).collect()
    assert len(rows) == len(docs)
    key = lambda r: (r[0] is None, r[0], str(r[1:]))
    got = sorted([(r.doc_id, tuple(r)[1:8], sorted((b.label, b.start, b.containment) for b in r.blocks)) for r in rows], key=key)
    want = sorted([(d, brute(t)[0], sorted(brute(t)[1])) for d, t in docs], key=key)
    assert got == want
    assert sum(bool(w[2]) for w in want) > 20
    assert licenses.scan(frame.where("false")).collect() == []


def test_stretched_notices_are_found_at_every_offset():
    templates = licenses.Templates(licenses.NOTICES, {}, licenses.THRESHOLD)
    words = tokens(licenses.NOTICES[1][1])
    stretched = [w for i, w in enumerate(words) for w in ([w, "zzz"] if i % 2 else [w])]
    for offset in range(45):
        found = [t.label for t, *_ in templates.found([w.encode() for w in ["filler"] * offset + stretched])]
        assert "mit" in found, offset


def test_long_texts_full_of_notices():
    text = " ".join(notice for _, notice in licenses.NOTICES).encode() + b" "
    words = licenses.words_of(text * (1_000_000 // len(text)))
    started = time.perf_counter()
    found = list(licenses.Templates(licenses.NOTICES, {}, licenses.THRESHOLD).found(words))
    assert {t.label for t, *_ in found} == {label for label, _ in licenses.NOTICES}
    assert time.perf_counter() - started < 20

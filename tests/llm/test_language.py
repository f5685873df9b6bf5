"""Language identification: filters against plain sets, and held-out accuracy."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa

from lexshelf.llm import language
from lexshelf.llm.queries import QUERIES


def plain_grams(text):
    raw = bytearray((text or "").encode())
    out = bytearray()
    for i, b in enumerate(raw):
        if 65 <= b <= 90 or (i and raw[i - 1] == 0xC3 and 0x80 <= b <= 0x9E):
            b += 32
        out.append(b if 97 <= b <= 122 or b >= 128 else 32)
    out = re.sub(b" +", b" ", b" " + bytes(out))
    return [int.from_bytes(out[i : i + 4], "little") for i in range(len(out) - 3)]


def test_grams():
    texts = ["Été 12 À-la!", "", None, "a", "  THE the\n", "東京 x", "abcd"]
    column = pa.array(texts)
    for first, last, data, bounds in language.blocks(column):
        values, owner = language.text_grams(data, bounds)
        got = [values[owner == i].tolist() for i in range(last - first)]
    assert got == [plain_grams(t) for t in texts]


def test_query_against_plain_sets(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs}
    counts = collections.defaultdict(collections.Counter)
    for r in docs:
        if not held[r.doc_id] and r.lang:
            counts[r.lang].update(plain_grams(r.text))
    sets = {lang: {g for g, n in c.items() if n >= language.SHARE * c.total()} for lang, c in counts.items()}
    rows = {r.doc_id: r for r in QUERIES["op6_language"](spark, sf).collect()}
    assert len(rows) == len(docs)
    right = 0
    for d in docs:
        r, found = rows[d.doc_id], plain_grams(d.text)
        assert r.held_out == held[d.doc_id] and 0 <= r.score <= 1
        share = {lang: sum(g in s for g in found) / max(1, len(found)) for lang, s in sets.items()}
        assert share[r.lang_pred] >= max(share.values()) - 0.02
        assert abs(r.score - share[r.lang_pred]) < 0.02
        right += r.lang_pred == d.lang
    assert right > 0.9 * len(docs)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_language"](spark, sf).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.95 * len(rows)


def test_false_positives_are_corrected():
    rng = np.random.default_rng(1)
    sets = {f"l{i:03d}": rng.integers(0, 1 << 32, 500) for i in range(70)}
    filters = language.Filters(sets)
    values = np.concatenate([sets["l066"][:300], rng.integers(0, 1 << 32, 100)]).astype(np.uint32)
    share = filters.counts(values, np.zeros(400, np.int64), 1)[0]
    assert share.argmax() == 66 and abs(share[66] - 0.75) < 0.02 and share[:66].max() < 0.02


def test_odd_rows(spark):
    docs = [(1, None, "en"), (2, "", "en"), (3, "12 !!", "en"), (None, "the house of the", None), (4, "the house of the", "en"), (4, "the house of the", "en"), (5, "Ω", "en"), (6, "la maison", "fr"), (8, "la maison de la", "fr")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language.identify(frame).collect())
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert {p for d, p in got if d in (0, 4)} == {"en"} and {p for d, p in got if d in (6, 8)} == {"fr"}
    assert language.identify(frame.where("false")).collect() == []
    assert {r.lang_pred for r in language.identify(frame.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}

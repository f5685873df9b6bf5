"""Operators on small fixtures against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer, token_rows
from lexshelf.functions import text as T
from lexshelf.functions.dates import date_math
from lexshelf.functions.geo import bbox, geo_dist
from lexshelf.operators import build, discover, facets, match, postings, rank, spelling
from lexshelf.session import cut, spread_join
from lexshelf.sources import records, store, wordlists
from lexshelf.streaming import ingest

LOWER = Analyzer("lower", T.tok_standard, (), (("term", F.lower),))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_near_terms_finds_every_pair(spark, most):
    rng = random.Random(7)
    vocabulary = sorted({"".join(rng.choices("abé", k=rng.randint(1, 8))) for _ in range(400)})
    asked = vocabulary[::5]
    stats = spark.createDataFrame([(w, 1, 1) for w in vocabulary], "term string, df long, ttf long")
    words = spark.createDataFrame([(w,) for w in asked], "word string")
    got = {(r.word, r.term, r.distance) for r in spelling.near_terms(stats, words, most).collect()}
    want = {
        (w, t, d) for w, t in itertools.product(asked, vocabulary) if w[0] == t[0] and 0 < (d := edits(w, t)) <= most
    }
    assert got == want


def test_suggest_allows_one_wrong_letter(spark):
    values = spark.createDataFrame([("memory", 3.0), ("memo", 5.0), ("mango", 9.0), ("xemory", 1.0)], "v string, w double")
    asked = spark.createDataFrame([("q", "memx")], "query_id string, prefix string")
    assert [r.value for r in spelling.suggest(values, "v", "w", asked).orderBy("rank").collect()] == ["memo", "memory"]


def phrase_fixture(spark):
    docs = [(1, "to be or not to be"), (2, "be to or"), (3, "the the the end"), (4, "not to be or")]
    tokens = postings.tokenize(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", LOWER)
    asked = [("a", "to be"), ("b", "the the"), ("c", "to be or not"), ("d", "missing to")]
    rows = token_rows(spark.createDataFrame(asked, "query_id string, text string"), "text", LOWER)
    return docs, asked, tokens, rows.withColumnRenamed("pos", "offset")


def test_phrases(spark):
    docs, asked, tokens, phrases = phrase_fixture(spark)
    want = set()
    for (q, phrase), (d, text) in itertools.product(asked, docs):
        p, t = phrase.split(), text.split()
        want |= {(q, d, i) for i in range(len(t)) if t[i : i + len(p)] == p}
    got = {(r.query_id, r.doc_id, r.start) for r in match.phrase_match(tokens, phrases, "doc_id").collect()}
    assert got == want


def test_wildcards(spark):
    vocabulary = ["tion", "motion", "nation", "a", "abe", "ape", "a%b", "a_b", "thé"]
    stats = spark.createDataFrame([(w, 1, 1) for w in vocabulary], "term string, df long, ttf long")
    patterns = ["*tion", "a*e", "a?e", "?", "*", "a%*", "a_b", "*ot*", "th?"]
    asked = spark.createDataFrame([(p, p) for p in patterns], "query_id string, pattern string")
    import fnmatch

    want = {(p, w) for p in patterns for w in vocabulary if fnmatch.fnmatchcase(w, p)}
    rows = match.expand_wildcards(stats, asked).collect()
    assert {(r.pattern, r.term) for r in rows} == want
    assert {(r.pattern, r.n_terms) for r in rows} == {(p, sum(q == p for q, _ in want)) for p, _ in want}
    post = stats.selectExpr("1 AS doc_id", "term", "7 AS tf")
    assert {r.score for r in match.wildcard_match(post, stats, asked, "doc_id").collect()} == {1.0}


def test_range_ends(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3)] + [(None,)], "x int")
    pick = lambda *a: [r.x for r in df.filter(match.range_filter(F.col("x"), *a)).orderBy("x").collect()]
    assert pick(1, 3, True, False) == [1, 2]
    assert pick("*", 2) == [1, 2]
    assert pick(1, "*", False) == [2, 3]
    assert pick("*", "*") == [1, 2, 3]


def test_spatial_box_holds_the_circle(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    for point in ((0.0, 179.0), (80.0, 0.0), (-45.0, -179.0), (10.0, 10.0)):
        near = geo_dist(lat, lon, F.lit(point[0]), F.lit(point[1])) <= 2000
        inside = bbox(lat, lon, *point, 2000.0)
        assert df.filter(near).count() > 0
        assert df.filter(near & ~inside).count() == 0


def test_drill_down_skips_what_is_malformed(spark):
    index = spark.createDataFrame([(1, ["a", "b"], "x"), (2, ["b"], "y")], "id int, byA array<string>, byB string")
    asked = spark.createDataFrame(
        [("q", '["byA:a", "byA:b", "byB:y", "nocolon", "byB:%zz"]')], "query_id string, selections string"
    )
    assert [r.id for r in match.drill_down(index, asked, "id", ["byA", "byB"]).collect()] == [2]


def test_dates(spark):
    df = spark.createDataFrame([("2024-03-31 10:20:30",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert str(df.select(date_math(F.col("t"), "/MONTH+1MONTH-1DAY")).first()[0]) == "2024-03-31 00:00:00"


def test_spread_join_equals_join(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(200)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, spread_join(left, right, ["k"], how).collect())) == want


def test_running_total_over_blocks(spark):
    rows = [(k, i, (i * 7) % 5) for k in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i int, a int")
    got = {(r.k, r.i): r.s for r in postings.running_total(df, "k", "i", F.col("a"), "s", block=16).collect()}
    for k in (1, 2):
        total = 0
        for _, i, a in [r for r in rows if r[0] == k]:
            assert got[k, i] == total
            total += a


def test_top_k_in_slices(spark):
    hits = spark.range(5000).select(F.lit("q").alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 100).cast("double").alias("score"))
    got = [(r.rank, r.doc_id) for r in rank.top_k(hits, 1500, "doc_id").orderBy("rank").collect()]
    want = sorted(range(5000), key=lambda d: (-(d % 100), d))[:1500]
    assert got == list(enumerate(want, 1))


def test_browse_places_are_the_global_order(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.md5(F.col("id").cast("string"))).alias("t"))
    got = [(r.id, r.place, r.shelf) for r in discover.browse_list(df, "id", "t", 64).orderBy("place").collect()]
    want = [r.id for r in df.orderBy("t", "id").collect()]
    assert got == [(d, i + 1, i // 64) for i, d in enumerate(want)]


def test_groups_keep_the_null_group(spark):
    hits = spark.createDataFrame([("q", i, float(i)) for i in range(6)], "query_id string, doc_id int, score double")
    index = spark.createDataFrame([(i, None if i < 3 else "g") for i in range(6)], "doc_id int, c string")
    rows = facets.group_results(hits, index, "doc_id", "c", 1).collect()
    assert {(r.group_value, r.doc_id, r.group_size, r.matches, r.n_groups) for r in rows} == {(None, 2, 3, 6, 2), ("g", 5, 3, 6, 2)}


def sections(spark):
    rows = [
        ("d1", "", 1, "indexed_doc", "top <b>", {"dc.Title": ["A"], "Identifier": ["d1"]}),
        ("d1", "1", 2, "indexed_doc", "body", {"dc.Title": []}),
        ("d1", "2", 3, "indexed_doc", "hidden", {"gsdldoctype": ["classify"]}),
        ("d2", "", 1, "classify", "no", {}),
    ]
    return spark.createDataFrame(rows, "doc_oid string, sec_path string, sec_no int, doc_type string, text string, meta map<string,array<string>>")


def test_index_levels(spark):
    rows = build.build_sec_index(sections(spark), "text;dc.Title", ["dc.Title"], [], "always", "always").orderBy("docOID").collect()
    assert [(r.docOID, r.TX, r.TI, r.byTI) for r in rows] == [
        ("d1", "top &lt;b&gt;", "A", ["A"]), ("d1.1", "body", "A", ["A"]), ("d1.2", None, None, None)
    ]
    values = build.build_doc_index(sections(spark), "text;topdc.Title").collect()
    assert {(r.docOID, r.field, r.sec_no, r.value) for r in values} == {
        ("d1", "TX", 1, "top &lt;b&gt;"), ("d1", "TX", 2, "body"), ("d1", "TI", 1, "A")
    }


def test_short_names_collide_safely(spark):
    rows = [("d", "", 1, "indexed_doc", "", {"dc.Title": ["a"], "Time": ["b"], "x.Tide": ["c"]})]
    collection = spark.createDataFrame(rows, sections(spark).schema)
    names = build.field_map(spark, "dc.Title;Time;text", collection).collect()
    assert {r.field: r.short_name for r in names} == {
        "dc.Title": "TI", "Time": "TI2", "x.Tide": "TI3", "allfields": "ZZ", "text": "TX"
    }
    index = build.project_fields(collection, "dc.Title;Time;text").first()
    assert (index.TI, index.TI2) == ("a", "b")


def test_published_versions_and_store(spark, tmp_path):
    root = str(tmp_path / "index")
    assert store.publish(spark.range(3), root) == 1
    assert store.publish(spark.range(5), root) == 2
    live = store.current(spark, root)
    assert store.publish(spark.range(1), root, "append") == 3
    assert (live.count(), store.current(spark, root).count()) == (5, 6)


def test_stream_equals_batch(spark, tmp_path):
    base = spark.createDataFrame([("d1", "d1", "old"), ("d1", "d1.1", "old"), ("d2", "d2", "old")], "doc_oid string, docOID string, TX string")
    schema = "doc_oid string, docOID string, TX string, op string, seq int"
    feed = spark.createDataFrame(
        [("d1", "d1", None, "delete", 1), ("d3", "d3", "new", "add", 2), ("d3", "d3", "newer", "add", 3), ("d1", "d1.1", "back", "add", 4)], schema
    )
    feed.repartition(3).write.parquet(str(tmp_path / "feed"))
    root = str(tmp_path / "live")
    for _ in range(2):  # the second run finds nothing new
        ingest.stream_index(ingest.file_changes(spark, str(tmp_path / "feed"), schema, 1), root).awaitTermination()
    live = ingest.current_index(spark, root, base, "docOID", "doc_oid", by_batch=False)
    want = {("d1.1", "back"), ("d2", "old"), ("d3", "newer")}
    assert {(r.docOID, r.TX) for r in live.collect()} == want
    assert {(r.docOID, r.TX) for r in build.apply_changes(base, feed).collect()} == want
    whole = {(r.docOID, r.TX) for r in ingest.compact(spark, root, base, "docOID", "doc_oid").collect()}
    assert whole >= {("d2", "old")}
    # folded batches are read no more, later ones are
    assert {(r.docOID, r.TX) for r in ingest.current_index(spark, root, base.limit(0), "docOID", "doc_oid").collect()} == whole
    spark.createDataFrame([("d2", "d2", None, "delete", 9)], schema).write.parquet(f"{root}/changes/batch=99")
    left = ingest.current_index(spark, root, base, "docOID", "doc_oid").collect()
    assert {(r.docOID, r.TX) for r in left} == whole - {("d2", "old")}


def test_word_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("# list\nder | the\ndie\nein zwei\n", encoding="utf-8")
    assert [r.word for r in wordlists.read_words(spark, str(tmp_path / "stop.txt")).collect()] == ["der", "die", "ein", "zwei"]
    (tmp_path / "syn.txt").write_text("# rules\naaa => bbb, ccc\nx, Y\n", encoding="utf-8")
    rows = {(r.source, r.target) for r in wordlists.read_synonyms(spark, str(tmp_path / "syn.txt")).collect()}
    assert rows == {("aaa", "bbb"), ("aaa", "ccc"), ("x", "x"), ("x", "y"), ("y", "x"), ("y", "y")}
    (tmp_path / "stems.txt").write_text("# d\nei\teier\n", encoding="utf-8")
    assert [(r.word, r.stem) for r in wordlists.read_stems(spark, str(tmp_path / "stems.txt")).collect()] == [("ei", "eier")]


def test_sections_from_json(spark, tmp_path):
    sections(spark).write.json(str(tmp_path / "s"))
    assert records.read_sections(spark, str(tmp_path / "s")).count() == 4


def test_cut_keeps_rows_and_types(spark):
    df = spark.range(10).withColumn("a", F.array(F.col("id")))
    stored = cut(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(r.id for r in stored.collect()) == list(range(10))


def test_one_term_in_every_document(spark):
    """A term, a query and a phrase word shared by everything still give whole results."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot w"), F.col("id").cast("string")).alias("text"))
    post = postings.postings_of(docs, "doc_id", "text", LOWER)
    asked = spark.createDataFrame([("q1", "hot"), ("q2", "hot"), ("q2", "w7")], "query_id string, term string")
    found = match.match_terms(post, asked)
    assert found.count() == 801
    assert {(r.query_id, r.doc_id) for r in match.boolean_match(found, asked, "doc_id").collect()} == {("q1", i) for i in range(400)} | {("q2", 7)}
    hits = rank.score(rank.explain_scores(post, rank.term_weights(post, asked, F.lit(400))), "doc_id")
    assert hits.count() == 800
    assert rank.top_k(hits, 1, "doc_id").filter("query_id = 'q2'").first().doc_id == 7


def test_one_document_and_its_sections(spark):
    hits = spark.createDataFrame([("c4",), ("c4.1",), ("c40",), ("c41.2",)], "docOID string")
    assert sorted(r.docOID for r in match.doc_filter(hits, "docOID", "c4").collect()) == ["c4", "c4.1"]


def test_days_at_the_end_of_a_month_fall_between_the_edges(spark):
    rows = [("2023-01-31 00:00:00",), ("2023-02-28 10:00:00",), ("2023-03-29 23:00:00",), ("2023-03-30 00:00:00",)]
    events = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("t"))
    got = facets.facet_date(events, "t", "2023-01-30", "2023-04-01", "+1MONTH").collect()
    assert sorted((str(r.low)[:10], r["count"]) for r in got if r.part == "range") == [("2023-01-30", 1), ("2023-02-28", 2), ("2023-03-30", 1)]
    with pytest.raises(ValueError):
        facets.facet_date(events, "t", "2023-01-30", "2023-04-01", "1MONTH")


def test_one_row_per_key_also_for_equal_numbers(spark):
    changes = spark.createDataFrame([("d", "d", "one", "add", 1), ("d", "d", "two", "add", 1), ("d", "d", "two", "add", 1)], "doc_oid string, docOID string, TX string, op string, seq int")
    rows = build.apply_changes(changes.select("doc_oid", "docOID", "TX").where("false"), changes).collect()
    assert len(rows) == 1 and rows[0].TX in ("one", "two")


def test_statistics_count_what_is_not_indexed(spark):
    read = build.eligible(sections(spark), keep_placeholders=True)
    one = build.ingest_stats(read, build.build_doc_index(sections(spark), "text")).first()
    assert (one.docs, one.sections, one.bytes) == (1, 3, len("top <b>") + len("body"))


def test_documents_of_several_rows(spark):
    rows = spark.createDataFrame([("d", "one two"), ("d", "one two three"), ("e", "one")], "id string, t string")
    got = postings.postings(postings.tokenize(rows, "id", "t", LOWER), "id").collect()
    assert {(r.id, r.term, r.len, r.tf) for r in got} == {("d", "one", 5, 2), ("d", "two", 5, 2), ("d", "three", 5, 1), ("e", "one", 1, 1)}


def test_second_suggestions_for_both_words(spark):
    words = spark.createDataFrame([("q", 0, "aa"), ("q", 1, "bb"), ("q", 2, "c")], "query_id string, pos int, word string")
    found = spark.createDataFrame([("aa", "a1", 1), ("aa", "a2", 2), ("bb", "b1", 1), ("bb", "b2", 2)], "word string, suggestion string, rank int")
    post = spark.createDataFrame([(1, "a2"), (1, "b2"), (1, "c"), (2, "a1"), (2, "b1"), (3, "a2"), (3, "b2"), (3, "c")], "doc_id int, term string")
    assert [tuple(r) for r in spelling.collate(words, found, post, "doc_id").collect()] == [("q", 4, "a2 b2 c", 2)]


def test_a_stem_listed_twice(spark):
    tokens = spark.createDataFrame([(1, 0, "ei"), (1, 1, "x")], "id int, pos int, term string")
    stems = spark.createDataFrame([("ei", "eier"), ("ei", "eien")], "word string, stem string")
    assert sorted(tuple(r) for r in postings.override_stems(tokens, stems).collect()) == [(1, 0, "eien"), (1, 1, "x")]


def test_leaves_come_in_order(spark):
    df = spark.createDataFrame([(1, "b", "z"), (2, "a", "y"), (3, "a", "x"), (4, None, "w")], "id int, node string, title string")
    leaves = discover.browse_leaves(df, "id", "node", "title").orderBy("place").collect()
    assert [(r.node, r.title, r.place) for r in leaves] == [("a", "x", 1), ("a", "y", 2), ("b", "z", 3)]


def test_date_math_is_read_in_full(spark):
    day = F.lit("2024-02-29 12:00:00").cast("timestamp")
    value = lambda ops: str(spark.range(1).select(date_math(day, ops)).first()[0])
    assert value("+1DAY/MONTH-1MILLISECOND") == "2024-02-29 23:59:59.999000"
    for wrong in ("+1day", "+DAY", "/WEEK", "1DAY", "+1DAY x"):
        with pytest.raises(ValueError):
            date_math(day, wrong)


def test_a_term_in_every_row_is_dealt_evenly(spark):
    tokens = spark.range(40_000).select(F.col("id"), F.lit("hot").alias("term"))
    asked = spark.createDataFrame([("hot",)], "term string").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = postings.restrict(tokens, asked).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 40_000 and max(r["count"] for r in sizes) <= 0.6 * 40_000

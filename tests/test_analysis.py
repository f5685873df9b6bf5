"""Analysis steps on small values, each against what the step is defined to give."""

import itertools

import pytest
import regex
from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions import words as W
from lexshelf.functions.analyzers import PRESETS, Analyzer, analyzer, token_rows
from lexshelf.operators import postings


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("r")).first().r


def terms(spark, text, chain):
    rows = token_rows(spark.createDataFrame([(1, text)], "id int, t string"), "t", chain)
    return sorted((r.pos, r.term) for r in rows.collect())


def step(*steps):
    return Analyzer("t", T.tok_whitespace, (), steps)


def test_html(spark):
    page = '<html><script>var a="</p>";</script><!-- x --><p class="q">a &lt; b &amp; c</p></html>'
    assert one(spark, page, T.html_strip).split() == ["a", "<", "b", "&", "c"]
    assert one(spark, '<a href="x">&', T.html_escape) == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(spark, "3 < 4 and 5 > 2", T.html_strip) == "3 < 4 and 5 > 2"


def test_tokenizers(spark):
    assert one(spark, "L'été, wi-fi d’eau a.b 3,4", T.tok_standard) == ["L'été", "wi", "fi", "d’eau", "a.b", "3", "4"]
    assert one(spark, " a  b\tc ", T.tok_whitespace) == ["a", "b", "c"]
    assert one(spark, "/a/b/c", T.path_prefixes) == ["/a", "/a/b", "/a/b/c"]
    assert one(spark, "", T.tok_standard) == []


@pytest.mark.parametrize(
    "word,stem",
    [("cities", "city"), ("horses", "horse"), ("bus", "bus"), ("glass", "glass"), ("shoes", "shoes"), ("is", "is"), ("aies", "aies"), ("dogs", "dog")],
)
def test_plural_stems(spark, word, stem):
    assert one(spark, word, T.stem_en_minimal) == stem


def test_self_check_rules_of_the_lists(spark):
    chain = step(("term", T.stop(W.STOP_EN)), ("term", T.protect(W.PROTECTED, T.stem_en_minimal)))
    assert terms(spark, "stopworda The cats stopwordb dontstems", chain) == [(2, "cat"), (4, "dontstems")]
    query = step(("slots", T.synonyms()))
    assert terms(spark, "aaafoo x", query) == [(0, "aaabar"), (1, "x")]
    assert terms(spark, "bbbfoo x", query) == [(0, "bbbfoo"), (1, "bbbbar"), (2, "x")]
    assert terms(spark, "cccfoo", query) == [(0, "cccbar"), (1, "cccbaz")]
    assert {t for _, t in terms(spark, "TV", query)} == {"television", "televisions", "tv", "tvs"}
    assert terms(spark, "baraaa", step(("slots", T.synonyms(expand=False)))) == [(0, "fooaaa")]


def test_word_delimiter(spark):
    full = step(("slots", T.word_delimiter()))
    assert terms(spark, "Wi-Fi500 x", full) == [(0, "Wi"), (0, "WiFi"), (1, "Fi"), (2, "500"), (3, "x")]
    assert terms(spark, "PowerShot's -- end", full) == [(0, "Power"), (0, "PowerShot"), (1, "Shot"), (3, "end")]
    tight = step(("slots", T.word_delimiter(generate_parts=False)))
    assert terms(spark, "wi-fi 500-42", tight) == [(0, "wifi"), (1, "50042")]


def test_language_steps(spark):
    assert one(spark, "l'homme", T.elision(W.ELISIONS["fr"])) == "homme"
    assert one(spark, "Qu’elle", T.elision(W.ELISIONS["fr"])) == "elle"
    assert one(spark, "DIŞ İL", T.lower_case("tr")) == "dış il"
    assert one(spark, "ΌΣΟΣ", T.lower_case("el")) == "οσοσ"
    assert one(spark, "nAthair", T.lower_case("ga")) == "n-athair"
    assert one(spark, "ﬁancé Œuvre Straße Ĳ", T.char_map) == "fiance OEuvre Strasse IJ"
    assert one(spark, "ＡＢｃ１", T.normalize("cjk")) == "ABc1"
    assert one(spark, "أحمد", T.normalize("ar")) == "احمد"
    assert one(spark, "कँ", T.normalize("hi")) == "कं"
    assert one(spark, "straße", T.normalize("de")) == "strasse"
    assert one(spark, "fuer", T.normalize("de")) == "fur"
    assert one(spark, "quelle", T.normalize("de")) == "quelle"
    assert one(spark, "häusern", T.stem_light("de")) == "haus"
    assert one(spark, "chevaux", T.stem_light("fr")) == "cheval"
    assert one(spark, "casas", T.stem_light("es")) == "cas"
    assert one(spark, "veces", T.stem_light("es")) == "vez"
    assert one(spark, "kind", T.stem_dict(W.STEMS_NL)) == "kinder"
    assert one(spark, "  B-2 Zoo! ", T.alpha_sort_key) == "bzoo"


def test_cjk_and_reversed(spark):
    assert terms(spark, "東京都 abc", analyzer("text_cjk")) == [(0, "東京"), (1, "京都"), (2, "abc")]
    assert {t for _, t in terms(spark, "Motion", analyzer("text_general_rev"))} == {"motion", T.REVERSED + "noitom"}
    assert not any(t.startswith("saw") for _, t in terms(spark, "it was late", analyzer("text_general_rev")))


def test_payloads(spark):
    got = one(spark, "foo|1.4 bar baz|x", T.payloads)
    assert [(r.term, r.payload) for r in got] == [("foo", 1.4), ("bar", 1.0), ("baz", 1.0)]


def test_duplicates_at_a_position(spark):
    chain = step(("slots", T.synonyms([], [["cat", "cats"]])), ("term", T.stem_en_minimal), ("slots", T.dedupe_tokens))
    assert terms(spark, "cats", chain) == [(0, "cat")]


@pytest.mark.parametrize("preset", PRESETS)
def test_presets_run(spark, preset):
    assert len(terms(spark, "Readings naïves 42", analyzer(preset, stop_words=["the"]))) > 0


def test_a_chain_without_its_stop_list_is_an_error(spark):
    with pytest.raises(ValueError):
        analyzer("text_de")
    assert terms(spark, "der Hund", analyzer("text_de", stop_words=["der"])) == [(1, "hund")]


def test_other_scripts(spark):
    """Literal texts beside a given table, which has no such letters."""
    texts = {"ar": ("وَالكتاب", "والكتاب"), "fa": ("کتاب", "كتاب"), "hi": ("हूँ", "हुं"), "fi": ("Talo", "talo")}
    rows = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").selectExpr("item_id", "text").limit(2)
    for lang, (text, want) in texts.items():
        both = rows.union(spark.createDataFrame([(-1, text)], "item_id long, text string"))
        found = token_rows(both, "text", analyzer(f"text_{lang}", stop_words=["the"])).where("item_id = -1").collect()
        assert [r.term for r in found] == [want], lang


def test_query_and_index_chains_differ(spark):
    assert (0, "television") in terms(spark, "TV", analyzer("text_general", query=True))
    assert terms(spark, "TV", analyzer("text_general")) == [(0, "tv")]
    assert terms(spark, "wi-fi", analyzer("text_en_splitting", query=True)) == [(0, "wi"), (1, "fi")]
    assert len(terms(spark, "wi-fi", analyzer("text_en_splitting"))) == 3


def test_user_step(spark):
    shout = analyzer("text_ws").then("term", F.upper)
    assert terms(spark, "a b", shout) == [(0, "A"), (1, "B")]


def test_positions_of_many_values(spark):
    values = spark.createDataFrame([(1, i, "a b") for i in range(2500)], "id int, n int, t string")
    rows = postings.tokenize_values(values, "id", "n", "t", analyzer("text_ws")).collect()
    assert sorted(r.pos for r in rows if r.term == "a") == [i * 102 for i in range(2500)]


def test_position_blocks_are_bounded(spark):
    tokens = spark.range(10_000).select(F.lit(1).alias("id"), F.col("id").alias("pos"), F.lit("x").alias("term"))
    blocks = postings.posting_blocks(tokens, "id", 4096).collect()
    assert sorted(len(b.positions) for b in blocks) == [1808, 4096, 4096]
    assert sorted(p for b in blocks for p in b.positions) == list(range(10_000))


def test_term_rows_count_within_the_row(spark):
    df = spark.createDataFrame([(1, "b a b  c b a"), (2, ""), (3, None)], "id int, t string")
    rows = postings.postings_of(df, "id", "t", analyzer("text_ws")).collect()
    assert {(r.id, r.len, r.term, r.tf) for r in rows} == {(1, 6, "a", 2), (1, 6, "b", 3), (1, 6, "c", 1)}
    tokens = postings.tokenize(df, "id", "t", analyzer("text_ws"))
    assert sorted(map(tuple, postings.postings(tokens, "id").select("id", "len", "term", "tf").collect())) == sorted(map(tuple, rows))


def test_word_parts_are_cut_once(spark):
    """Tokens of one part take a short way to the same parts, and no other token is taken apart more than once."""
    words = ["plain", "Upper", "(quoted)", "it's", "Wi-Fi500", "a1", "١٢", "12", "--", "aB", "McDonald's", "ends.\u0085", "x ", "it's\u0085", "été,", "ÀÉ", "5's", "'s", None]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, word string")

    def parts(w):
        return regex.findall(r"\p{Lu}*[\p{Ll}\p{Lm}\p{Lo}\p{Lt}\p{M}]+|\p{Lu}+|\p{N}+", regex.sub(r"['’][sS](?=\u0085?\Z)", "", w or ""))

    for each in (True, False):
        delimit = T.word_delimiter(generate_parts=each, catenate=False)
        found = docs.select("id", delimit(F.array("word")).alias("slots")).collect()
        for r in found:
            runs = [list(g) for _, g in itertools.groupby(parts(words[r.id]), lambda p: p[0].isnumeric())]
            assert r.slots == ([[p] for run in runs for p in (run if each else ["".join(run)])] or [[]]), words[r.id]
    tight = analyzer("text_en_splitting_tight")(F.lit("a b"))
    plan = spark.range(1).select(tight.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(r"\p{Lu}*[") == 2  # terms that are alone at their position, and others

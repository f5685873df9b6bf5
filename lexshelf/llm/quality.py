"""Quality rules by weak supervision, in DataFrame functions alone.

Each rule votes good or bad, or abstains. Votes have at most 3 ** 10 patterns, whose counts are all that
expectation-maximisation needs: it estimates how often each rule is right about good and about bad documents, and the
share of good ones. The posterior probability of a good document, not a pass of all rules, decides. No text is
shuffled, and each is measured once: the measured rows are written to the shared folder, their patterns counted, and the
estimates meet the rows as a scalar subquery of one row.

A null text has no words, like an empty one; both fail the base rules. Any row is judged by itself, so repeated rows
and null ids need no care. Other columns pass. Without any document the estimates are the initial ones and the result
is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.session import cut

WINDOW = 8
ROUNDS = 30
#: Accuracies that each rule starts with about good and bad documents, and the first share of good ones. The belief that a
#: good document seldom gets a bad vote weighs as much as all votes counted; the other two as much as PRIOR_VOTES votes. Else the
#: two classes would be the two largest kinds of document, and a kind of bad one that most rules miss would count as good.
GOOD_RIGHT, BAD_RIGHT, PRIOR_GOOD, PRIOR_VOTES = 0.995, 0.3, 0.85, 5.0

SPACE = " \t\n\x0b\f\r"
SPACES = "[ \\t-\\r]+"

#: Frequent function words of English, French, German and Spanish.
FREQUENT = (
    "the of and to in is that it was for on are with as be this by from at "
    "de la le les et des en du un une que est pour dans qui par sur pas au "
    "der die und das den von zu mit ist ein eine des dem nicht sich auf für "
    "el los las y del una por con para se su al lo"
).split()


def rules() -> dict[str, tuple[Column, Column]]:
    """name: (bad where, good where) over the measures of a document; neither means abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    symbols, chars = F.col("n_symbols") / n, F.col("word_chars") / n
    lines, repeats = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_repeat_words") / n
    variety, letters = F.col("n_distinct") / F.sqrt(n), F.col("n_letters") / F.greatest(F.col("word_chars"), F.lit(1))
    capitals = F.col("n_capitals") / F.greatest(F.col("n_letters"), F.lit(1))
    marks, frequent = F.col("n_marks") / n, F.col("n_frequent") / n
    return {
        "few symbols": (symbols > 0.15, symbols <= 0.05),
        "usual word length": ((chars < 2.5) | (chars > 9), (chars >= 3.5) & (chars <= 6.6)),
        "lines differ": (lines > 0.5, lines <= 0.3),
        "stretches differ": (repeats > 0.3, repeats <= 0.1),
        "neighbours differ": (F.col("n_same_as_last") / n > 0.3, F.col("n_same_as_last") / n <= 0.05),
        "words vary": (variety < 1.5, variety >= 3),
        "mostly letters and digits": (letters < 0.88, letters >= 0.93),
        "few capitals": (capitals > 0.4, capitals <= 0.15),
        "marks end sentences": (marks > 0.8, (marks > 0.01) & (marks <= 0.35)),
        "function words": (F.lit(False), frequent >= 0.08),
    }


def _once(frame: DataFrame, **columns: Column) -> DataFrame:
    """``frame`` with columns that are worked out once, however often they are used later."""
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return frame.select("*", F.inline_outer(F.array(fields)))


def _covered(hashes: Column) -> Column:
    """Words under the windows whose hash comes twice or more."""

    def marked(ordered: Column) -> Column:
        twin = lambda e, k: F.coalesce(F.get(ordered, k)["x"] == e["x"], F.lit(False))
        flagged = F.transform(ordered, lambda e, k: F.when(twin(e, k - 1) | twin(e, k + 1), e["i"]))
        return F.array_sort(F.array_compact(flagged))

    ordered = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    starts = F.get(F.transform(F.array(ordered), marked), 0)
    begin = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("end"))
    step = lambda s, p: F.struct((s["words"] + p + WINDOW - F.greatest(p, s["end"])).alias("words"), (p + WINDOW).alias("end"))
    return F.aggregate(starts, begin, step, lambda s: s["words"])


def measured(frame: DataFrame) -> DataFrame:
    """``frame`` (with a column text) and the measures of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.trim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACE)) != "")
    frame = _once(frame, words=words, lines=lines)
    size = F.size("words")
    frame = _once(frame, codes=F.transform("words", lambda w: F.xxhash64(w)), joined=F.array_join("words", ""))
    windows = F.when(size >= WINDOW, F.transform(F.sequence(F.lit(1), size - WINDOW + 1), lambda i: F.xxhash64(F.slice("codes", i, WINDOW))))
    frame = _once(frame, windows=F.coalesce(windows, F.array().cast("array<bigint>")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    left = lambda pattern: F.length(F.regexp_replace("joined", pattern, "")).cast("long")
    number = lambda signs: F.length("joined") - F.length(reduce(lambda text, sign: F.replace(text, F.lit(sign), F.lit("")), signs, F.col("joined")))
    return _once(
        frame,
        n_words=size.cast("long"),
        word_chars=F.length("joined").cast("long"),
        n_symbols=number("#*$%&|<>").cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=F.when(repeated, _covered(F.col("windows"))).otherwise(F.lit(0).cast("long")),
        n_same_as_last=F.size(F.filter("codes", lambda c, i: c == F.get("codes", i - 1))).cast("long"),
        n_distinct=F.size(F.array_distinct("codes")).cast("long"),
        n_letters=F.length("joined") - left(r"[\p{L}\p{N}]+"),
        n_capitals=F.length("joined") - left(r"\p{Lu}+"),
        n_marks=number(".!?").cast("long"),
        n_frequent=F.size(F.filter("words", lambda w: w.isin(*FREQUENT))).cast("long"),
    ).drop("words", "lines", "codes", "joined", "windows")


def votes() -> Column:
    """One vote per rule: true good, false bad, null abstains."""
    return F.array(*[F.when(bad, F.lit(False)).when(good, F.lit(True)) for bad, good in rules().values()])


def _weights(share: Column, good: Column, bad: Column) -> Column:
    """What the posterior needs: log odds of a good document, and those that a good or a bad vote of each rule adds."""
    return F.struct(
        F.log(share / (1 - share)).alias("base"),
        F.transform(good, lambda g, j: F.log(g / (1 - F.get(bad, j)))).alias("up"),
        F.transform(good, lambda g, j: F.log((1 - g) / F.get(bad, j))).alias("down"),
    )


def posterior(cast: Column, weights: Column) -> Column:
    """Probability of a good document, given its votes."""
    added = F.transform(cast, lambda v, j: F.when(v, F.get(weights["up"], j)).when(~v, F.get(weights["down"], j)).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(added, weights["base"], lambda s, x: s + x)))


def estimated(patterns: Column, n_rules: int, rounds: int = ROUNDS) -> Column:
    """Expectation-maximisation over an array of (cast, n): the weights of the posterior."""
    each = F.sequence(F.lit(0), F.lit(n_rules - 1))
    flat = lambda value: F.transform(each, lambda j: F.lit(value))
    begin = _weights(F.lit(PRIOR_GOOD), flat(GOOD_RIGHT), flat(BAD_RIGHT))

    def round_(weights: Column, _: Column) -> Column:
        judged = F.transform(patterns, lambda p: F.struct(p["cast"].alias("cast"), p["n"].alias("n"), posterior(p["cast"], weights).alias("r")))

        def maximised(judged: Column) -> Column:
            def right(j: Column, good: bool) -> Column:
                part = lambda p: p["n"] * (p["r"] if good else 1 - p["r"])
                count = lambda want: F.aggregate(
                    judged, F.lit(0.0), lambda s, p: s + F.when(want(F.get(p["cast"], j)), part(p)).otherwise(0.0)
                )
                hits = count(lambda v: F.coalesce(v == F.lit(good), F.lit(False)))
                votes = count(lambda v: v.isNotNull())
                added = PRIOR_VOTES + votes if good else F.lit(PRIOR_VOTES)
                return (hits + added * (GOOD_RIGHT if good else BAD_RIGHT)) / (votes + added)

            all_n = F.aggregate(judged, F.lit(0.0), lambda s, p: s + p["n"])
            good_n = F.aggregate(judged, F.lit(0.0), lambda s, p: s + p["n"] * p["r"])
            share = (good_n + PRIOR_VOTES * PRIOR_GOOD) / (all_n + PRIOR_VOTES)
            accuracies = F.struct(
                share.alias("share"),
                F.transform(each, lambda j: right(j, True)).alias("good"),
                F.transform(each, lambda j: right(j, False)).alias("bad"),
            )
            return F.get(F.transform(F.array(accuracies), lambda a: _weights(a["share"], a["good"], a["bad"])), 0)

        return F.get(F.transform(F.array(judged), maximised), 0)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, round_)


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures, base_failed, quality (posterior probability of a good document) and kept."""
    return _judged(_once(measured(docs), cast=votes()))


def judged_ids(docs: DataFrame) -> DataFrame:
    """The same for doc_id alone; the texts are not written."""
    return _judged(_once(measured(docs.select("doc_id", "text")), cast=votes()).drop("text"))


def _judged(frame: DataFrame) -> DataFrame:
    frame = cut(frame)
    patterns = frame.groupBy("cast").agg(F.count(F.lit(1)).cast("double").alias("n"))
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("cast", "n"))).alias("patterns"))
    weights = one.select(estimated(F.col("patterns"), len(rules()))).scalar()
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    frame = _once(_once(frame, weights=weights), base_failed=failed, quality=posterior(F.col("cast"), F.col("weights")))
    return frame.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop("cast", "weights")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are judged good."""
    numbered = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{i}") for i, c in enumerate(docs.columns)])
    kept = judged(numbered).where("kept")
    return kept.select(*[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(docs.columns)])

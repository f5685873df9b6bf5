"""Analysis chains: a named list of steps over a text column."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.functions import text as T
from lexshelf.functions import words as W


@dataclass(frozen=True)
class Analyzer:
    """``before``: on the whole value; ``tokenize``; then steps.

    A step is ("term", f) on single terms, ("tokens", f) on the token array, or ("slots", f), after
    which the value is an array of positions, each an array of terms.
    """

    name: str
    tokenize: Callable[[Column], Column]
    before: tuple[Callable[[Column], Column], ...] = ()
    steps: tuple[tuple[str, Callable[[Column], Column]], ...] = ()

    def then(self, kind: str, step: Callable[[Column], Column]) -> Analyzer:
        """The same chain with one more step: any Column -> Column function will do."""
        return replace(self, steps=(*self.steps, (kind, step)))

    @property
    def stacked(self) -> bool:
        return any(kind == "slots" for kind, _ in self.steps)

    def __call__(self, value: Column) -> Column:
        for step in self.before:
            value = step(value)
        tokens, stacked = self.tokenize(value), False
        for kind, step in self.steps:
            if kind == "term":
                # one pass per step: a step may mention its term several times
                tokens = tokens if step is T.same else _map_terms(tokens, step, stacked)
            else:
                tokens, stacked = step(tokens), stacked or kind == "slots"
        return tokens


def _map_terms(tokens: Column, step: T.TermStep, stacked: bool) -> Column:
    # the lambda: a step given as it is might take the index for a second argument
    if not stacked:
        return F.transform(tokens, lambda t: step(t))
    return F.transform(tokens, lambda slot: F.array_compact(F.transform(slot, lambda t: step(t))))


def token_rows(df: DataFrame, text: str, analyzer: Analyzer, length: str | None = None) -> DataFrame:
    """One row per token: the other columns of ``df``, ``pos`` and ``term``; ``length`` counts a row's tokens."""
    rest = [c for c in df.columns if c != text]
    out = df.select(*rest, analyzer(F.col(text)).alias("_tokens"))
    if length:
        count = F.size(F.filter(F.flatten("_tokens") if analyzer.stacked else "_tokens", lambda t: t != ""))
        out = out.withColumn(length, count.cast("bigint"))
        rest = [*rest, length]
    # the outer form: the inner one has Spark test the array's size first, analysing every text twice
    out = out.select(*rest, F.posexplode_outer("_tokens").alias("pos", "term"))
    if analyzer.stacked:
        out = out.select(*rest, "pos", F.explode("term").alias("term"))
    return out.filter(F.col("term") != "")


def term_rows(df: DataFrame, text: str, analyzer: Analyzer, length: str) -> DataFrame:
    """One row per distinct term of a text with its frequency ``tf``; other columns and the token count kept.

    Counted within the row, by sorting its tokens and measuring the runs of equal ones, so nothing is
    shuffled and only distinct terms leave the row.
    """
    rest = [c for c in df.columns if c != text]
    tokens = analyzer(F.col(text))
    tokens = F.flatten(tokens) if analyzer.stacked else tokens
    rows = df.select(*rest, F.sort_array(F.filter(tokens, lambda t: t != "")).alias("_s"))
    rows = rows.withColumn(length, F.size("_s").cast("bigint"))
    places = F.sequence(F.lit(0), F.size("_s") - 1)
    first = F.filter(places, lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    rows = rows.withColumn("_at", F.when(F.size("_s") > 0, first))
    runs = F.transform(
        "_at",
        lambda p, j: F.struct(
            F.get("_s", p).alias("term"),
            (F.coalesce(F.get("_at", j + 1), F.size("_s")) - p).cast("bigint").alias("tf"),
        ),
    )
    return rows.select(*rest, length, F.explode(runs).alias("_r")).select(*rest, length, "_r.term", "_r.tf")


def query_rows(df: DataFrame, text: str, analyzer: Analyzer) -> DataFrame:
    """``token_rows`` for a table of queries: distinct terms, positions dropped."""
    rows = token_rows(df, text, analyzer).drop("pos")
    return rows.dropDuplicates()


# The steps of each language chain after the standard tokenizer, in order.
LANGUAGE_STEPS = {
    "ar": "lower stop normalize",
    "bg": "lower stop",
    "ca": "elision lower stop",
    "ckb": "normalize lower stop",
    "cz": "lower stop",
    "da": "lower stop",
    "de": "lower stop normalize stem",
    "el": "lower:el stop-case",
    "es": "lower stop stem",
    "eu": "lower stop",
    "fa": "lower normalize:ar normalize stop",
    "fi": "lower stop",
    "fr": "elision lower stop stem",
    "ga": "elision hyphenation lower:ga stop",
    "gl": "lower stop",
    "hi": "lower normalize stop",
    "hu": "lower stop",
    "hy": "lower stop",
    "id": "lower stop",
    "it": "elision lower stop stem",
    "lv": "lower stop",
    "nl": "lower stop stemdict",
    "no": "lower stop",
    "pt": "lower stop stem",
    "ro": "lower stop",
    "ru": "lower stop",
    "sv": "lower stop",
    "th": "lower stop",
    "tr": "lower:tr stop-case",
}
#: The general list is empty as delivered; other languages have to be given theirs.
STOP_LISTS = {"": [], "en": W.STOP_EN, "fr": W.STOP_FR}
PRESETS = [
    "text_ws", "text_general", "text_en", "text_en_splitting", "text_en_splitting_tight", "text_general_rev",
    "lowercase", "alphaOnlySort", "text_cjk", *(f"text_{lang}" for lang in LANGUAGE_STEPS),
]


def analyzer(
    preset: str,
    query: bool = False,
    stop_words: Iterable[str] | None = None,
    protected: Iterable[str] = W.PROTECTED,
    rewrites: list | None = None,
    groups: list | None = None,
) -> Analyzer:
    """A preset chain; ``query`` gives the query-time variant, ``stop_words`` overrides the list.

    A chain that removes stop words of a language without a built-in list fails unless it is given one.
    """
    html, lower = (T.html_strip,), ("term", F.lower)
    lists: Mapping[str, list[str]] = STOP_LISTS

    def stops(lang: str, ignore_case: bool = True) -> tuple:
        if stop_words is None and lang not in lists:
            raise ValueError(f"{preset} removes stop words: give its list as stop_words")
        listed = lists[lang] if stop_words is None else list(stop_words)
        return ("term", T.stop(listed, ignore_case))

    def synonyms(expand: bool = True) -> tuple:
        return ("slots", T.synonyms(rewrites, groups, expand))

    stem = ("term", T.protect(protected, T.stem_en_minimal))
    if preset == "text_ws":
        return Analyzer(preset, T.tok_whitespace)
    if preset == "text_general":
        steps = (stops(""), synonyms(), lower) if query else (stops(""), lower)
        return Analyzer(preset, T.tok_standard, () if query else html, steps)
    if preset == "text_general_rev":
        steps = (stops(""), synonyms(), lower) if query else (stops(""), lower, ("slots", T.reverse_terms))
        return Analyzer(preset, T.tok_standard, (), steps)
    if preset == "text_en":
        tail = (stops("en"), lower, ("term", T.possessive), stem)
        return Analyzer(preset, T.tok_standard, () if query else html, (synonyms(), *tail) if query else tail)
    if preset == "text_en_splitting":
        if query:
            steps = (
                ("slots", T.synonyms(rewrites, groups)), stops("en"), ("slots", _delimit_slots(T.word_delimiter(catenate=False))),
                lower, stem,
            )
            return Analyzer(preset, T.tok_whitespace, (), steps)
        return Analyzer(preset, T.tok_whitespace, html, (stops("en"), ("slots", T.word_delimiter()), lower, stem))
    if preset == "text_en_splitting_tight":
        steps = (
            ("slots", T.synonyms(rewrites, groups, False)), stops("en"), ("slots", _delimit_slots(T.word_delimiter(generate_parts=False))),
            lower, stem, ("slots", T.dedupe_tokens),
        )
        return Analyzer(preset, T.tok_whitespace, html, steps)
    if preset == "lowercase":
        return Analyzer(preset, T.tok_keyword, (), (lower,))
    if preset == "alphaOnlySort":
        return Analyzer(preset, T.tok_keyword, (), (("term", T.alpha_sort_key),))
    if preset == "text_cjk":
        return Analyzer(preset, T.tok_standard, html, (("term", T.normalize("cjk")), lower, ("slots", T.cjk_bigrams)))
    lang = preset.removeprefix("text_")
    steps = []
    for name in LANGUAGE_STEPS[lang].split():
        kind, _, variant = name.partition(":")
        if kind == "lower":
            steps.append(("term", T.lower_case(variant or None)))
        elif kind == "stop":
            steps.append(stops(lang))
        elif kind == "stop-case":
            steps.append(stops(lang, ignore_case=False))
        elif kind == "elision":
            steps.append(("term", T.elision(W.ELISIONS[lang])))
        elif kind == "hyphenation":
            # these leave no position gap
            steps += [("term", T.stop(W.HYPHENATIONS_GA)), ("tokens", F.array_compact)]
        elif kind == "normalize":
            steps.append(("term", T.normalize(variant or lang)))
        elif kind == "stem":
            steps.append(("term", T.stem_light(lang)))
        elif kind == "stemdict":
            steps.append(("term", T.stem_dict(W.STEMS_NL)))
    before = (T.html_strip, T.zero_width_to_space) if lang == "fa" else html
    return Analyzer(preset, T.tok_standard, before, tuple(steps))


def _delimit_slots(delimit: Callable) -> Callable:
    """Word parts of the terms of every position; parts of several terms at a position share its positions in turn."""

    def merged(each: Column) -> Column:
        width = F.array_max(F.transform(each, F.size))
        return F.transform(
            F.sequence(F.lit(0), width - 1),
            lambda i: F.flatten(F.transform(each, lambda p: F.coalesce(F.get(p, i), F.array().cast("array<string>")))),
        )

    def parts(slot: Column) -> Column:
        several = T.let(F.transform(slot, lambda t: delimit(F.array(t))), merged)
        # the parts of one term, as they are
        one = delimit(F.array(F.get(slot, 0)))
        return F.when(F.size(slot) == 0, F.array(slot)).when(F.size(slot) == 1, one).otherwise(several)

    return lambda slots: F.flatten(F.transform(slots, parts))

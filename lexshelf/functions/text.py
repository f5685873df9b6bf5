"""Text analysis steps as Column expressions.

A tokenizer turns a string column into ``array<string>``; the index in the array is the token's
position. A step that removes a token leaves a null there, so positions keep their gaps. Steps that
put several terms at one position, or need more positions, give "slots": ``array<array<string>>``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexshelf.functions import words as W

# Word characters, and a word: runs of them, held together by one apostrophe or full stop.
WORD_CHARS = r"\p{L}\p{N}\p{M}_"
WORD = rf"[{WORD_CHARS}]+(?:['’.][{WORD_CHARS}]+)*"
# Every character of a text lies in one of these runs.
RUNS = rf"{WORD}|[^{WORD_CHARS}]+"

TermStep = Callable[[Column], Column]


# --- whole values -----------------------------------------------------------------------------


def html_escape(c: Column) -> Column:
    """``& < > "`` as entities."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


# A character reference, the text up to the next ampersand, or an ampersand that begins none.
REFERENCES = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"
HTML_BLOCKS = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
HTML_TAGS = r"<[/!?]?[A-Za-z][^>]*>"


def html_strip(c: Column) -> Column:
    """Text without scripts, styles, comments and tags; character references decoded. Only texts with a ``<`` are searched for markup."""
    plain = F.regexp_replace(F.regexp_replace(c, HTML_BLOCKS, " "), HTML_TAGS, " ")
    return decode_references(F.when(F.instr(c, "<") > 0, plain).otherwise(c))


def decode_references(c: Column) -> Column:
    """Named and numbered character references as the characters they stand for, once; what is none stays as it is.

    A non-breaking space becomes a plain one. Only texts with an ampersand are taken apart.
    """
    names = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}
    named = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])

    def plain(part: Column) -> Column:
        hexed = F.lower(F.substr(part, F.lit(3), F.lit(1))) == "x"
        digits = F.when(hexed, F.substr(part, F.lit(4), F.length(part) - 4)).otherwise(F.substr(part, F.lit(3), F.length(part) - 3))
        code = F.conv(digits, 16, 10).cast("bigint")
        code = F.when(hexed, code).otherwise(digits.try_cast("bigint"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        numbered = F.when(code == 160, " ").when(valid, sign)
        known = F.try_element_at(named, F.substr(part, F.lit(2), F.length(part) - 2))
        return F.when(part.startswith("&#") & part.endswith(";"), F.coalesce(numbered, part)).when(
            part.startswith("&") & part.endswith(";"), F.coalesce(known, part)
        ).otherwise(part)

    parts = F.regexp_extract_all(c, F.lit(REFERENCES), F.lit(0))
    return F.when(F.instr(c, "&") > 0, F.array_join(F.transform(parts, plain), "")).otherwise(c)


def zero_width_to_space(c: Column) -> Column:
    """Persian words are joined by a zero-width non-joiner."""
    return F.translate(c, "\u200c", " ")


def char_map(c: Column, folds: Mapping[str, str] | None = None) -> Column:
    """Replace letters: one-to-one by a single ``translate``, one-to-many by ``replace``."""
    folds = W.latin_folds() if folds is None else folds
    single = {k: v for k, v in folds.items() if len(v) == 1}
    if single:
        c = F.translate(c, "".join(single), "".join(single.values()))
    for letter, plain in folds.items():
        if len(plain) != 1:
            c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def alpha_sort_key(c: Column) -> Column:
    """Lower-case letters a to z only."""
    return F.regexp_replace(F.trim(F.lower(c)), "[^a-z]", "")


# --- tokenizers: string -> array<string> ------------------------------------------------------


def tok_standard(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def tok_whitespace(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\S+"), F.lit(0))


def tok_keyword(c: Column) -> Column:
    return F.array(c)


def path_prefixes(c: Column, sep: str = "/") -> Column:
    """``/a/b`` -> ``/a``, ``/a/b``: each value at a path and the paths above it."""
    parts = F.split(c, rf"\Q{sep}\E")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), sep)
    )
    return F.filter(heads, lambda h: h != "")


# --- one term -> one term, or null to remove it -----------------------------------------------


def same(t: Column) -> Column:
    return t


def lower_case(lang: str | None = None) -> TermStep:
    if lang == "tr":
        return lambda t: F.lower(F.translate(t, "Iİ", "ıi"))
    if lang == "el":
        return lambda t: F.translate(F.lower(t), "ςάέήίόύώϊϋΐΰ", "σαεηιουωιυιυ")
    if lang == "ga":
        return lambda t: F.lower(F.regexp_replace(t, "^([nt])([AEIOUÁÉÍÓÚ])", "$1-$2"))
    return F.lower


def stop(stop_words: Iterable[str], ignore_case: bool = True) -> TermStep:
    listed = sorted({w.lower() for w in stop_words} if ignore_case else set(stop_words))
    if not listed:
        return same
    return lambda t: F.when(~(F.lower(t) if ignore_case else t).isin(listed), t)


def possessive(t: Column) -> Column:
    return F.regexp_replace(t, "['’][sS]$", "")


def elision(articles: Iterable[str]) -> TermStep:
    """Drop a leading article and its apostrophe."""
    either = "|".join(sorted(set(articles), key=lambda a: (-len(a), a)))
    return lambda t: F.regexp_replace(t, rf"^(?i:{either})['’]", "")


def protect(kept: Iterable[str], step: TermStep) -> TermStep:
    """Apply ``step`` to all but the ``kept`` words."""
    listed = sorted(set(kept))
    if not listed:
        return step
    return lambda t: F.when(t.isin(listed), t).otherwise(step(t))


def stem_dict(stems: Mapping[str, str], step: TermStep | None = None) -> TermStep:
    """Listed words get the stem given for them, others go through ``step``."""
    table = F.create_map(*[F.lit(x) for pair in sorted(stems.items()) for x in pair])
    return lambda t: F.when(t.isin(sorted(stems)), F.element_at(table, t)).otherwise(step(t) if step else t)


def stem_en_minimal(t: Column) -> Column:
    """Plural endings only (Harman's S-stemmer)."""
    size = F.length(t)
    ends = t.endswith
    return (
        F.when((size < 3) | ~ends("s") | ends("us") | ends("ss"), t)
        .when(ends("ies") & (size > 3) & ~ends("aies") & ~ends("eies"), F.concat(F.left(t, size - 3), F.lit("y")))
        .when(ends("ies") | ends("aes") | ends("oes") | ends("ees"), t)
        .otherwise(F.left(t, size - 1))
    )


def suffix_step(rules: list[tuple[int, str, str]]) -> TermStep:
    """The first rule whose length and ending fit rewrites the ending: (longer than, ending, replacement)."""

    def apply(t: Column) -> Column:
        size, out = F.length(t), None
        for longer, ending, new in rules:
            hit = (size > longer) & t.rlike(f"(?:{ending})$")
            rewritten = F.regexp_replace(t, f"(?:{ending})$", new)
            out = F.when(hit, rewritten) if out is None else out.when(hit, rewritten)
        return out.otherwise(t)

    return apply


def let(value: Column, step: TermStep) -> Column:
    """``step(value)`` with ``value`` worked out once, however often the step mentions it."""
    return F.get(F.transform(F.array(value), step), 0)


def chain(*steps: TermStep) -> TermStep:
    def apply(t: Column) -> Column:
        for number, step in enumerate(steps):
            t = let(t, step) if number else step(t)
        return t

    return apply


def fold(source: str, target: str) -> TermStep:
    return lambda t: F.translate(t, source, target)


# Short published suffix tables, (longer than, ending, replacement), first fit wins.
LIGHT_SUFFIXES = {
    "de": [
        [(5, "ern", ""), (4, "em|en|er|es", ""), (3, "e", ""), (3, "([bdfghklmnt])s", "$1")],
        [(5, "est", ""), (4, "er|en", ""), (4, "([bdfghklmnt])st", "$1")],
    ],
    "fr": [
        [(5, "aux", "al"), (5, "x", ""), (5, "s", "")],
        [(5, "r", "")],
        [(5, "e", "")],
        [(5, "é", "")],
    ],
    "es": [
        [(4, "eses", "es"), (4, "ces", "z"), (4, "([oae])s", ""), (4, "[oae]", "")],
    ],
    "it": [
        [(5, "ie|he|e", ""), (5, "hi|ii|i", ""), (5, "ia|a", ""), (5, "io|o", "")],
    ],
    "pt": [
        [
            (4, "([rslz])es", "$1"), (3, "ns", "m"), (4, "(?:e|é)is", "el"), (4, "ais", "al"), (4, "óis", "ol"),
            (4, "is", "il"), (3, "ões|ães", "ão"), (6, "mente", ""), (3, "s", ""),
        ],
        [(4, "[eao]", "")],
    ],
}
# Accents folded by the light stemmers.
LIGHT_FOLDS = {
    "de": ("äàáâöòóôïìíîüùúû", "aaaaooooiiiiuuuu"),
    "es": ("àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii"),
    "it": ("àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii"),
    "pt": ("àáâäãòóôöõèéêëùúûüìíîïç", "aaaaaoooooeeeeuuuuiiiic"),
}


def stem_light(lang: str) -> TermStep:
    steps = [suffix_step(rules) for rules in LIGHT_SUFFIXES[lang]]
    if lang in LIGHT_FOLDS:
        step = fold(*LIGHT_FOLDS[lang])
        steps = [*steps, step] if lang == "pt" else [step, *steps]
    return chain(*steps)


# Letters unified per script, (from, to); letters beyond the end of "to" are dropped.
SCRIPT_FOLDS = {
    "ar": [("آأإىةـًٌٍَُِّْ", "ااايه")],
    "fa": [("یےکۀہۂ", "ييكههه")],
    "ckb": [("يىكە‌", "ییکە")],
    "hi": [("ँ", "ं"), ("़्‍‌", ""), ("ीूैौआईऊऐऔ", "िुेोअइउएओ")],
    "de": [],
}


def normalize(lang: str) -> TermStep:
    """Spelling variants of one letter brought to one form."""
    if lang == "cjk":
        wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
        plain = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
        return fold(wide, plain)
    if lang == "de":
        return lambda t: F.replace(
            F.regexp_replace(F.translate(t, "äöü", "aou"), "(^|[^aeq])ue", "$1u"), F.lit("ß"), F.lit("ss")
        )
    return chain(*[fold(*pair) for pair in SCRIPT_FOLDS[lang]])


# --- tokens -> slots (several terms at a position, or more positions) ---------------------------


def word_parts(t: Column, split_on_case_change: bool = True) -> Column:
    """Parts of a token: runs of letters (cut before an upper-case letter) and runs of digits."""
    letters = r"\p{Lu}*[\p{Ll}\p{Lm}\p{Lo}\p{Lt}\p{M}]+|\p{Lu}+" if split_on_case_change else r"[\p{L}\p{M}]+"
    return F.regexp_extract_all(F.regexp_replace(t, "['’][sS]$", ""), F.lit(rf"{letters}|\p{{N}}+"), F.lit(0))


#: Tokens of one part, wherever parts may be cut: lower-case letters after at most one upper-case letter, or digits, amid other signs.
WHOLE = r"\A[^\p{L}\p{M}\p{N}'’]*(\p{Lu}?\p{Ll}+|[0-9]+)[^\p{L}\p{M}\p{N}]*\z"


def word_delimiter(
    generate_parts: bool = True, catenate: bool = True, split_on_case_change: bool = True
) -> Callable[[Column], Column]:
    """``Wi-Fi500`` -> Wi, Fi, 500 at following positions; catenated words and numbers at the first part."""
    mark = "\u0001"
    hole = F.array(F.array().cast("array<string>"))

    def run_slots(r: Column) -> Column:
        if not generate_parts:
            return F.array(F.array(F.array_join(r, "")))
        if not catenate:
            return F.transform(r, lambda p: F.array(p))
        whole = lambda p, i: F.when((i == 0) & (F.size(r) > 1), F.array(p, F.array_join(r, ""))).otherwise(F.array(p))
        return F.transform(r, whole)

    def parted(t: Column) -> Column:
        joined = F.array_join(word_parts(t, split_on_case_change), mark)
        runs = F.regexp_extract_all(joined, F.lit(rf"[\p{{L}}\p{{M}}{mark}]+|[\p{{N}}{mark}]+"), F.lit(0))
        cut = F.transform(runs, lambda r: F.split(F.regexp_replace(r, f"^{mark}|{mark}$", ""), mark))
        slots = F.flatten(F.transform(cut, lambda r: run_slots(r)))
        return let(slots, lambda s: F.when(F.size(s) == 0, hole).otherwise(s))

    def slots_of(t: Column) -> Column:
        # most tokens have one part, and one search finds it
        found = let(F.regexp_extract(t, WHOLE, 1), lambda p: F.when(p != "", F.array(F.array(p))).otherwise(parted(t)))
        return F.when(t.isNull(), hole).otherwise(found)

    return lambda tokens: F.flatten(F.transform(tokens, slots_of))


def synonyms(
    rewrites: list[tuple[str, list[list[str]]]] | None = None,
    groups: list[list[str]] | None = None,
    expand: bool = True,
) -> Callable[[Column], Column]:
    """Replace by rewrite rules; put the words of a group at one position (or its first word only).

    A rewrite's targets are alternatives, each a list of words taking following positions.
    """
    table: dict[str, list[list[str]]] = {}
    for source, targets in W.SYNONYM_REWRITES if rewrites is None else rewrites:
        width = max(len(t) for t in targets)
        table[source.lower()] = [[t[i].lower() for t in targets if i < len(t)] for i in range(width)]
    for group in W.SYNONYM_GROUPS if groups is None else groups:
        low = [g.lower() for g in group]
        for word in low:
            table[word] = [low if expand else low[:1]]
    slots = F.create_map(
        *[
            x
            for word, places in sorted(table.items())
            for x in (F.lit(word), F.array(*[F.array(*[F.lit(t) for t in place]) for place in places]))
        ]
    )
    listed = sorted(table)

    def slots_of(t: Column) -> Column:
        low = F.lower(t)
        own = F.array(F.filter(F.array(t), lambda x: x.isNotNull()))
        return F.when(low.isin(listed), F.element_at(slots, low)).otherwise(own)

    return lambda tokens: F.flatten(F.transform(tokens, slots_of))


def cjk_bigrams(tokens: Column) -> Column:
    """Overlapping pairs of ideographs and kana; other tokens, and single signs, as they are.

    A token is parted first where such signs meet others. The long-vowel mark has no script of its own and counts as kana.
    """
    signs = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\u30FC"

    def slots_of(run: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))), lambda i: F.array(F.substr(run, i, F.lit(2)))
        )
        return F.when(run.rlike(f"^[{signs}]{{2,}}$"), pairs).otherwise(F.array(F.array(run)))

    def runs(t: Column) -> Column:
        parted = F.regexp_extract_all(t, F.lit(f"[{signs}]+|[^{signs}]+"), F.lit(0))
        return F.when(t.rlike(f"[{signs}]"), F.flatten(F.transform(parted, slots_of))).otherwise(F.array(F.array(t)))

    return F.flatten(F.transform(F.array_compact(tokens), runs))


#: Stands before a reversed term, so that it never equals or starts like a plain one.
REVERSED = "\u0001"


def reverse_terms(tokens: Column) -> Column:
    """Each term and its marked reverse at one position, so that a leading wildcard is a prefix."""
    both = lambda t: F.array(t, F.concat(F.lit(REVERSED), F.reverse(t)))
    return F.transform(tokens, lambda t: F.when(t.isNotNull(), both(t)).otherwise(F.array().cast("array<string>")))


def dedupe_tokens(slots: Column) -> Column:
    """Equal terms at one position only once."""
    return F.transform(slots, F.array_distinct)


def payloads(c: Column, delimiter: str = "|") -> Column:
    """``foo|1.4 bar|2`` -> array of (term, payload); a term without one has payload 1."""
    return F.transform(
        tok_whitespace(c),
        lambda t: F.struct(
            F.substring_index(t, delimiter, 1).alias("term"),
            F.coalesce(
                F.when(F.instr(t, delimiter) > 0, F.substring_index(t, delimiter, -1)).try_cast("double"), F.lit(1.0)
            ).alias("payload"),
        ),
    )

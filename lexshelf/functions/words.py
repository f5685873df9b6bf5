"""The short word lists and tables the analysis chains are defined by.

Longer lists are parameters: see ``lexshelf.sources.wordlists``.
"""

from __future__ import annotations

import unicodedata

# English stop words.
STOP_EN = (
    "stopworda stopwordb a an and are as at be but by for if in into is it no not of on or such that the their "
    "then there these they this to was will with"
).split()

# French stop words.
STOP_FR = (
    "au aux avec ce ces dans de des du elle en et eux il je la le leur lui ma mais me même mes moi mon ne nos "
    "notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous "
    "c d j l à m n s t y "
    "été étée étées étés étant suis es est sommes êtes sont serai seras sera serons serez seront serais serait "
    "serions seriez seraient étais était étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez "
    "soient fusse fusses fût fussions fussiez fussent "
    "ayant eu eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions auriez "
    "auraient avais avait avions aviez avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse eusses "
    "eût eussions eussiez eussent "
    "ceci cela celà cet cette ici ils les leurs quel quels quelle quelles sans soi"
).split()

# Words never stemmed.
PROTECTED = ["dontstems", "zwhacky"]

# Query synonyms. (source, target words) rewrites and groups of equals.
SYNONYM_REWRITES = [
    ("aaafoo", [["aaabar"]]),
    ("bbbfoo", [["bbbfoo", "bbbbar"]]),
    ("cccfoo", [["cccbar", "cccbaz"]]),
    ("pixima", [["pixma"]]),
]
SYNONYM_GROUPS = [
    ["fooaaa", "baraaa", "bazaaa"],
    ["GB", "gib", "gigabyte", "gigabytes"],
    ["MB", "mib", "megabyte", "megabytes"],
    ["Television", "Televisions", "TV", "TVs"],
]

# Articles dropped before an apostrophe, per language.
ELISIONS = {
    "ca": "d l m n s t".split(),
    "fr": "l m t qu n s j d c jusqu quoiqu lorsqu puisqu".split(),
    "ga": "d m b".split(),
    "it": (
        "c l all dall dell nell sull coll pell gl agl dagl degl negl sugl un m t s v d"
    ).split(),
}

# Irish prefixes cut off by a hyphen.
HYPHENATIONS_GA = "h n t".split()

# Dutch stems that override the stemmer.
STEMS_NL = {"fiets": "fiets", "bromfiets": "bromfiets", "ei": "eier", "kind": "kinder"}

# Exchange rates (from, to, rate).
RATES = [
    ("USD", "ARS", 4.333871), ("USD", "AUD", 1.025768), ("USD", "EUR", 0.743676), ("USD", "BRL", 1.881093),
    ("USD", "CAD", 1.030815), ("USD", "CLP", 519.0996), ("USD", "CNY", 6.387310), ("USD", "CZK", 18.47134),
    ("USD", "DKK", 5.515436), ("USD", "HKD", 7.801922), ("USD", "HUF", 215.6169), ("USD", "ISK", 118.1280),
    ("USD", "INR", 49.49088), ("USD", "XDR", 0.641358), ("USD", "ILS", 3.709739), ("USD", "JPY", 76.32419),
    ("USD", "KRW", 1169.173), ("USD", "KWD", 0.275142), ("USD", "MXN", 13.85895), ("USD", "NZD", 1.285159),
    ("USD", "NOK", 5.859035), ("USD", "PKR", 87.57007), ("USD", "PEN", 2.730683), ("USD", "PHP", 43.62039),
    ("USD", "PLN", 3.310139), ("USD", "RON", 3.100932), ("USD", "RUB", 32.14663), ("USD", "SAR", 3.750465),
    ("USD", "SGD", 1.299352), ("USD", "ZAR", 8.329761), ("USD", "SEK", 6.883442), ("USD", "CHF", 0.906035),
    ("USD", "TWD", 30.40283), ("USD", "THB", 30.89487), ("USD", "AED", 3.672955), ("USD", "UAH", 7.988582),
    ("USD", "GBP", 0.647910), ("EUR", "GBP", 0.869914), ("EUR", "NOK", 7.800095), ("GBP", "NOK", 8.966508),
]

# Our own short lists of frequent function words, for telling languages apart.
FUNCTION_WORDS = {
    "en": "the and of to in that is was for with this are from have not but they which".split(),
    "de": "der die das und ist nicht mit den von zu ein eine auf für sich dem im auch".split(),
    "fr": "le la les et des est une dans pour que qui pas sur avec ce il elle du".split(),
    "es": "el los las y en que por con para una del es se no su al como más".split(),
}


def latin_folds() -> dict[str, str]:
    """Accented Latin letter -> plain letters, by Unicode decomposition plus the letters that have none."""
    # Letters without a decomposition.
    folds = {
        "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "ß": "ss", "Þ": "TH", "þ": "th",
        "Ð": "D", "ð": "d", "Ĳ": "IJ", "ĳ": "ij", "ﬅ": "ft", "ﬆ": "st",
    }
    for code in [*range(0xC0, 0x100), 0x178, *range(0xFB00, 0xFB05)]:
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if c.isascii() and c.isalpha())
        if plain and letter not in folds:
            folds[letter] = plain
    return folds

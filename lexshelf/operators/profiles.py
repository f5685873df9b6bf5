"""Language identification by character n-gram profiles that are learned from rows.

A profile has, for every n-gram, a whole-number weight per language: a thousand times the logarithm of its share among the language's n-grams, with
one added to every count, so that rows may be summed in any order. A text takes the language whose weights add up highest over
all its n-grams. N-grams are counted in the tasks, many texts at a time: only sums per n-gram and language, the different n-grams of a bundle of
texts with their weights, and sums per text are shuffled.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.functions.analyzers import Analyzer
from lexshelf.session import cut

# executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 3
#: Signs that are counted at a time; a longer text is taken in stretches.
SIGNS = 1 << 20
#: Signs of a bundle of texts; one text may have more.
BUNDLE = 1 << 22
#: Different n-grams of a language that a task holds before it hands them on.
HELD = 1 << 20
#: Largest table of all n-grams of an alphabet; beyond it they are sorted.
DENSE = 1 << 22


def plain(text: Column) -> Column:
    """The letters of a text in lower case; what stands between words is one blank, also at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def grams(text: Column, size: int = SIZE) -> Column:
    """Overlapping n-grams of a text's ``plain`` signs."""

    def cuts(signs: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(signs) - size, F.lit(0)))
        each = F.transform(places, lambda i: F.concat(*[F.get(signs, i + step) for step in range(size)]))
        return F.when(F.size(signs) >= size, each).otherwise(F.array().cast("array<string>"))

    # the array of one: all cuts share one array of the text's signs, which would else be made anew for each
    return F.flatten(F.transform(F.array(F.split(plain(text), "")), cuts))


GRAMS = Analyzer("grams", grams)


def _coded(texts: list):
    """(different n-grams as numbers, which of them stands at every place, text of every place) of some texts, SIGNS signs at a time."""
    import numpy as np

    def stretches():
        held, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text) - SIZE + 1, SIGNS):
                part = text[at : at + SIGNS + SIZE - 1]
                held.append((i, part))
                size += len(part)
                if size >= SIGNS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    for held in stretches():
        signs = np.frombuffer("".join(t for _, t in held).encode("utf-32-le"), "<u4")
        seen = np.zeros(0x110000, bool)
        seen[signs] = True
        letters = np.flatnonzero(seen).astype(np.uint64)
        number = np.zeros(0x110000, np.int64)
        number[letters] = np.arange(len(letters))
        sizes = np.array([len(t) for _, t in held])
        inside = np.ones(len(signs), bool)
        for back in range(1, SIZE):
            inside[np.cumsum(sizes) - back] = False
        starts = np.flatnonzero(inside)
        number, many = number[signs], len(letters)
        code = np.zeros(len(starts), np.int64)
        for step in range(SIZE):
            code = code * many + number[starts + step]
        if many**SIZE <= DENSE:
            found = np.zeros(many**SIZE, np.int64)
            found[code] = 1
            different = np.flatnonzero(found)
            found[different] = np.arange(len(different))
            place = found[code]
        else:
            different, place = np.unique(code, return_inverse=True)
        wide, rest = np.zeros(len(different), np.uint64), different
        for step in range(SIZE):
            wide |= letters[rest % many] << np.uint64(21 * step)
            rest = rest // many
        yield wide, place, np.repeat(np.array([i for i, _ in held]), sizes - SIZE + 1)


def _strings(wide) -> list[str]:
    import numpy as np

    signs = np.stack([(wide >> np.uint64(21 * step)) & np.uint64((1 << 21) - 1) for step in reversed(range(SIZE))], axis=1)
    text = signs.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + SIZE] for i in range(0, len(text), SIZE)]


def _numbers(strings: list[str]):
    import numpy as np

    signs = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4").reshape(-1, SIZE).astype(np.uint64)
    out = np.zeros(len(signs), np.uint64)
    for step in range(SIZE):
        out = (out << np.uint64(21)) | signs[:, step]
    return out


def _counted(batches):
    """(lang, term, tf): n-grams of the texts of a task by language."""
    import numpy as np
    import pyarrow as pa

    held: dict = {}

    def summed(parts: list):
        wide, which = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return wide, np.bincount(which, np.concatenate([n for _, n in parts]), len(wide)).astype(np.int64)

    def handed(lang, wide, n):
        for at in range(0, len(wide), 1 << 16):
            some = slice(at, at + (1 << 16))
            terms = pa.array(_strings(wide[some]), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), kind), terms, pa.array(n[some])], ["lang", "term", "tf"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        texts: dict = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text is not None:
                texts.setdefault(lang, []).append(text)
        for lang, some in texts.items():
            for wide, place, _ in _coded(some):
                held.setdefault(lang, []).append((wide, np.bincount(place, minlength=len(wide))))
                if sum(len(w) for w, _ in held[lang]) >= HELD:
                    held[lang] = [summed(held[lang])]
                    if len(held[lang][0][0]) >= HELD // 2:
                        yield from handed(lang, *held.pop(lang)[0])
    for lang, parts in held.items():
        yield from handed(lang, *summed(parts))


def _bundles(batches):
    """(bundle, keys, texts, terms): some texts and their different n-grams."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = [0 if t is None else len(t) for t in batch.column(1).to_pylist()]
        edges, size = [0], 0
        for i, n in enumerate(sizes):
            if size and size + n > BUNDLE:
                edges.append(i)
                size = 0
            size += n
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            some = batch.slice(a, b - a)
            found = [wide for wide, _, _ in _coded([t or "" for t in some.column(1).to_pylist()])]
            if not found:
                continue
            lists = [pa.array([0, n], pa.int32()) for n in (b - a, b - a)]
            keys, texts = (pa.ListArray.from_arrays(x, pa.concat_arrays([some.column(c)])) for c, x in enumerate(lists))
            terms = pa.array([_strings(np.unique(np.concatenate(found)))], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), keys, texts, terms], ["bundle", "keys", "texts", "terms"])
            number += 1


def _summed(batches):
    """(key, len, gains): n-grams of every text of a bundle, and the sums of what they have above unseen ones by language."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            keys, texts = batch.column("keys")[i].values, batch.column("texts")[i].values.to_pylist()
            terms = batch.column("found")[i].values
            known = _numbers(terms.field("term").to_pylist()) if terms is not None and len(terms) else np.zeros(0, np.uint64)
            langs = terms.field("lang").to_pylist() if len(known) else []
            gain = terms.field("gain").to_numpy(zero_copy_only=False) if len(known) else np.zeros(0, np.int64)
            own: dict = {}
            for at, lang in enumerate(langs):
                own.setdefault(lang, []).append(at)
            tables = {}
            for lang, at in own.items():
                at = np.array(at)[np.argsort(known[at], kind="stable")]
                tables[lang] = (known[at], gain[at])
            size = np.zeros(len(texts), np.int64)
            sums = {lang: np.zeros(len(texts), np.int64) for lang in tables}
            for wide, place, text in _coded([t or "" for t in texts]):
                size += np.bincount(text, minlength=len(texts))
                for lang, (numbers, gains) in tables.items():
                    at = np.minimum(np.searchsorted(numbers, wide), len(numbers) - 1)
                    each = np.append(0, np.cumsum(np.where(numbers[at] == wide, gains[at], 0)[place]))
                    new = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                    np.add.at(sums[lang], text[new], np.diff(each[np.append(new, len(text))]))
            kept = np.flatnonzero(size)
            flat = [pa.array([lang for _ in kept for lang in tables], pa.string())]
            flat.append(pa.array(np.array([sums[lang][kept] for lang in tables], np.int64).T.ravel() if tables else [], pa.int64()))
            ends = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * len(tables))
            gains = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["lang", "gain"]))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(kept)), pa.array(size[kept]), gains], ["key", "len", "gains"])


def learn(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, term, weight) and, under the empty n-gram, the weight of one that a language has never shown; a table to be stored."""
    spoken = rows.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), plain(F.col(text)).alias("text"))
    counted = spoken.mapInArrow(_counted, "lang string, term string, tf bigint")
    counts = cut(counted.groupBy("lang", "term").agg(F.sum("tf").alias("n")))
    kinds = counts.select("term").distinct().agg(F.count(F.lit(1))).scalar()
    totals = counts.groupBy("lang").agg((F.sum("n") + kinds).alias("_all"))

    def weight(n: Column) -> Column:
        return F.floor(1000 * F.log((n + 1) / F.col("_all"))).cast("bigint")

    seen = counts.join(totals, "lang").select("lang", "term", weight(F.col("n")).alias("weight"))
    return seen.unionByName(totals.select("lang", F.lit("").alias("term"), weight(F.lit(0)).alias("weight")))


def identify(df: DataFrame, key: str, text: str, profiles: DataFrame, fallback: str) -> DataFrame:
    """(key, language_s) of one text per key; ``fallback`` for texts without a letter. Of equal sums the first language wins.

    A text's sum in a language is that of all its n-grams as never seen, plus what the seen ones have above that.
    """
    unseen = cut(profiles.where("term = ''").select("lang", F.col("weight").alias("_least")))
    gains = cut(profiles.where("term <> ''").join(unseen, "lang").select("term", "lang", (F.col("weight") - F.col("_least")).alias("gain")))
    kind = df.schema[key].dataType.simpleString()
    texts = df.select(F.col(key), plain(F.col(text)).alias("text"))
    bundles = cut(texts.mapInArrow(_bundles, f"bundle bigint, keys array<{kind}>, texts array<string>, terms array<string>"))
    met = bundles.select("bundle", F.explode("terms").alias("term")).join(gains, "term")
    found = met.groupBy("bundle").agg(F.collect_list(F.struct("term", "lang", "gain")).alias("found"))
    each = bundles.drop("terms").join(found, "bundle", "left").mapInArrow(_summed, f"key {kind}, len bigint, gains array<struct<lang:string,gain:bigint>>")
    each = cut(each.withColumnRenamed("key", key))
    sums = each.select(key, F.inline("gains")).groupBy(key, "lang").agg(F.sum("gain").alias("gain"))
    sizes = each.groupBy(key).agg(F.max("len").alias("len"))
    # one row per text and language, also where no n-gram of the text was seen in it
    langs = unseen.agg(F.collect_list(F.struct("lang", "_least"))).scalar()
    every = sizes.select(key, "len", F.inline(langs))
    score = F.col("len") * F.col("_least") + F.coalesce("gain", F.lit(0))
    best = every.join(sums, [key, "lang"], "left").groupBy(key).agg(F.min(F.struct((-score).alias("s"), "lang")).alias("_best"))
    return df.select(key).join(best, key, "left").select(key, F.coalesce("_best.lang", F.lit(fallback)).alias("language_s"))

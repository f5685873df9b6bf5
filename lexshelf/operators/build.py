"""Index build: from document trees to flat document-level and section-level records.

Input ``sections``: ``doc_oid, sec_path, sec_no, doc_type, text, meta map<string,array<string>>``, the
top section having sec_no 1 and an empty path. A section-level record is one row. A document-level
record holds the fields of all its sections as repeated values; it is kept as one row per value,
so no document, however large, has to fit into one row or one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexshelf.functions.text import html_escape, tok_standard
from lexshelf.session import literal_table, spread_join

# Metadata never taken into the all-metadata index.
NOT_INDEXED = ["Identifier", "classifytype", "assocfilepath"]
# Section types that are indexed.
INDEXED_TYPES = ["indexed_section", "indexed_doc"]


def section_key() -> Column:
    return F.when(F.col("sec_path") == "", F.col("doc_oid")).otherwise(F.concat_ws(".", "doc_oid", "sec_path"))


def meta_values(name: str, column: str = "meta") -> Column:
    """Values of a metadata element, an empty array if there is none."""
    return F.coalesce(F.try_element_at(column, F.lit(name)), F.array().cast("array<string>"))


def eligible(sections: DataFrame, keep_placeholders: bool = False, wanted: Column | None = None) -> DataFrame:
    """Sections to index: of documents of type indexed_doc, unless the section's own type says no.

    With ``keep_placeholders`` (section level) the others stay as rows with ``indexed`` false, to be
    written with their key only. ``wanted``: the subcollection a document must belong to.
    """
    kind = F.coalesce(F.get(meta_values("gsdldoctype"), 0), F.lit("indexed_section"))
    good = F.when(kind == "", True).otherwise(kind.isin(INDEXED_TYPES))
    if wanted is not None:
        good = good & F.coalesce(wanted, F.lit(False))
    rows = sections.filter(F.col("doc_type") == "indexed_doc").withColumn("indexed", good)
    return rows if keep_placeholders else rows.filter("indexed")


def subcollection(df: DataFrame, expressions: list[str]) -> DataFrame:
    """Documents that satisfy any of the named SQL expressions."""
    keep = F.lit(False)
    for text in expressions:
        keep = keep | F.coalesce(F.expr(text), F.lit(False))
    return df.filter(keep)


def language_filter(df: DataFrame, languages: str, column: str = "Language") -> DataFrame:
    """``en,fr`` keeps those, ``!de`` keeps the others."""
    c = F.col(column)
    if languages.startswith("!"):
        return df.filter(c.isNull() | ~c.isin(languages[1:].split(",")))
    return df.filter(c.isin(languages.split(",")))


def short_name(field: str, taken: dict[str, str]) -> str:
    """Two-letter code of a field, numbered if another field has it already."""
    if field in taken:
        return taken[field]
    if field in ("allfields", "text"):
        code = "ZZ" if field == "allfields" else "TX"
    else:
        code = field.split(",")[0].rsplit(".", 1)[-1][:2].upper()
        used, n = set(taken.values()) | {"ZZ", "TX"}, 1
        while (code if n == 1 else f"{code}{n}") in used:
            n += 1
        code = code if n == 1 else f"{code}{n}"
    taken[field] = code
    return code


def inherit_metadata(sections: DataFrame, mode: str = "always") -> DataFrame:
    """Give each lower section ``top_meta``, the metadata of its document's top section.

    The lookup is split over tasks, so one document may have very many sections. ``mode`` is
    recorded for ``merged_values``.
    """
    if mode not in ("always", "unless_section_metadata_exists"):
        raise ValueError(mode)
    tops = sections.filter(F.col("sec_no") == 1).select("doc_oid", F.col("meta").alias("top_meta"))
    return spread_join(sections, tops, ["doc_oid"], "left", by=F.col("sec_no").cast("bigint"))


def merged_values(name: str, mode: str | None) -> Column:
    """A section's own values of an element and, as ``mode`` says, its document's."""
    own = meta_values(name)
    if mode is None:
        return own
    top = meta_values(name, "top_meta")
    lower = F.col("sec_no") != 1
    if mode == "always":
        return F.when(lower, F.concat(own, top)).otherwise(own)
    return F.when(lower & (F.size(own) == 0), top).otherwise(own)


def field_text(spec: str, mode: str | None = None) -> Column:
    """Text of one field of the index spec: the section text first, then the metadata values, space-joined."""
    names = spec.split(",")
    parts = [html_escape(F.col("text"))] if "text" in names else []
    parts = [F.when(p != "", p) for p in parts]
    values = [merged_values(n.removeprefix("ex."), mode) for n in names if n != "text"]
    if values:
        joined = F.array_join(F.transform(F.concat(*values), html_escape), " ")
        parts.append(F.when(F.size(F.concat(*values)) > 0, joined))
    return F.concat_ws(" ", *parts)


def project_fields(sections: DataFrame, spec: str, mode: str | None = None, trim: bool = True) -> DataFrame:
    """Fielded records: ``a;b,c;text`` gives one column per field, named by its short name.

    ``,`` merges elements into one field, a leading ``top`` takes the top section only, a leading
    ``ex.`` of an element is dropped, ``allfields`` (ZZ) is everything projected.
    """
    if mode is not None:
        sections = inherit_metadata(sections, mode)
    taken: dict[str, str] = {}
    columns: dict[str, Column] = {}
    for field in spec.split(";"):
        if field in ("allfields", "metadata"):
            continue
        top = field.startswith("top")
        name = field.removeprefix("top")
        value = field_text(name, mode)
        columns[short_name(name, taken)] = F.when(F.col("sec_no") == 1, value).otherwise("") if top else value
    out = sections.withColumns(columns)
    if "allfields" in spec.split(";"):
        out = allfields(out, list(columns))
    if not trim:
        return out
    clean = {c: F.regexp_replace(c, r"^\s+|\s+$", "") for c in columns}
    return out.withColumns({c: F.when(v != "", v) for c, v in clean.items()})


def allfields(df: DataFrame, columns: list[str], name: str = "ZZ") -> DataFrame:
    """Catch-all field: the text of the others one after the other."""
    return df.withColumn(name, F.concat_ws(" ", *[F.when(F.col(c) != "", F.col(c)) for c in columns]))


def all_metadata(sections: DataFrame, specified: list[str] = ()) -> DataFrame:
    """Every metadata value not indexed already, one row per value (doc_oid, sec_no, field, item_no, value)."""
    pairs = sections.select("doc_oid", "sec_no", F.explode("meta").alias("field", "_values")).filter(
        ~F.col("field").isin([*NOT_INDEXED, *specified]) & ~F.col("field").startswith("gsdl")
    )
    return (
        pairs.select("doc_oid", "sec_no", "field", F.posexplode("_values").alias("item_no", "value"))
        .filter(F.col("value") != "")
        .withColumn("value", html_escape(F.col("value")))
    )


def field_map(spark: SparkSession, spec: str, sections: DataFrame | None = None) -> DataFrame:
    """Field name -> short name: the fields of the index spec as ``project_fields`` names its columns, in their order,
    then every other metadata name of the collection, in the order of the names, by the same rule.
    """
    taken: dict[str, str] = {}
    listed = [f.removeprefix("top") for f in spec.split(";") if f not in ("allfields", "metadata")]
    for field in listed:
        short_name(field, taken)
    rows = [("allfields", "ZZ"), *((field, taken[field]) for field in dict.fromkeys(listed))]
    if "text" not in taken:
        rows.append(("text", "TX"))
    fixed = literal_table(spark, rows, "field string, short_name string")
    if sections is None:
        return fixed
    names = (
        sections.select(F.explode(F.map_keys("meta")).alias("field"))
        .distinct()
        .filter(~F.col("field").isin([*NOT_INDEXED, *taken]) & ~F.col("field").startswith("gsdl"))
    )
    used = {}
    for code in ["ZZ", "TX", *taken.values()]:
        used[code[:2]] = max(used.get(code[:2], 0), int(code[2:] or 1))
    ahead = F.create_map(*[F.lit(x) for pair in used.items() for x in pair])
    place = F.row_number().over(Window.partitionBy("_code").orderBy("field")) + F.coalesce(F.try_element_at(ahead, F.col("_code")), F.lit(0))
    coded = names.withColumn("_code", F.upper(F.left(F.substring_index("field", ".", -1), F.lit(2)))).withColumn("_n", place).select(
        "field",
        F.concat("_code", F.when(F.col("_n") > 1, F.col("_n").cast("string")).otherwise("")).alias("short_name"),
    )
    return fixed.union(coded)


def sort_facet_fields(
    sections: DataFrame, sorts: list[str], facets: list[str], mode: str | None = None, level: str = "section"
) -> DataFrame:
    """``by*`` array columns for the sort and facet fields, each once; ``rank`` and ``none`` are no fields.

    Document level takes the top section only.
    """
    if level == "document":
        sections, mode = sections.filter(F.col("sec_no") == 1), None
    elif mode is not None:
        sections = inherit_metadata(sections, mode)
    taken: dict[str, str] = {}
    columns = {}
    for field in dict.fromkeys([*sorts, *facets]):
        if field in ("rank", "none", "text", "allfields", "metadata"):
            continue
        values = [merged_values(_strip_ex(n), mode) for n in field.split(",")]
        columns["by" + short_name(field, taken)] = F.transform(F.concat(*values), html_escape)
    return sections.withColumns(columns)


def _strip_ex(name: str) -> str:
    """``ex.Title`` -> ``Title``; ``ex.dc.Title`` stays."""
    bare = name.removeprefix("ex.")
    return name if "." in bare else bare


def present_fields(df: DataFrame) -> DataFrame:
    """How many records really have a value in each ``by*`` field."""
    names = [c for c in df.columns if c.startswith("by")]
    one = df.agg(*[F.count_if(F.size(c) > 0).alias(c) for c in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("records")) for c in names])))


def build_sec_index(sections: DataFrame, spec: str, sorts: list[str] = (), facets: list[str] = (),
                    mode: str | None = None, sort_mode: str | None = None) -> DataFrame:
    """One record per section, keyed ``doc.section``; a section not indexed keeps its key only."""
    rows = eligible(sections, keep_placeholders=True)
    before = set(rows.columns)
    rows = project_fields(rows, spec, mode)
    if "top_meta" in rows.columns:
        rows = rows.drop("top_meta")
    rows = sort_facet_fields(rows, list(sorts), list(facets), sort_mode)
    if "top_meta" in rows.columns:
        rows = rows.drop("top_meta")
    fields = [c for c in rows.columns if c not in before]
    return rows.select(
        section_key().alias("docOID"), "doc_oid", "sec_no", *[F.when(F.col("indexed"), F.col(c)).alias(c) for c in fields]
    )


def build_doc_index(sections: DataFrame, spec: str, mode: str | None = None) -> DataFrame:
    """Document records, one row per field value: (docOID, field, sec_no, value)."""
    rows = eligible(sections)
    before = set(rows.columns) | {"top_meta"}
    rows = project_fields(rows, spec, mode)
    fields = [c for c in rows.columns if c not in before]
    bag = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in fields])
    return (
        rows.select(F.col("doc_oid").alias("docOID"), "sec_no", F.explode(bag).alias("_f"))
        .select("docOID", "_f.field", "sec_no", "_f.value")
        .filter(F.col("value") != "")
    )


def ingest_stats(sections: DataFrame, processed: DataFrame, value: str = "value") -> DataFrame:
    """Documents, sections and bytes read, and bytes written to the index.

    ``sections`` are all sections of indexed documents, also those that are not indexed themselves.
    """
    raw = sections.agg(
        F.count_if(F.col("sec_no") == 1).alias("docs"),
        F.count(F.lit(1)).alias("sections"),
        F.coalesce(F.sum(F.when(F.col("indexed"), F.octet_length("text"))), F.lit(0)).alias("bytes"),
    )
    done = processed.agg(F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).alias("processed_bytes"))
    return raw.withColumn("processed_bytes", done.scalar())


def latest(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The last change of each key; of several with the same number, the one of greatest hash. One row per key.

    The winner is found by aggregation, so a key may change very often; of equal rows one is kept.
    """
    hashed = changes.withColumn("_hash", F.xxhash64(*[F.to_json(F.struct(F.col(c))) for c in changes.columns]))
    last = hashed.groupBy(key).agg(F.max(F.struct(seq, "_hash")).alias("_last"))
    last = last.select(key, F.col(f"_last.{seq}").alias(seq), "_last._hash")
    return hashed.join(last, [key, seq, "_hash"], "left_semi").drop("_hash").dropDuplicates([key])


def apply_changes(target: DataFrame, changes: DataFrame, key: str = "docOID", doc: str = "doc_oid", seq: str = "seq") -> DataFrame:
    """Add (replacing by key), delete and reindex.

    ``changes`` has the target's columns, ``op`` (add, delete, reindex) and ``seq``. A delete or reindex
    of a document removes all its sections that are not added again at or after that point.
    """
    dropped = changes.filter(F.col("op").isin("delete", "reindex")).groupBy(doc).agg(F.max(seq).alias("_gone"))
    adds = latest(changes.filter(F.col("op").isin("add", "reindex")), key, seq)
    live = (
        spread_join(adds, dropped, [doc], "left", by=F.xxhash64(key))
        .filter(F.col("_gone").isNull() | (F.col(seq) >= F.col("_gone")))
        .drop("_gone")
    )
    kept = spread_join(target, dropped.select(doc), [doc], "left_anti", by=F.xxhash64(key)).join(
        adds.select(key), key, "left_anti"
    )
    return kept.unionByName(live.select(*target.columns))


# Field-name endings and the type they stand for.
SUFFIX_TYPES = {
    "_i": "int", "_ti": "int", "_pi": "int", "_l": "bigint", "_tl": "bigint", "_f": "float", "_tf": "float",
    "_d": "double", "_td": "double", "_coordinate": "double", "_b": "boolean", "_dt": "timestamp", "_tdt": "timestamp",
    "_s": "string", "_t": "string", "_c": "string",
    "_is": "array<int>", "_ls": "array<bigint>", "_fs": "array<float>", "_ds": "array<double>", "_bs": "array<boolean>",
    "_dts": "array<timestamp>", "_ss": "array<string>", "_txt": "array<string>", "_en": "array<string>",
}


def _caster(kind: str) -> Callable[[Column], Column]:
    return lambda x: x.try_cast(kind)


def cast_dynamic(df: DataFrame) -> DataFrame:
    """Types by field name; ``ignored_*`` dropped; a value that does not fit its type becomes null."""
    out = []
    for name in df.columns:
        if name.startswith("ignored_"):
            continue
        kind = None
        if name.startswith("attr_") or name.startswith("by"):
            kind = "array<string>"
        elif name.endswith("_p"):
            parts = F.split(F.col(name), ",")
            out.append(
                F.struct(
                    F.trim(F.get(parts, 0)).try_cast("double").alias("lat"), F.trim(F.get(parts, 1)).try_cast("double").alias("lon")
                ).alias(name)
            )
            continue
        else:
            fits = [s for s in SUFFIX_TYPES if name.endswith(s)]
            kind = SUFFIX_TYPES[max(fits, key=len)] if fits else None
        c = F.col(name)
        if kind and kind.startswith("array<"):
            if df.schema[name].dataType.typeName() != "array":
                c = F.when(c.isNotNull(), F.array(c))
            c = F.transform(c, _caster(kind[6:-1]))
        elif kind:
            c = c.try_cast(kind)
        out.append(c.alias(name))
    return df.select(*out)


def copy_field(df: DataFrame, source: str, target: str, max_chars: int | None = None) -> DataFrame:
    """Append the values of ``source`` (a name or ``prefix*``/``*suffix``) to the array ``target``."""
    if source.endswith("*"):
        names = [c for c in df.columns if c.startswith(source[:-1]) and c != target]
    elif source.startswith("*"):
        names = [c for c in df.columns if c.endswith(source[1:]) and c != target]
    else:
        names = [source]
    values = []
    for name in names:
        c = F.col(name)
        c = c.cast("array<string>") if df.schema[name].dataType.typeName() == "array" else F.array(c.cast("string"))
        values.append(F.array_compact(c))
    added = F.concat(*values)
    if max_chars:
        added = F.transform(added, lambda v: F.left(v, F.lit(max_chars)))
    if target in df.columns:
        added = F.concat(F.coalesce(F.col(target).cast("array<string>"), F.array().cast("array<string>")), added)
    return df.withColumn(target, added)


def enforce(df: DataFrame, required: list[str], defaults: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """Records with defaults filled in, and the rejected ones that lack a required field."""
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    return filled.filter(~lacking), filled.filter(lacking)


def signature(df: DataFrame, columns: list[str], name: str = "signature") -> DataFrame:
    """Hash of the chosen fields; a missing field differs from an empty one."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return df.withColumn(name, F.md5(F.concat_ws("\u0001", *parts)))


def dedupe(df: DataFrame, key: str, name: str = "signature", overwrite: bool = True) -> DataFrame:
    """With ``overwrite`` one record per signature, the last by key; else all, marked ``duplicate``.

    The kept key is found by aggregation and looked up by key, so a signature may be very frequent.
    ``df`` is read twice: pass a stored table.
    """
    kept = df.groupBy(name).agg((F.max(key) if overwrite else F.min(key)).alias(key))
    if overwrite:
        return df.join(kept.select(key), key, "left_semi")
    return df.join(kept.select(key, F.lit(False).alias("_first")), key, "left").withColumn(
        "duplicate", F.coalesce("_first", F.lit(True))
    ).drop("_first")


def apply_hook(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user's own step over the records."""
    return df.transform(fn)


def attribute_names(df: DataFrame, pattern: str, column: str = "meta", name: str = "attribute_ss") -> DataFrame:
    """Names of the fields that match a pattern, as a field."""
    return df.withColumn(
        name, F.array_sort(F.filter(F.map_keys(column), lambda k: k.rlike(pattern)))
    )


def crosswalk(df: DataFrame, mapping: dict[str, list[str]], keep: list[str] = ()) -> DataFrame:
    """Output element <- the first source element that has a value."""
    return df.select(
        *keep,
        *[
            F.coalesce(*[F.when(F.col(s).cast("string") != "", F.col(s).cast("string")) for s in sources]).alias(target)
            for target, sources in mapping.items()
        ],
    )


def limit_docs(sections: DataFrame, n: int, key: str = "doc_oid") -> DataFrame:
    """All sections of the first ``n`` documents."""
    first = sections.select(key).distinct().orderBy(key).limit(n)
    return sections.join(first, key, "left_semi")


def feed(df: DataFrame, title: Column, link: Column) -> DataFrame:
    """Feed items, escaped."""
    return df.select(
        F.format_string("<item><title>%s</title><link>%s</link></item>", html_escape(title), html_escape(link)).alias("item")
    )


def _member(listed: list[str]) -> Callable[[Column], Column]:
    return lambda w: w.isin(listed)


def detect_language(df: DataFrame, key: str, columns: list[str], lists: dict[str, list[str]], fallback: str = "en") -> DataFrame:
    """Language whose frequent words are most often found in the text fields; ``fallback`` when none is.

    Counted within each record, so nothing is shuffled.
    """
    words = tok_standard(F.lower(F.concat_ws(" ", *columns)))
    rows = df.withColumn("_words", words)
    rows = rows.withColumns({f"_n_{lang}": F.size(F.filter("_words", _member(ws))) for lang, ws in lists.items()})
    best = F.greatest(*[F.col(f"_n_{lang}") for lang in lists])
    pick = F.when(best == 0, fallback)
    for lang in sorted(lists):
        pick = pick.when(F.col(f"_n_{lang}") == best, lang)
    return rows.withColumn("language_s", pick).drop("_words", *[f"_n_{lang}" for lang in lists])

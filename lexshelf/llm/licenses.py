"""Licence notices in text blocks, by an exact set-similarity join with prefix, length and positional filters.

Words are runs of ASCII letters, digits and non-ASCII characters, in lower case. A block of a template with L words is a
stretch of 2 * L words of a text, one starting at every place of one of the template's words. A block meets a template of n different
words if it holds at least THRESHOLD * n of them (its containment); of blocks that overlap, the one with most of them is reported.

One pass counts in how many documents each template word stands; that gives one order for all words, rarest first. A block
can only meet a template if it holds one of the template's first n - need + 1 words in that order (prefix), has need words
or more (length), and enough words remain from its start on (position). Blocks that pass are counted by sliding once over the places
of the template's words, so a text of any length takes time in proportion to them. The counts are as many as the templates have words, so only they and the templates reach the driver; documents
are read in place, never shuffled.

A null text is empty. Documents are judged one by one, so nulls in other columns, repeated rows and ties change nothing; columns other
than doc_id and text play no part, whatever their names. A long text is held whole, as words. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.llm.arrow import texts_of

THRESHOLD = 0.9

#: Phrases whose places are counted, and their labels.
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}

#: Licence notices, as their publishers state them, and their labels.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
]

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Template:
    """One notice with its words in the common order."""

    def __init__(self, label: str, text: str, place: dict[bytes, int], threshold: float):
        words = words_of(text.encode())
        self.label, self.length = label, len(words)
        self.order = sorted({place[w] for w in words})
        self.need = max(1, ceil(round(threshold * len(self.order), 9)))
        self.words = frozenset(self.order)
        self.prefix = frozenset(self.order[: len(self.order) - self.need + 1])

    def windows(self, places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """(start, shared words) of the best of every group of overlapping windows that hold enough words of the template.

        ``places`` are (position, word) of the template's words. A window of twice the template's length begins at each of them; it slides
        once over the places, so any text takes time in proportion to them. Length filter: a window with fewer places than
        words needed is passed over; position filter: so is one from whose start too few places are left.
        """
        width, inside, kinds, right = 2 * self.length, dict.fromkeys(self.order, 0), 0, 0
        best, last = None, -1
        for left, (start, word) in enumerate(places):
            if len(places) - left < self.need:
                break
            while right < len(places) and places[right][0] < start + width:
                seen = places[right][1]
                kinds += not inside[seen]
                inside[seen] += 1
                right += 1
            if right - left >= self.need and kinds >= self.need:
                if best is not None and start >= last + width:
                    yield best
                    best = None
                if best is None or kinds > best[1]:
                    best = (start, kinds)
                last = start
            inside[word] -= 1
            kinds -= not inside[word]
        if best is not None:
            yield best


class Templates:
    def __init__(self, notices: list[tuple[str, str]], counts: dict[bytes, int], threshold: float):
        vocabulary = sorted({w for _, text in notices for w in words_of(text.encode())}, key=lambda w: (counts.get(w, 0), w))
        self.place = {w: i for i, w in enumerate(vocabulary)}
        self.all = [Template(label, text, self.place, threshold) for label, text in notices if words_of(text.encode())]
        self.prefixes = frozenset(vocabulary[i] for t in self.all for i in t.prefix)

    def found(self, words: list[bytes]) -> Iterator[tuple[Template, int, int]]:
        """(template, block start, shared words) of every block that meets a template."""
        if self.prefixes.isdisjoint(words):
            return
        at = [(i, self.place[w]) for i, w in enumerate(words) if w in self.place]
        there = {w for _, w in at}
        for t in self.all:
            if t.prefix.isdisjoint(there) or len(t.words & there) < t.need:
                continue
            for start, shared in t.windows([(i, w) for i, w in at if w in t.words]):
                yield t, start, shared


def phrase_places(words: list[bytes], phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """(first word, label) of all places of the phrases."""
    lasts = {p[-1]: [q for q in phrases if q[-1] == p[-1]] for p in phrases}
    found = []
    for i, w in enumerate(words):
        for p in lasts.get(w, ()):
            start = i - len(p) + 1
            if start >= 0 and tuple(words[start : i + 1]) == p:
                found.append((start, phrases[p]))
    return found


def word_counts(docs: DataFrame, notices: list[tuple[str, str]]) -> dict[bytes, int]:
    """In how many documents each word of the notices stands."""
    wanted = frozenset(w for _, text in notices for w in words_of(text.encode()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for w in wanted.intersection(words_of(text)):
                    totals[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.binary()), pa.array(totals.values(), pa.int64())], ["word", "n"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_FOUND = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("blocks", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]))),
])
_SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<label:string,start:long,words:long,containment:double>>"


def _scan(templates: Templates, phrases: dict[tuple[str, ...], str]):
    coded = {tuple(w.encode() for w in p): label for p, label in phrases.items()}
    lasts = frozenset(p[-1] for p in coded)

    def row(text: bytes) -> dict:
        words = words_of(text)
        places = [] if lasts.isdisjoint(words) else phrase_places(words, coded)
        blocks = [
            {"label": t.label, "start": start, "words": min(2 * t.length, len(words) - start), "containment": shared / len(t.order)}
            for t, start, shared in templates.found(words)
        ]
        base = {label for _, label in places}
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min((i for i, _ in places), default=None),
            "last_word": max((i for i, _ in places), default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {b["label"] for b in blocks})),
            "score": max([b["containment"] for b in blocks] + [1.0] * bool(places), default=0.0),
            "blocks": blocks,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_pylist([row(t) for t in texts_of(batch.column(1))], _FOUND)
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows.columns], ["doc_id", *_FOUND.names])

    return run


def scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: phrase places, labels, score (best containment, 1 for a phrase), and blocks that meet a notice."""
    notices = NOTICES if notices is None else notices
    templates = Templates(notices, word_counts(docs, notices), threshold)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_scan(templates, PHRASES), "doc_id long, " + _SCHEMA)

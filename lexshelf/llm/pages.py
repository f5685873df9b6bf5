"""Main text of web pages with wrappers inferred from pages of the same host.

**Wrapper.** The token streams (tags and texts) of all pages of a host are brought together. Runs of equal groups within a stream become
repeated groups. Streams of one shape are merged item by item, those of different shapes aligned one after the other: tokens without a
partner become optional groups, and texts that differ become text slots. The result is a regular expression without unions: sequences, slots, `( )+` and `( )?`.

**Main region.** Menus, headers, footers, side columns, notices, adverts, forms, scripts, styles and reader comments are
known by element or by a word of class, id or role. Among the other containers of the wrapper, the main region is an article or
main element if one holds text slots, else the innermost container with nearly all slot text.

**Extraction.** The text under the main region, without known boilerplate inside it, in page order: character references decoded,
white space in a block made one blank, blocks joined by one newline. A page without that region is searched alike by itself.

Each task merges its pages of one host and shape, so a hot host sends a row per shape and task. Shapes are dealt into BUCKETS by their
hash and aligned there, then the buckets of a host: the result does not depend on how the pages lie. Wrappers are small rows that
join pages by host. A null html has an empty text; a null or odd url is a host of its
own. Equal pages give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import json
import marshal
import math
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexshelf.session import cut

HELD = 32 << 20
#: Parts of a host's shapes that are aligned apart first.
BUCKETS = 64

#: Elements by their part in a page.
BOILERPLATE = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea dialog menu head title object canvas".split())
CONTAINERS = frozenset("article main section div td body center".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input del".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"p": INLINE | {"p"}, "li": INLINE | {"p", "li"}, "td": INLINE | {"p", "td"}, "tr": INLINE | {"p", "td", "tr"}, "dd": INLINE | {"p", "dd", "dt"}, "dt": INLINE | {"p", "dd", "dt"}, "option": INLINE | {"option"}}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|sidebar|side|aside|footer|foot|header|masthead|banner|ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay"
    r"|comments?|commentlist|disqus|repl(?:y|ies)|respond|share|sharing|social|related|recommend\w*|breadcrumbs?|newsletter|subscribe|signup|login|search|pagination|pager|widget|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*>?|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
NAME = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, element or text, class, id and role): kinds are open, close and text."""
    for m in TOKEN.finditer(page):
        name = m.group(3)
        if name:
            named = " ".join(a or b or c for _, a, b, c in NAME.findall(m.group(4))) if m.group(4) and not m.group(2) else ""
            yield ("close" if m.group(2) else "open"), name.lower(), named
        elif m.group(1) is None and (m.group()[0] != "<" or m.group() == "<"):
            yield "text", m.group(), ""


class Walk:
    """Open elements along a token stream, with the ends that HTML leaves out."""

    def __init__(self):
        self.open: list[tuple[str, str]] = []

    def enter(self, name: str, named: str) -> int:
        """Opens an element; gives how many of those open before stay so."""
        closes = CLOSED_BY.get(name, INLINE | {"p"} if name not in INLINE else ())
        if name in CLOSED_BY or name not in INLINE:
            depth = len(self.open)
            while depth and self.open[depth - 1][0] in closes:
                depth -= 1
            if any(n == "p" or n == name for n, _ in self.open[depth:]):
                del self.open[depth:]
        kept = len(self.open)
        if name not in VOID:
            self.open.append((name, named))
        return kept

    def leave(self, name: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == name:
                del self.open[depth:]
                return


def skipped(name: str, named: str, inside: bool) -> bool:
    """Whether an element is boilerplate; a header within the main region holds the title."""
    if name in ("html", "body", "article", "main"):
        return False
    return (name in BOILERPLATE and not (inside and name == "header")) or bool(named and NAMED.search(named))


# --- inference ------------------------------------------------------------------------------


def stream(page: str) -> list[tuple]:
    """Tokens as the items that are aligned: ("open", name, named), ("close", name), ("text", words)."""
    out: list[tuple] = []
    for kind, value, named in tokens(page):
        if kind == "text":
            if words := " ".join(value.split()):
                out.append(("text", words))
        else:
            out.append((kind, value, named) if kind == "open" else (kind, value))
    return out


def shape(item: tuple) -> tuple:
    """What has to be equal for two items to be partners: all but the words of a text."""
    if item[0] in ("text", "slot"):
        return ("text",)
    if item[0] in ("+", "?"):
        inner = tuple(shape(i) for i in item[1])
        return ("+", inner) if item[0] == "+" else inner
    return item


def mass_of(item: tuple) -> int:
    """Characters that all texts at a place have together."""
    return item[1] if item[0] == "slot" else item[2] if len(item) > 2 else len(item[1])


def merge(a: tuple, b: tuple) -> tuple:
    """One item for two partners, in whatever order: texts that differ become a slot; groups are merged item by item."""
    if a[0] in ("text", "slot"):
        mass = mass_of(a) + mass_of(b)
        return ("text", a[1], mass) if a[0] == b[0] == "text" and a[1] == b[1] else ("slot", mass)
    if a[0] in ("+", "?"):
        return (a[0], tuple(merge(x, y) for x, y in zip(a[1], b[1], strict=True)))
    return a


def folded(items: list[tuple], longest: int = 12) -> list[tuple]:
    """Runs of two or more equal groups of up to ``longest`` items become repeated groups."""
    out: list[tuple] = []
    shapes: list[tuple] = []
    for item in items:
        out.append(item)
        shapes.append(shape(item))
        again = True
        while again:
            again = False
            newest = shapes[-1]
            for size in range(1, min(longest, len(out) - 1) + 1):
                # a group before these items ends as they do, or is repeated already
                before = shapes[-size - 1]
                if before != newest and before[0] != "+":
                    continue
                last = tuple(shapes[-size:])
                if size > 1 or last[0][0] == "+":
                    if size < len(out) and shapes[-size - 1] == ("+", last):
                        group = tuple(merge(x, y) for x, y in zip(out[-size - 1][1], out[-size:], strict=True))
                        del out[-size - 1 :], shapes[-size - 1 :]
                        out.append(("+", group))
                        shapes.append(("+", last))
                        again = True
                        break
                    if size > 1 and 2 * size <= len(out) and tuple(shapes[-2 * size : -size]) == last and last[0][0] in ("open", "+"):
                        group = tuple(merge(x, y) for x, y in zip(out[-2 * size : -size], out[-size:], strict=True))
                        del out[-2 * size :], shapes[-2 * size :]
                        out.append(("+", group))
                        shapes.append(("+", last))
                        again = True
                        break
    return out


class Scores:
    """best[i][j]: the most that partners among items from i and from j on are worth. Every few rows one is kept, the others are made again."""

    def __init__(self, a: list[tuple], b: list[tuple]):
        number: dict = {}
        code = lambda shapes: np.array([number.setdefault(s, len(number)) for s in shapes], np.int64)
        # a repeated group of one item goes with that item
        one = lambda shapes: [s[1][0] if s[0] == "+" and len(s[1]) == 1 else ("", i) for i, s in enumerate(shapes)]
        sa, sb = [shape(x) for x in a], [shape(x) for x in b]
        self.a, self.b = code(sa), code(sb)
        self.inner_a, self.inner_b = code([("a", *s) if s[0] == "" else s for s in one(sa)]), code([("b", *s) if s[0] == "" else s for s in one(sb)])
        self.plus_a, self.plus_b = np.array([s[0] == "+" for s in sa], bool), np.array([s[0] == "+" for s in sb], bool)
        self.n, self.every = len(a), max(1, math.isqrt(len(a)))
        row = np.zeros(len(b) + 1, np.int64)
        self.kept = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            row = self.above(i, row)
            if i % self.every == 0:
                self.kept[i] = row
        self.first, self.rows = self.n + 1, []

    def partners(self, i: int) -> np.ndarray:
        """What item i is worth with each of the others: 2 for equal shapes, 1 for an item and its repeated group."""
        alike = (self.inner_a[i] == self.b) & ~self.plus_b if self.plus_a[i] else (self.inner_b == self.a[i]) & self.plus_b
        return np.where(self.a[i] == self.b, 2, np.where(alike, 1, 0))

    def above(self, i: int, below: np.ndarray) -> np.ndarray:
        worth = self.partners(i)
        row = below.copy()
        row[:-1] = np.maximum(row[:-1], np.where(worth > 0, below[1:] + worth, 0))
        return np.maximum.accumulate(row[::-1])[::-1]

    def row(self, i: int) -> np.ndarray:
        if not self.first <= i < self.first + len(self.rows):
            self.first = i - i % self.every
            last = min(self.first + self.every, self.n)
            rows = [self.kept[last]]
            for at in range(last - 1, self.first - 1, -1):
                rows.append(self.above(at, rows[-1]))
            self.rows = rows[::-1]
        return self.rows[i - self.first]


def aligned(wrapper: list[tuple], other: list[tuple]) -> list[tuple]:
    """A wrapper for both streams: partners are merged, and what has none becomes optional. Memory grows with the length, not its square."""
    n, m = len(wrapper), len(other)
    scores = Scores(wrapper, other)
    out: list[tuple] = []
    i = j = 0

    def optional(items: list[tuple]) -> None:
        flat = [x for item in items for x in (item[1] if item[0] == "?" else (item,))]
        if flat:
            out.append(("?", tuple(flat)))

    gap: list[tuple] = []
    at, worth, here, below = -1, None, None, None
    while i < n or j < m:
        if i < n and i != at:
            # the lower row first: it may be the first of the next block
            below = scores.row(i + 1) if i + 1 < n else scores.kept[n]
            at, worth, here = i, scores.partners(i), scores.row(i)
        p = int(worth[j]) if i < n and j < m else 0
        if p and here[j] == below[j + 1] + p:
            optional(gap)
            gap = []
            out.append(merge(wrapper[i], other[j]) if p == 2 else wrapper[i] if wrapper[i][0] == "+" else other[j])
            i, j = i + 1, j + 1
        elif i < n and (j == m or here[j] == below[j]):
            gap.append(wrapper[i])
            i += 1
        else:
            gap.append(other[j])
            j += 1
    optional(gap)
    return out


def together(wrapper: list[tuple] | None, other: list[tuple]) -> list[tuple]:
    """One wrapper for two: item by item if their shapes are equal, else aligned."""
    if wrapper is None:
        return other
    if [shape(x) for x in wrapper] == [shape(x) for x in other]:
        return [merge(x, y) for x, y in zip(wrapper, other, strict=True)]
    return folded(aligned(wrapper, other))


def infer(pages: list[str]) -> list[tuple]:
    """The wrapper of all pages: first of those of one shape, then of all shapes."""
    shapes: dict[tuple, list[tuple]] = {}
    for page in pages:
        items = folded(stream(page))
        key = tuple(map(shape, items))
        shapes[key] = together(shapes.get(key), items)
    wrapper = None
    for items in shapes.values():
        wrapper = together(wrapper, items)
    return wrapper or []


def expression(wrapper: list[tuple] | tuple) -> str:
    """The wrapper as a regular expression over tokens."""
    out = []
    for item in wrapper:
        if item[0] in ("+", "?"):
            out.append(f"({expression(item[1])}){item[0]}")
        elif item[0] == "open":
            out.append(f"<{item[1]}{'.' + item[2] if item[2] else ''}>")
        elif item[0] == "close":
            out.append(f"</{item[1]}>")
        else:
            out.append("#text" if item[0] == "slot" else item[1])
    return " ".join(out)


def main_region(wrapper: list[tuple]) -> tuple[str, str] | None:
    """(element, named) of the container that holds the article, by the text of the wrapper's slots."""
    mass: dict[tuple[tuple[str, str], ...], float] = {}
    walk = Walk()

    def visit(items) -> None:
        for item in items:
            if item[0] in ("+", "?"):
                visit(item[1])
            elif item[0] == "open":
                walk.enter(item[1], item[2])
            elif item[0] == "close":
                walk.leave(item[1])
            elif not any(skipped(n, c, False) for n, c in walk.open) and "a" not in [n for n, _ in walk.open]:
                weight = item[1] if item[0] == "slot" else 0.01 * len(item[1])
                for depth in range(1, len(walk.open) + 1):
                    if walk.open[depth - 1][0] in CONTAINERS:
                        path = tuple(walk.open[:depth])
                        mass[path] = mass.get(path, 0) + weight

    visit(wrapper)
    if not mass:
        return None
    named = [p for p in mass if p[-1][0] in ("article", "main")]
    if named:
        return max(named, key=lambda p: (mass[p], -len(p)))[-1]
    most = max(mass.values())
    return max((p for p in mass if mass[p] >= 0.9 * most), key=len)[-1]


# --- extraction -----------------------------------------------------------------------------


def extract(page: str, region: tuple[str, str] | None) -> str | None:
    """Text blocks under the region, joined by newlines; None if the page has no such region."""
    walk, blocks, buffer, seen = Walk(), [], [], region is None
    states: list[tuple[bool, bool]] = []

    def flush() -> None:
        if buffer:
            if words := " ".join(html.unescape("".join(buffer)).split()):
                blocks.append(words)
            buffer.clear()

    for kind, value, named in tokens(page):
        if kind == "text":
            inside, skip = states[-1] if states else (region is None, False)
            if inside and not skip:
                buffer.append(value)
            continue
        if value not in INLINE:
            flush()
        elif value == "br":
            buffer.append(" ")
        if kind == "open":
            del states[walk.enter(value, named) :]
            while len(states) < len(walk.open):
                name, attrs = walk.open[len(states)]
                inside, skip = states[-1] if states else (region is None, False)
                here = (name, attrs) == region
                seen = seen or here
                skip = False if here and not inside else skip or skipped(name, attrs, inside)
                states.append((inside or here, skip))
        else:
            walk.leave(value)
            del states[len(walk.open) :]
    flush()
    return "\n".join(blocks) if seen else None


def main_text(page: str | None, region: tuple[str, str] | None) -> str:
    if not page:
        return ""
    text = extract(page, region) if region else None
    if text is None:
        text = extract(page, main_region(folded(stream(page))))
    return text or ""


# --- on Spark -------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


_STREAMS = pa.schema([("host", pa.string()), ("bucket", pa.int32()), ("shape", pa.int64()), ("items", pa.binary())])


def _packed(items: list[tuple]) -> bytes:
    return zlib.compress(marshal.dumps(items), 1)


def _unpacked(data: bytes) -> list[tuple]:
    return marshal.loads(zlib.decompress(data))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages of this task, merged by host and shape; those of more than HELD bytes are passed on as they stand."""
    held: dict[tuple[str, int], list[list[tuple]]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        flat = [(host, code % BUCKETS, code, _packed(items)) for (host, code), streams in held.items() for items in streams]
        for at in range(0, len(flat), 256):
            yield pa.RecordBatch.from_pylist([dict(zip(_STREAMS.names, r, strict=True)) for r in flat[at : at + 256]], _STREAMS)

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            items = folded(stream(page.as_py()))
            shapes = [shape(x) for x in items]
            streams = held.setdefault((host, xxhash.xxh64_intdigest(repr(shapes)) >> 1), [])
            # different shapes of one hash stand side by side
            same = next((i for i, s in enumerate(streams) if [shape(x) for x in s] == shapes), None)
            if same is None:
                streams.append(items)
                size += 8 * len(page.as_py())
            else:
                streams[same] = [merge(x, y) for x, y in zip(streams[same], items, strict=True)]
            if size > HELD:
                yield from rows()
                held.clear()
                size = 0
    yield from rows()


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    rows = (r for batch in batches for r in batch.to_pylist())
    return groupby(rows, lambda r: tuple(r[c] for c in by))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for the shapes of a host in a bucket. Rows of one shape come one after the other and are merged first."""
    for (host, bucket), rows in _groups(batches, ["host", "bucket"]):
        wrapper = None
        for _, same in groupby(rows, lambda r: r["shape"]):
            streams: dict[tuple, list[tuple]] = {}
            for r in same:
                items = _unpacked(r["items"])
                key = tuple(map(shape, items))
                streams[key] = together(streams.get(key), items)
            for key in sorted(streams, key=repr):
                wrapper = together(wrapper, streams[key])
        yield pa.RecordBatch.from_pylist([{"host": host, "bucket": bucket, "shape": 0, "items": _packed(wrapper)}], _STREAMS)


def _wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (host,), rows in _groups(batches, ["host"]):
        wrapper = None
        for r in rows:
            wrapper = together(wrapper, _unpacked(r["items"]))
        columns = [[host], [expression(wrapper)], [json.dumps(main_region(wrapper))]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "wrapper", "region"])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, region): one wrapper per host, inferred from all its pages."""
    kind = "host string, bucket int, shape long, items binary"
    rows = pages.where("html is not null").select(host_of(F.col("url")).alias("host"), "html")
    shapes = rows.mapInArrow(_shapes, kind).repartition("host", "bucket").sortWithinPartitions("host", "bucket", "shape")
    partial = shapes.mapInArrow(_partial, kind).repartition("host").sortWithinPartitions("host", "bucket")
    return partial.mapInArrow(_wrappers, "host string, wrapper string, region string")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regions = [tuple(json.loads(r)) if r and r != "null" else None for r in batch.column("region").to_pylist()]
        texts = [main_text(p, r) for p, r in zip(batch.column("html").to_pylist(), regions, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    found = cut(wrappers(plain)).select("host", "region")
    joined = plain.withColumn("host", host_of(F.col("url"))).join(found, "host", "left")
    return joined.mapInArrow(_apply, "page_id long, url string, text string")

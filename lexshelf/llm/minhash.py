"""Near-duplicates by an inverted join over MinHash signatures; whole shingle sets decide every link.

A document's set holds its distinct shingles of ``words`` words. Its signature has COORDS coordinates, each the least of one random
function over the set, and two sets agree in a coordinate with a chance of their Jaccard similarity. A byte of each coordinate makes the
set's tags; pairs of sets whose tags collide in MATCH coordinates are decided by their whole sets.

1. Postings: every different set is posted under its first POSTED coordinate-value pairs. Pairs that one set alone has are skipped, and so
   are sets with fewer than LEAST pairs left, since similar sets share LEAST of them (at a similarity of 0.8 all but some pairs of
   sets in ten thousand do; above that nearly all).
2. Prefixes: the pairs of a set are ordered by how many sets have them, rarest first. Two sets that share LEAST pairs share one
   of the first m - LEAST + 1 pairs of their m, so only those lists are merged; the long lists of common pairs are skipped.
3. Stars: each list names the member with the commonest pairs as its centre. A set meets the centres that most of its lists name; those
   whose tags collide enough are decided. This puts most of a large family of near copies in one class.
4. Rest: a list whose members are in one class is done. In every other list collisions are counted between all members outside its
   largest class and all members, by blocks of bounded size, so that a list of any length is dealt over many tasks. A pair counts in the
   first list that both prefixes have. Members that collide enough with another stay, and their whole sets come to the
   block and are compared there: only links leave it, never pairs.

Equal sets are one node, so copies are never compared. A set is known by a 128-bit hash of its shingle hashes (64 bits each); nodes are
numbered once, in a written table, so that postings, lists and links carry eight bytes for each node.
Fewer words than a shingle has: the whole sequence is the one shingle. Nulls, empty texts and texts without a word have an empty
set and are linked with nothing. Rows with equal doc_id are ranked apart by their sets; rows without a doc_id are linked but never
name a class, and stay. Long texts are hashed whole; the sets of one block are held in memory. An empty table gives an empty result;
columns other than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.llm.arrow import runs, texts_of
from lexshelf.llm.components import components
from lexshelf.session import cut

SEED = 42
WORDS = 2
#: The least similarity, as a fraction, so that it is compared in whole numbers.
SHARE = (4, 5)
COORDS, MATCH = 128, 84
POSTED, LEAST = 32, 18
#: Centres that a set is compared with.
CENTRES = 2
#: A block of one list holds about so many shingles, and so many sets.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 18, 512
#: Pairs whose tags are compared at a time.
PAIRS = 1 << 16
MEMO = 1 << 18
_RANDOM = np.random.default_rng(SEED)
_TIMES = _RANDOM.integers(0, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, COORDS, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, made once for each word that comes along."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def shingles(text: bytes, words: int, memo: _Words) -> np.ndarray:
    """The different hashes of all word shingles, in order."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    found = np.full(len(parts) - width + 1, width, np.uint64)
    for i in range(width):
        found = (found ^ hashes[i : i + len(found)]) * _BASE
        found ^= found >> np.uint64(29)
    return np.unique(found)


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        least = np.minimum(least, (found[at : at + 1024, None] * _TIMES + _PLUS).min(axis=0))
    return least


def tags_of(least: np.ndarray) -> bytes:
    return (least >> np.uint64(56)).astype(np.uint8).tobytes()


def hash_of(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.tobytes(), SEED) if len(found) else None


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(v) for v in values])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sketches(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            hashes, sizes, tags, keys = [], [], [], []
            for text in texts_of(batch.column(1)):
                found = shingles(text, words, memo)
                least = signature(found)
                hashes.append(hash_of(found))
                sizes.append(len(found))
                tags.append(tags_of(least * _BASE) if len(found) else None)
                keys.append(least[:POSTED] if len(found) else found)
            columns = [batch.column(0), pa.array(hashes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(tags, pa.binary()), _lists(keys)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "n_shingles", "tags", "keys"])

    return run


def _sets(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [f for f in (shingles(t, words, memo) for t in texts_of(batch.column(0).slice(at, 256))) if len(f)]
                yield pa.RecordBatch.from_arrays([pa.array(map(hash_of, found), pa.binary()), _lists(found)], ["hash", "found"])

    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``left`` has in common with each of ``right``; all are sets."""
    values = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(v) for v in left + right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    place = (np.cumsum(often) - 1)[column]
    keep = often[column]
    place, owner = place[keep], owner[keep]
    counts = np.zeros((len(left), len(right)), np.float64)
    total = int(often.sum())
    for at in range(0, total, 4096):
        start, end = np.searchsorted(place, [at, at + 4096])
        there = np.zeros((len(left) + len(right), min(4096, total - at)), np.float32)
        there[owner[start:end], place[start:end] - at] = 1
        counts += there[: len(left)] @ there[len(left) :].T
    return counts.astype(np.int64)


def _tag_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDS)


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (node, centre, x, y) whose tags x and y collide enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, PAIRS):
            part = batch.slice(at, PAIRS)
            same = (_tag_rows(part.column("x")) == _tag_rows(part.column("y"))).sum(axis=1) >= MATCH
            yield part.select(["node", "centre"]).filter(pa.array(same))


def _blocks_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges, outer, inner) of the blocks of rows sorted by k, x and y."""
    k, x, y, outer, inner = (table.column(c).to_numpy() for c in ("k", "x", "y", "outer", "inner"))
    new = np.append(True, (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    return np.append(np.flatnonzero(new), len(k)), outer, inner


def _pairs_of(edges: np.ndarray, outer: np.ndarray, inner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, rows): all outer rows beside all inner rows of their block, about PAIRS at a time."""
    lefts, rights, size = [], [], 0
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if end - start < 2:
            continue
        left, right = start + np.flatnonzero(outer[start:end]), start + np.flatnonzero(inner[start:end])
        step = max(1, PAIRS // max(1, len(right)))
        for at in range(0, len(left), step):
            part = left[at : at + step]
            lefts.append(np.repeat(part, len(right)))
            rights.append(np.tile(right, len(part)))
            size += len(lefts[-1])
            if size >= PAIRS:
                yield np.concatenate(lefts), np.concatenate(rights)
                lefts, rights, size = [], [], 0
    if size:
        yield np.concatenate(lefts), np.concatenate(rights)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that collide enough with a row of another class, first here: (k, x, y, outer, inner, root, node)."""
    names = ["k", "x", "y", "outer", "inner", "root", "node"]
    for table in runs(batches, ["k", "x", "y"]):
        table = table.combine_chunks()
        tags, roots = _tag_rows(table.column("tags")), table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        first, keys = table.column("first").combine_chunks(), table.column("k").to_pylist()
        seen: dict[int, frozenset] = {}

        def earlier(row: int, first: pa.ListArray = first, keys: list = keys, seen: dict = seen) -> frozenset:
            """The pairs that come before the list's own in the order of the set."""
            if row not in seen:
                order = first[row].values.to_numpy().tolist()
                seen[row] = frozenset(order[: order.index(keys[row])])
            return seen[row]

        as_outer, as_inner = np.zeros(table.num_rows, bool), np.zeros(table.num_rows, bool)
        for left, right in _pairs_of(*_blocks_of(table)):
            other = roots[left] != roots[right]
            left, right = left[other], right[other]
            close = (tags[left] == tags[right]).sum(axis=1) >= MATCH
            for i, j in zip(left[close].tolist(), right[close].tolist(), strict=True):
                if not (as_outer[i] and as_inner[j]) and earlier(i).isdisjoint(earlier(j)):
                    as_outer[i] = as_inner[j] = True
        kept = table.select(names).set_column(3, "outer", pa.array(as_outer)).set_column(4, "inner", pa.array(as_inner))
        yield from kept.filter(pa.array(as_outer | as_inner)).to_batches()


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Of the links between numbers below ``size``, one for every member that a class has besides its first."""
    beside = np.zeros((size, size), bool)
    beside[a, b] = beside[b, a] = True
    left = np.ones(size, bool)
    for first in np.flatnonzero(beside.any(axis=1)).tolist():
        if not left[first]:
            continue
        left[first], reached = False, [first]
        while reached:
            new = np.flatnonzero(beside[reached.pop()] & left).tolist()
            left[new] = False
            for member in new:
                yield first, member
            reached += new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between classes, from rows sorted by block: ``outer`` ones are compared with the ``inner`` ones, set by set."""
    for table in runs(batches, ["k", "x", "y"]):
        edges, outer, inner = _blocks_of(table)
        roots, found = table.column("root").combine_chunks(), table.column("found").combine_chunks()
        a, b = [], []
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            left, right = start + np.flatnonzero(outer[start:end]), start + np.flatnonzero(inner[start:end])
            if not len(left) or not len(right):
                continue
            sets = {i: found[i].values.to_numpy() for i in {*left.tolist(), *right.tolist()}}
            names = roots[start:end].dictionary_encode().indices.to_numpy()
            n = shared_counts([sets[i] for i in left.tolist()], [sets[i] for i in right.tolist()])
            total = np.array([len(sets[i]) for i in left.tolist()])[:, None] + np.array([len(sets[i]) for i in right.tolist()])
            linked = (n * SHARE[1] >= (total - n) * SHARE[0]) & (names[left - start][:, None] != names[right - start])
            i, j = np.nonzero(linked)
            values = {int(n): roots[start + at] for at, n in enumerate(names.tolist())}
            for x, y in _forest(names[left[i] - start], names[right[j] - start], len(values)):
                a.append(values[x].as_py())
                b.append(values[y].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _prefixes(nodes: DataFrame) -> DataFrame:
    """(node, n, tags, weight, first): the rarest repeated coordinate-value pairs of every set that may have a similar one, in order."""
    postings = nodes.select("node", F.explode("keys").alias("k"))
    repeated = cut(postings.groupBy("k").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"))
    held = postings.join(repeated, "k").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sets", "k"))).alias("held"))
    held = held.where(F.size("held") >= LEAST).select(
        "node",
        F.expr("aggregate(held, 0L, (s, p) -> s + p.sets)").alias("weight"),
        F.slice("held.k", F.lit(1), F.size("held") - LEAST + 1).alias("first"),
    )
    return cut(held.join(nodes.select("node", F.col("n_shingles").alias("n"), "tags"), "node").select("node", "n", "tags", "weight", "first"))


def _star_pairs(held: DataFrame) -> DataFrame:
    """(node, centre): of the centres that most lists of a set name, those whose tags collide enough with its own."""
    lists = held.select("node", "weight", F.explode("first").alias("k"))
    centres = lists.groupBy("k").agg(F.max(F.struct("weight", "node")).getField("node").alias("centre"), F.count(F.lit(1)).alias("sets"))
    met = lists.select("k", "node").join(centres.where("sets > 1"), "k").where("node <> centre").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("times"))
    best = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), "centre"))
    met = met.withColumn("best", best).where(F.col("best") <= CENTRES).select("node", "centre")
    both = met.join(held.select("node", F.col("tags").alias("x")), "node").join(held.select(F.col("node").alias("centre"), F.col("tags").alias("y")), "centre")
    return cut(both.select("node", "centre", "x", "y").mapInArrow(_collide, "node long, centre long"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (node, centre) whose whole sets are alike enough, as links (a, b)."""
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("centre"), F.col("found").alias("other")), "centre")
    shared = both.select(
        F.col("node").alias("a"),
        F.col("centre").alias("b"),
        F.size(F.array_intersect("found", "other")).alias("n"),
        (F.size("found") + F.size("other")).alias("total"),
    )
    return cut(shared.where(F.col("n") * SHARE[1] >= (F.col("total") - F.col("n")) * SHARE[0]).select("a", "b"))


def _blocks(held: DataFrame, roots: DataFrame, shingles_each: int, sets_each: int) -> DataFrame:
    """(k, x, y, outer, inner, root, node): members of unfinished lists, dealt to blocks; x cuts the outer ones and y all."""
    rooted = held.select("node", "n", "first").join(roots, "node", "left")
    member = cut(rooted.select("node", "n", F.coalesce("root", "node").alias("root"), F.explode("first").alias("k")))
    classes = member.groupBy("k", "root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    stats = classes.groupBy("k").agg(
        F.max(F.struct("sets", "shingles", "root")).alias("main"),
        F.count(F.lit(1)).alias("classes"),
        F.sum("sets").alias("sets"),
        F.sum("shingles").alias("shingles"),
    )

    def ways(of_sets, of_shingles):
        return F.greatest(F.ceil(of_sets / sets_each), F.ceil(of_shingles / shingles_each), F.lit(1)).cast("int")

    stats = stats.where("classes > 1").select(
        "k",
        F.col("main.root").alias("main"),
        ways(F.col("sets") - F.col("main.sets"), F.col("shingles") - F.col("main.shingles")).alias("wx"),
        ways(F.col("sets"), F.col("shingles")).alias("wy"),
    )
    mine = member.join(cut(stats), "k").withColumn("out", F.col("root") != F.col("main"))
    mine = mine.withColumn("h", F.xxhash64("node"))
    x, y = F.expr("cast(pmod(h, wx) as int)"), F.expr("cast(pmod(h, wy) as int)")
    single = (F.col("wx") == 1) & (F.col("wy") == 1)
    shape = "array<struct<x:int,y:int,outer:boolean,inner:boolean>>"
    once = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("out").alias("outer"), F.lit(True).alias("inner"))).cast(shape)
    across = F.transform(
        F.expr("sequence(0, wy - 1)"), lambda i: F.struct(x.alias("x"), i.alias("y"), F.lit(True).alias("outer"), F.lit(False).alias("inner"))
    ).cast(shape)
    down = F.transform(
        F.expr("sequence(0, wx - 1)"), lambda i: F.struct(i.alias("x"), y.alias("y"), F.lit(False).alias("outer"), F.lit(True).alias("inner"))
    ).cast(shape)
    placed = F.when(single, once).otherwise(F.concat(F.when(F.col("out"), across).otherwise(F.array().cast(shape)), down))
    return mine.select("k", "root", "node", F.inline(placed))


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, found): the whole sets of the wanted nodes, made anew from one text of each."""
    wanted = cut(nodes.join(wanted, "node", "left_semi").select("node", "hash", "least"))
    ids = wanted.select(F.col("least").alias("id")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    found = texts.mapInArrow(_sets(words), "hash binary, found array<bigint>")
    made = cut(found.join(wanted, "hash").select("node", "found", F.monotonically_increasing_id().alias("row")))
    # a node has several rows only where one doc_id has equal sets twice: those rows are found by number, so that no set is moved for it
    kept = cut(made.groupBy("node").agg(F.min("row").alias("kept"), F.count(F.lit(1)).alias("rows")).where("rows > 1"))
    spare = cut(made.select("node", "row").join(kept, "node").where("row <> kept").select("row"))
    return made.join(spare, "row", "left_anti").select("node", "found")


def near_duplicates(docs: DataFrame, words: int = WORDS, shingles_each: int = BLOCK_SHINGLES, sets_each: int = BLOCK_SETS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: component_id is the least doc_id of its class."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(docs.mapInArrow(_sketches(words), "doc_id long, hash binary, n_shingles long, tags binary, keys array<bigint>"))
    filled = rows.where("hash IS NOT NULL")
    one = F.first(F.struct("n_shingles", "tags", "keys"))
    nodes = filled.groupBy("hash").agg(F.min("doc_id").alias("least"), one.alias("_one"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "hash", "least", "_one.*"))
    held = _prefixes(nodes)
    pairs = _star_pairs(held)
    near = cut(pairs.select("node").union(pairs.select("centre")).distinct())
    sets = _sets_of(docs, nodes, near, words)
    roots = components(_confirmed(pairs, sets))
    blocks = _blocks(held, roots, shingles_each, sets_each).join(held.select("node", "tags", "first"), "node")
    blocks = blocks.repartition("k", "x", "y").sortWithinPartitions("k", "x", "y")
    met = cut(blocks.mapInArrow(_meet, "k long, x int, y int, outer boolean, inner boolean, root long, node long"))
    more = cut(met.select("node").distinct().join(near, "node", "left_anti"))
    sets = sets.union(_sets_of(docs, nodes, more, words))
    dealt = met.join(sets, "node").repartition("k", "x", "y").sortWithinPartitions("k", "x", "y")
    more = cut(dealt.mapInArrow(_compare, "a long, b long").distinct())
    rooted = nodes.select("node", "hash", "least").join(roots, "node", "left").select("hash", "least", F.coalesce("root", "node").alias("root"))
    if not more.isEmpty():
        upper = components(more).select(F.col("node").alias("root"), F.col("root").alias("upper"))
        rooted = rooted.join(upper, "root", "left").select("hash", "least", F.coalesce("upper", "root").alias("root"))
    rooted = cut(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("hash", "component_id")
    alone = rows.where("hash IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.select("doc_id", "n_shingles", "hash").join(named, "hash").select("doc_id", "n_shingles", "component_id").union(alone)


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` without the documents whose class has a smaller doc_id. Rows without a doc_id stay."""
    copies = near_duplicates(docs, words).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(cut(copies), "doc_id", "left_anti").select(*docs.columns)

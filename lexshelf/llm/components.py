"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexshelf.session import cut, spread_join

#: Tasks that the links of one node are dealt over.
WAYS = 8


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return spread_join(both, least, ["a"], by=F.xxhash64("b"), ways=WAYS).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    across = spread_join(down, least, ["a"], by=F.xxhash64("b"), ways=WAYS).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return across.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node that can be reached.

    Alternating large and small stars; every round is a table in the shared folder, so a lost executor costs
    one round at most. The links of one node are dealt over several tasks, so a centre may have very many. The number of
    rounds grows with the logarithm of the longest chain. Links of a node to itself are ignored:
    a node that has no other link is not in the result.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    while state[0]:
        links = cut(_small_star(_large_star(links).where("a <> b")).where("a <> b").distinct())
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct()
    )

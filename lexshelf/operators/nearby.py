"""Tables of points beside tables of points: all within a distance, and the nearest k.

A point is placed on the unit sphere and its three coordinates are cut into cells. Two points nearer than a cell's edge, in a straight line,
lie in the same cell or in neighbouring ones, so an equi-join on cells finds all of them, also across the poles and the date line; the
great-circle distance decides. A crowded cell is split by its measured number of points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexshelf.functions.geo import EARTH_KM, geo_dist
from lexshelf.session import cut, spread_join


def _cells(df: DataFrame, edge: float, around: int = 0) -> DataFrame:
    """With the cell of each point, and those up to ``around`` cells away: (columns, _cell)."""
    lat, lon = F.radians("lat"), F.radians("lon")
    axes = (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
    steps = F.sequence(F.lit(-around), F.lit(around)) if around else F.array(F.lit(0))

    def spread(axis: Column) -> Column:
        own = F.floor(axis / edge).cast("bigint")
        return F.transform(steps, lambda step: own + step)

    places = [spread(axis) for axis in axes]
    cells = F.flatten(
        F.transform(places[0], lambda x: F.flatten(F.transform(places[1], lambda y: F.transform(places[2], lambda z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))))))
    )
    return df.select("*", F.explode(cells).alias("_cell"))


def _chord(km: float) -> float:
    return 2 * math.sin(min(km / EARTH_KM, math.pi) / 2)


def _pairs(points: DataFrame, centres: DataFrame, km: float) -> DataFrame:
    """(columns of both, km): pairs within ``km``; centres come as (query_id, _lat, _lon)."""
    edge = max(_chord(km) * 1.000001, 1e-9)
    held = _cells(points, edge)
    asked = _cells(centres.withColumnsRenamed({"_lat": "lat", "_lon": "lon"}), edge, 1).select("query_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "_cell")
    frequency = held.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
    both = spread_join(held, asked, ["_cell"], by=F.xxhash64("lat", "lon"), frequency=frequency).drop("_cell")
    return both.withColumn("km", geo_dist(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))).where(F.col("km") <= km)


def within(points: DataFrame, centres: DataFrame, km: float) -> DataFrame:
    """Columns of ``points`` (lat, lon, ...) with (query_id, km) of every centre (query_id, lat, lon) that lies within ``km``."""
    asked = centres.select("query_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return _pairs(points.where("lat IS NOT NULL AND lon IS NOT NULL"), asked, km).drop("_lat", "_lon")


def nearest(points: DataFrame, centres: DataFrame, key: str, k: int, digits: int = 6) -> DataFrame:
    """(query_id, key, km, rank): the ``k`` nearest points of every centre; distances are compared rounded, equal ones by key.

    Rings grow: the first is as wide as k points take up on average, and centres that find fewer than k in theirs go on with one four
    times as wide, until it spans the globe. A centre in a crowd is done in the first ring, one in the desert takes a few.
    """
    points = cut(points.where("lat IS NOT NULL AND lon IS NOT NULL").select(key, "lat", "lon"))
    open_ = cut(centres.where("lat IS NOT NULL AND lon IS NOT NULL").select("query_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")))
    count = points.count()
    km = 2 * EARTH_KM * math.sqrt(k / max(count, 1))
    order = Window.partitionBy("query_id").orderBy("km", key)
    found = []
    while True:
        whole = km >= math.pi * EARTH_KM
        near = _pairs(points, open_, km).select("query_id", key, F.round("km", digits).alias("km"))
        best = cut(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        # the last of k has to lie inside the ring by more than rounding
        full: Column = F.col("n") >= k
        done = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("km").alias("far"))
        done = cut(done.where(full & (F.col("far") <= km - 2 * 10.0**-digits)).select("query_id"))
        if whole:
            found.append(best)
            break
        found.append(best.join(done, "query_id", "left_semi"))
        open_ = cut(open_.join(done, "query_id", "left_anti"))
        if open_.isEmpty():
            break
        km *= 4
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("query_id", key, "km", "rank")

"""Points, boxes and great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0087714  # mean Earth radius


def geo_dist(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), F.lit(2.0))
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bbox(lat: Column, lon: Column, lat0: float, lon0: float, km: float = 10.0) -> Column:
    """Inside the box that encloses the circle of ``km`` around a point; literal bounds reach the scan."""
    dlat = math.degrees(km / EARTH_KM)
    low, high = max(lat0 - dlat, -90.0), min(lat0 + dlat, 90.0)
    inside = lat.between(low, high)
    if low <= -90.0 or high >= 90.0:
        return inside  # a pole lies in the circle: every longitude does
    dlon = math.degrees(math.asin(math.sin(km / EARTH_KM) / math.cos(math.radians(lat0))))
    west, east = lon0 - dlon, lon0 + dlon
    if west < -180.0:
        return inside & ((lon >= west + 360.0) | (lon <= east))
    if east > 180.0:
        return inside & ((lon >= west) | (lon <= east - 360.0))
    return inside & lon.between(west, east)

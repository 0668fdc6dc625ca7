"""Great circles on station positions."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0088
# fixed values, clockwise from north
COMPASS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    # `least` would skip a NULL position and answer half the globe
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.when(h > 1, F.lit(1.0)).otherwise(F.sqrt(h)))


def km_between(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Haversine distance in km of two positions, inside a task."""
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in degrees east of north, 0 to 360."""
    p1, p2, dl = F.radians(lat1), F.radians(lat2), F.radians(lon2) - F.radians(lon1)
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def compass_point(bearing: Column) -> Column:
    k = F.pmod(F.bround(F.pmod(bearing, F.lit(360.0)) / 22.5, 0).cast("int"), F.lit(16))
    return F.element_at(F.array(*[F.lit(c) for c in COMPASS]), k + 1)


def padded_box(lat: str, lon: str, fraction: float = 0.08, at_least: float = 0.2) -> list[Column]:
    """Aggregates lon_min, lon_max, lat_min, lat_max padded by a fraction of the span, `at_least` degrees."""
    def pad(c):
        return F.greatest(F.lit(fraction) * (F.max(c) - F.min(c)), F.lit(at_least))
    return [(F.min(lon) - pad(lon)).alias("lon_min"), (F.max(lon) + pad(lon)).alias("lon_max"),
            (F.min(lat) - pad(lat)).alias("lat_min"), (F.max(lat) + pad(lat)).alias("lat_max")]

"""Great-circle distance and coordinate boxes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

# Coordinate boxes of the city, (low, high) each.
CITY_LONGITUDE, CITY_LATITUDE = (-74.03, -73.75), (40.63, 40.85)
WIDE_LONGITUDE, WIDE_LATITUDE = (-74.1, -73.8), (40.5, 40.9)


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in km; 0 when a coordinate is missing."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # rounding may lift a above 1 for antipodes; least() would hide nulls
    a = F.when(a > 1, 1.0).otherwise(a)
    return F.coalesce(F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a)), F.lit(0.0))


def inside_box(pairs, longitude=CITY_LONGITUDE, latitude=CITY_LATITUDE) -> Column:
    """True when every (longitude, latitude) column pair lies in the box."""
    tests = []
    for lon, lat in pairs:
        tests.append(F.col(lon).between(*longitude))
        tests.append(F.col(lat).between(*latitude))
    return reduce(and_, tests)

"""Distance and direction on the sphere, as column expressions in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EARTH_RADIUS = {"miles": 3959.0, "km": 6371.0}
MILES_PER_LAT_DEGREE = 69.0
MILES_PER_LON_DEGREE = 54.6


def _rad(value: Column | float) -> Column:
    return F.radians(value if isinstance(value, Column) else F.lit(float(value)))


def haversine(lat1, lon1, lat2, lon2, unit: str = "miles") -> Column:
    if unit not in EARTH_RADIUS:
        raise ValueError(f"unknown unit {unit!r}")
    half_lat = F.sin((_rad(lat2) - _rad(lat1)) / 2)
    half_lon = F.sin((_rad(lon2) - _rad(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(_rad(lat1)) * F.cos(_rad(lat2)) * half_lon * half_lon
    # rounding can push antipodal points just above 1
    safe = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.lit(2.0 * EARTH_RADIUS[unit]) * F.asin(F.sqrt(safe))


def manhattan(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.abs(lat2 - lat1) * MILES_PER_LAT_DEGREE + F.abs(lon2 - lon1) * MILES_PER_LON_DEGREE


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360)."""
    dlon = _rad(lon2) - _rad(lon1)
    east = F.sin(dlon) * F.cos(_rad(lat2))
    north = F.cos(_rad(lat1)) * F.sin(_rad(lat2)) - F.sin(_rad(lat1)) * F.cos(_rad(lat2)) * F.cos(
        dlon
    )
    return (F.degrees(F.atan2(east, north)) + 360.0) % F.lit(360.0)

"""Location features; every step is skipped when the coordinates are absent."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import clip, cut_code
from meterline.functions.geo import bearing, haversine, manhattan

# Grid bounds, named points (latitude, longitude) and the airport radius.
GRID = {"lat": (40.5, 40.9), "lon": (-74.05, -73.75)}
GRID_CELLS = 5
LANDMARKS = {
    "jfk_airport": (40.6413, -73.7781),
    "lga_airport": (40.7769, -73.8740),
    "ewr_airport": (40.6895, -74.1745),
    "manhattan_center": (40.7580, -73.9855),
    "times_square": (40.7580, -73.9855),
    "central_park": (40.7829, -73.9654),
}
AIRPORT_MILES = 1.0


def _has(df: DataFrame, *ends: str) -> bool:
    return all(f"{e}_{axis}" in df.columns for e in ends for axis in ("latitude", "longitude"))


def _point(end: str) -> tuple[Column, Column]:
    return F.col(f"{end}_latitude"), F.col(f"{end}_longitude")


def trip_distances(df: DataFrame) -> DataFrame:
    if not _has(df, "pickup", "dropoff"):
        return df
    a, b = _point("pickup"), _point("dropoff")
    df = df.withColumns({"haversine_distance": haversine(*a, *b), "manhattan_distance": manhattan(*a, *b)})
    if "trip_distance" in df.columns:
        ratio = F.col("trip_distance") / (F.col("haversine_distance") + 0.001)
        df = df.withColumn("distance_ratio", clip(ratio, 0.5, 5.0))
    return df


def direction(df: DataFrame) -> DataFrame:
    """Bearing, its quadrant (null without a bearing) and its sine and cosine."""
    if not _has(df, "pickup", "dropoff"):
        return df
    df = df.withColumn("bearing", bearing(*_point("pickup"), *_point("dropoff")))
    angle = F.col("bearing")
    quadrant = (
        F.when((angle < 45) | (angle >= 315), "N")
        .when(angle < 135, "E")
        .when(angle < 225, "S")
        .when(angle < 315, "W")
    )
    return df.withColumns(
        {
            "direction": quadrant,
            "bearing_sin": F.sin(F.radians(angle)),
            "bearing_cos": F.cos(F.radians(angle)),
        }
    )


def landmark_distance(df: DataFrame) -> DataFrame:
    """Pickup distance to every named point and dropoff distance to the airports."""
    if not _has(df, "pickup"):
        return df
    columns = {
        f"pickup_dist_to_{name}": haversine(*_point("pickup"), *point)
        for name, point in LANDMARKS.items()
    }
    if _has(df, "dropoff"):
        columns |= {
            f"dropoff_dist_to_{name}": haversine(*_point("dropoff"), *point)
            for name, point in LANDMARKS.items()
            if "airport" in name
        }
    return df.withColumns(columns)


def airport_flags(df: DataFrame) -> DataFrame:
    """Whether a trip starts or ends within a mile of an airport."""
    if not _has(df, "pickup", "dropoff"):
        return df
    airports = [name for name in LANDMARKS if "airport" in name]
    if f"dropoff_dist_to_{airports[0]}" not in df.columns:
        df = landmark_distance(df)

    def near(end: str) -> Column:
        return reduce(or_, [F.col(f"{end}_dist_to_{a}") < AIRPORT_MILES for a in airports])

    return df.withColumns(
        {
            "pickup_at_airport": near("pickup"),
            "dropoff_at_airport": near("dropoff"),
            "is_airport_trip": near("pickup") | near("dropoff"),
        }
    )


def grid_edges(axis: str) -> list[float]:
    low, high = GRID[axis]
    step = (high - low) / GRID_CELLS
    return [low + i * step for i in range(GRID_CELLS)] + [high]


def grid_zone(df: DataFrame) -> DataFrame:
    """Cell of a 5 x 5 grid as ``lat_lon``; null outside the grid, and then never the same zone."""
    if not _has(df, "pickup"):
        return df
    ends = ["pickup", "dropoff"] if _has(df, "dropoff") else ["pickup"]
    for end in ends:
        lat, lon = _point(end)
        df = df.withColumns(
            {
                f"{end}_zone_lat": cut_code(lat, grid_edges("lat")),
                f"{end}_zone_lon": cut_code(lon, grid_edges("lon")),
            }
        )
        # concat is null when a part is null
        zone = F.concat(F.col(f"{end}_zone_lat"), F.lit("_"), F.col(f"{end}_zone_lon"))
        df = df.withColumn(f"{end}_zone", zone)
    if len(ends) == 2:
        same = F.col("pickup_zone") == F.col("dropoff_zone")
        df = df.withColumn("same_zone", F.coalesce(same, F.lit(False)))
    return df


def all_geo(
    df: DataFrame,
    distances: bool = True,
    directions: bool = True,
    locations: bool = True,
    zones: bool = True,
) -> DataFrame:
    if distances:
        df = trip_distances(df)
    if directions:
        df = direction(df)
    if locations:
        df = airport_flags(landmark_distance(df))
    return grid_zone(df) if zones else df



"""Price, speed and category features of a trip, interactions and powers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import clip, cut
from meterline.operators.geospatial import all_geo
from meterline.operators.temporal import all_temporal

# Bin edges (right-closed) and labels.
SPEED_BINS = (0, 10, 20, 30, 40, 120)
SPEED_LABELS = ("very_slow", "slow", "medium", "fast", "very_fast")
DISTANCE_BINS = (0, 1, 3, 5, 10, 100)
DURATION_BINS = (0, 10, 20, 30, 60, 500)
LENGTH_LABELS = ("very_short", "short", "medium", "long", "very_long")
EPSILON = 0.001


def trip_features(df: DataFrame) -> DataFrame:
    have, new = set(df.columns), {}
    if {"fare_amount", "trip_distance"} <= have:
        price = F.col("fare_amount") / (F.col("trip_distance") + EPSILON)
        new["price_per_mile"] = clip(price, 0, 100)
    if {"tip_amount", "fare_amount"} <= have:
        # a fare of exactly -0.001 has no percentage
        share = F.try_divide(F.col("tip_amount"), F.col("fare_amount") + EPSILON) * 100
        new["tip_percentage"] = clip(share, 0, 100)
    if {"total_amount", "passenger_count"} <= have:
        new["cost_per_person"] = F.try_divide(F.col("total_amount"), F.col("passenger_count"))
    if "speed_mph" in have:
        new["speed_category"] = cut(F.col("speed_mph"), SPEED_BINS, SPEED_LABELS)
    if "trip_distance" in have:
        new["distance_category"] = cut(F.col("trip_distance"), DISTANCE_BINS, LENGTH_LABELS)
    if "trip_duration_minutes" in have:
        new["duration_category"] = cut(F.col("trip_duration_minutes"), DURATION_BINS, LENGTH_LABELS)
    return df.withColumns(new) if new else df


def interactions(df: DataFrame) -> DataFrame:
    have, new = set(df.columns), {}
    if {"trip_distance", "hour"} <= have:
        new["distance_hour_interaction"] = F.col("trip_distance") * F.col("hour")
    if {"is_rush_hour", "trip_distance"} <= have:
        new["rush_hour_distance"] = F.col("is_rush_hour").cast("int") * F.col("trip_distance")
    if {"is_weekend", "hour"} <= have:
        new["weekend_hour"] = F.col("is_weekend").cast("int") * F.col("hour")
    return df.withColumns(new) if new else df


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    """Powers 2..degree of each column; no cross terms."""
    new = {
        f"{c}_pow{d}": F.pow(F.col(c), F.lit(d))
        for c in columns
        if c in df.columns
        for d in range(2, degree + 1)
    }
    return df.withColumns(new) if new else df


def all_features(
    df: DataFrame,
    temporal: bool = True,
    geospatial: bool = True,
    trip: bool = True,
    with_interactions: bool = False,
    with_polynomials: bool = False,
) -> DataFrame:
    """All feature groups as one lazy plan."""
    if temporal:
        df = all_temporal(df)
    if geospatial:
        df = all_geo(df)
    if trip:
        df = trip_features(df)
    if with_interactions:
        df = interactions(df)
    if with_polynomials:
        df = polynomial(df, ["trip_distance", "fare_amount"])
    return df

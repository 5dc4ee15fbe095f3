"""Calendar features of the pickup time; row-local, so they also run on a stream."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rush hours, business hours and encoded cycles.
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
BUSINESS_HOURS = (9, 17)
CYCLES = {"hour": 24, "day_of_week": 7, "month": 12, "day_of_year": 365}


def datetime_parts(df: DataFrame, column: str = "pickup_datetime") -> DataFrame:
    if column not in df.columns:
        return df
    at = F.col(column)
    return df.withColumns(
        {
            "year": F.year(at),
            "month": F.month(at),
            "day": F.dayofmonth(at),
            "hour": F.hour(at),
            "minute": F.minute(at),
            "day_of_week": F.weekday(at),
            "day_of_year": F.dayofyear(at),
            "week_of_year": F.weekofyear(at),
            "quarter": F.quarter(at),
        }
    )


def cyclical(df: DataFrame, column: str, period: float) -> DataFrame:
    if column not in df.columns:
        return df
    angle = F.col(column) * F.lit(2.0 * math.pi) / F.lit(float(period))
    return df.withColumns({f"{column}_sin": F.sin(angle), f"{column}_cos": F.cos(angle)})


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 20), "evening")
        .when(hour.isNotNull(), "night")
    )


def time_category(df: DataFrame) -> DataFrame:
    if "hour" not in df.columns:
        return df
    if "day_of_week" not in df.columns:
        df = df.withColumn("day_of_week", F.weekday("pickup_datetime"))
    hour, weekend = F.col("hour"), F.col("day_of_week").isin(5, 6)
    return df.withColumns(
        {
            "time_of_day": time_of_day(hour),
            "is_rush_hour": hour.isin(*RUSH_HOURS),
            "is_weekend": weekend,
            "is_business_hours": hour.between(*BUSINESS_HOURS) & ~weekend,
        }
    )


def holiday(
    df: DataFrame, column: str = "pickup_datetime", exact_thanksgiving: bool = False
) -> DataFrame:
    """Holiday flags. Thanksgiving is any day of 22-28 November; exact means that Thursday."""
    if column not in df.columns:
        return df
    at = F.col(column)
    month, day = F.month(at), F.dayofmonth(at)
    thanksgiving = (month == 11) & day.between(22, 28)
    if exact_thanksgiving:
        thanksgiving = thanksgiving & (F.weekday(at) == 3)
    flags = {
        "is_new_years": (month == 1) & (day == 1),
        "is_july_4th": (month == 7) & (day == 4),
        "is_thanksgiving": thanksgiving,
        "is_christmas": (month == 12) & (day == 25),
    }
    new_year, july, thanks, christmas = flags.values()
    return df.withColumns({**flags, "is_holiday": new_year | july | thanks | christmas})


def all_temporal(
    df: DataFrame,
    column: str = "pickup_datetime",
    cycles: bool = True,
    categories: bool = True,
    holidays: bool = True,
) -> DataFrame:
    df = datetime_parts(df, column)
    if cycles:
        for name, period in CYCLES.items():
            df = cyclical(df, name, period)
    if categories:
        df = time_category(df)
    return holiday(df, column) if holidays else df

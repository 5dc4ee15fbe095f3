"""Cleaning steps and their composition."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schemas
from meterline.functions.columns import (
    clip,
    number_literal,
    quoted,
    rows_from,
    seconds_between,
    text_literal,
)
from meterline.operators.quantiles import approx_quantiles, iqr_fences, quantiles
from meterline.sources.raw import as_datetime
from meterline.sources.staging import stage

# Speed limits in miles per hour and the fence factor of the full cleaning.
MAX_SPEED, FULL_CLEAN_FACTOR = 120.0, 3.0


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(subset=schemas.present(df, schemas.CRITICAL_TRIP))


def impute_median(df: DataFrame) -> DataFrame:
    """Nulls of numeric columns become the exact median of the column."""
    columns = schemas.numeric_columns(df)
    medians = quantiles(df, columns, (0.5,))
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])).alias(c)
            if c in medians and medians[c][0] is not None
            else F.col(c)
            for c in df.columns
        ]
    )


def modes(df: DataFrame, columns: Sequence[str], missing: str = "Unknown") -> dict[str, str]:
    """Most frequent value per column, the smallest on ties.

    Counts are aggregated per (column, value) before any comparison, so the state of one task
    does not grow with the number of distinct values of a column.
    """
    if not columns:
        return {}
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    # max picks the largest count; among equals the value must be the smallest
    best = counts.groupBy("column_name").agg(F.max("n").alias("n"))
    rows = (
        counts.join(F.broadcast(best), ["column_name", "n"])  # one row per column
        .groupBy("column_name")
        .agg(F.min("value").alias("value"))
        .collect()
    )
    found = {r["column_name"]: r["value"] for r in rows}
    return {c: found.get(c, missing) for c in columns}


def impute_mode(df: DataFrame) -> DataFrame:
    """Nulls of string columns become the mode, ``Unknown`` where the column is all null."""
    columns = schemas.string_columns(df)
    return df.fillna(modes(df, columns)) if columns else df


VALID_RULES = (
    ("distance", ("trip_distance",), "trip_distance > 0"),
    ("fare", ("fare_amount",), "fare_amount >= 0"),
    ("passengers", ("passenger_count",), "passenger_count > 0"),
    ("datetime_order", schemas.DATETIME_TRIP, "dropoff_datetime > pickup_datetime"),
)


def _rules(df: DataFrame):
    return [(n, F.expr(e)) for n, cols, e in VALID_RULES if all(c in df.columns for c in cols)]


def drop_invalid(df: DataFrame) -> DataFrame:
    """Keep rows with positive distance, passengers and duration and a fare of at least 0."""
    for _, rule in _rules(df):
        df = df.filter(rule)
    return df


def cap_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    factor: float = 1.5,
    approx: bool = False,
) -> dict[str, tuple[float, float]]:
    """Capping limits per column, the lower one never below 0."""
    columns = schemas.present(df, columns if columns is not None else schemas.CAPPED_TRIP)
    if method == "iqr":
        found = iqr_fences(df, columns, factor, approx)
    elif method == "percentile":
        find = approx_quantiles if approx else quantiles
        found = {
            c: None if low is None else (low, high)
            for c, (low, high) in find(df, columns, (0.01, 0.99)).items()
        }
    else:
        raise ValueError(f"unknown method {method!r}: use 'iqr' or 'percentile'")
    return {c: (max(0.0, b[0]), b[1]) for c, b in found.items() if b is not None}


def apply_caps(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: clip(F.col(c).cast("double"), low, high) for c, (low, high) in bounds.items()}
    )


def cap_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    factor: float = 1.5,
    approx: bool = False,
) -> DataFrame:
    """Limit the money and distance columns; the limits are read first, then literals."""
    return apply_caps(df, cap_bounds(df, columns, method, factor, approx))


CAPPED = "column_name string, capped_count bigint, lower_bound double, upper_bound double"


def count_capped(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """(column_name, capped_count, lower_bound, upper_bound)."""
    if not bounds:
        return df.sparkSession.createDataFrame([], CAPPED)
    counts, entries = [], []
    for i, (c, limits) in enumerate(bounds.items()):
        low, high = (number_literal(v) for v in limits)
        counts.append(f"count_if({quoted(c)} < {low} OR {quoted(c)} > {high}) AS c{i}")
        entries.append(
            {
                "column_name": text_literal(c),
                "capped_count": f"c{i}",
                "lower_bound": low,
                "upper_bound": high,
            }
        )
    return rows_from(df.agg(*[F.expr(t) for t in counts]), entries)


def fix_types(df: DataFrame) -> DataFrame:
    """Dates become timestamps or null, ids integers and amounts doubles with 0 for null."""

    def fixed(name: str):
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        value = F.col(name) if numeric else F.expr(f"try_cast(`{name}` as double)")
        if name in schemas.DATETIME_TRIP:
            return as_datetime(df, name)
        if name in schemas.INTEGER_TRIP:
            # a value without an integer form (NaN, out of range) counts as missing
            return F.coalesce(value.try_cast("int"), F.lit(0))
        if name in schemas.FLOAT_TRIP:
            return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.col(name)

    return df.select(*[fixed(c).alias(c) for c in df.columns])


def derive_trip(df: DataFrame) -> DataFrame:
    """Duration, speed and calendar columns; rows without a positive duration are dropped."""
    if all(c in df.columns for c in schemas.DATETIME_TRIP):
        pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
        # the same rows as duration > 0, but cheap where the filter is pushed down to
        df = df.filter(dropoff > pickup).withColumn(
            "trip_duration", seconds_between(pickup, dropoff)
        )
        df = df.withColumn("trip_duration_minutes", F.col("trip_duration") / 60)
    if {"trip_distance", "trip_duration"} <= set(df.columns):
        hours = F.col("trip_duration") / 3600
        speed = F.coalesce(F.try_divide(F.col("trip_distance"), hours), F.lit(0.0))
        speed = F.when(F.col("trip_distance").isNotNull() & hours.isNotNull(), speed)
        df = df.withColumn("speed_mph", clip(speed, 0.0, MAX_SPEED))
    if "pickup_datetime" in df.columns:
        pickup = F.col("pickup_datetime")
        df = df.withColumns(
            {
                "hour_of_day": F.hour(pickup),
                "day_of_week": F.weekday(pickup),
                "month": F.month(pickup),
                "is_weekend": F.weekday(pickup).isin(5, 6),
            }
        )
    return df


@dataclass(frozen=True)
class Cleaned:
    trips: DataFrame
    counters: DataFrame
    capped: DataFrame
    bounds: dict[str, tuple[float, float]]


def clean_all(df: DataFrame, strict: bool = False, approx: bool = False) -> Cleaned:
    """Dedupe, fix types, drop missing and invalid rows, cap at 3 IQR, derive columns.

    The types are fixed before missing values are dropped, so a null fare becomes 0 and stays;
    ``strict`` drops missing values first. The deduplicated rows are written once with the first
    rule each row breaks: limits, counters and the result are passes over that narrow-readable
    table and the full-row shuffle runs a single time.
    """
    critical = schemas.present(df, schemas.CRITICAL_TRIP)
    any_null = reduce(or_, [F.col(c).isNull() for c in critical], F.lit(False))
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    typed = fix_types(copies.withColumn("_absent", any_null if strict else F.lit(False)))
    lost = F.col("_absent") | any_null
    fault = F.when(lost, "missing")
    for name, rule in _rules(df):
        fault = fault.when(~F.coalesce(rule, F.lit(False)), name)
    staged = stage(typed.withColumn("_fault", fault).drop("_absent"), "deduplicated")

    sound = staged.filter(F.col("_fault").isNull()).select(*df.columns)
    bounds = cap_bounds(sound, method="iqr", factor=FULL_CLEAN_FACTOR, approx=approx)
    trips = derive_trip(apply_caps(sound, bounds))
    return Cleaned(trips, _counters(staged), count_capped(sound, bounds), bounds)


def _counters(staged: DataFrame) -> DataFrame:
    """One row of step counters from the tagged rows."""

    def having(tag):
        return F.count_if(F.col("_fault") == tag)

    names = [n for n, _, _ in VALID_RULES]
    return (
        staged.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("initial_rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates_removed"),
            having("missing").alias("missing_removed"),
            *[having(n).alias(f"{n}_removed") for n in names],
            F.count_if(F.col("_fault").isNull()).alias("final_rows"),
        )
        .withColumn("total_removed", F.col("initial_rows") - F.col("final_rows"))
        .withColumn(
            "removal_percentage",
            F.try_divide(F.col("total_removed") * 100.0, F.col("initial_rows")),
        )
    )

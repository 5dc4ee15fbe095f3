"""Summary views and dashboard aggregates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.columns import half_up


def trip_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(
        F.count("*").alias("total_trips"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.sum("total_amount").alias("total_revenue"),
    )


def payment_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("payment_type").agg(
        F.count("*").alias("trip_count"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("total_amount").alias("avg_total"),
    )


def register_views(trips: DataFrame) -> None:
    """Session views over the cleaned trips, under the names the dashboards ask for."""
    trip_summary(trips).createOrReplaceTempView("v_trip_summary")
    payment_distribution(trips).createOrReplaceTempView("v_payment_distribution")


def trip_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_trips"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_amount").alias("avg_fare"),
        F.min("fare_amount").alias("min_fare"),
        F.max("fare_amount").alias("max_fare"),
    )


def payment_share(df: DataFrame) -> DataFrame:
    """Trips and percentage per payment type, most frequent first.

    The total is a scalar subquery over the aggregated groups.
    """
    per_type = df.groupBy("payment_type").agg(F.count("*").alias("trip_count"))
    total = per_type.agg(F.sum("trip_count")).scalar()
    share = F.col("trip_count") * 100.0 / total
    return (
        per_type.select("payment_type", "trip_count", half_up(share, 2).alias("percentage"))
        .orderBy(F.col("trip_count").desc(), "payment_type")
    )


def table_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count per table; a table that does not exist counts 0."""
    counts = None
    for name in names:
        if spark.catalog.tableExists(name):
            row = spark.table(name).agg(F.count("*").alias("row_count"))
        else:
            row = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        row = row.select(F.lit(name).alias("table_name"), "row_count")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def feature_store_stats(store: DataFrame) -> DataFrame:
    return store.agg(
        F.count("*").alias("total_features"),
        F.min("created_at").alias("oldest_record"),
        F.max("created_at").alias("newest_record"),
    )


def recent_rows(
    df: DataFrame, column: str, as_of: dt.datetime, days: int, limit: int, tie: Sequence[str] = ()
) -> DataFrame:
    """Newest rows of the last days before ``as_of``: a pushed filter and a top-k."""
    start = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
    return (
        df.filter(F.col(column) >= start)
        .orderBy(F.col(column).desc(), *[F.col(c) for c in tie])
        .limit(limit)
    )

"""Cleaning steps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.fixture import (
    BASE,
    KEEP,
    SQL_CLEAN,
    SQL_TRIPS,
    SQL_UNFILLED,
    VALID,
    sql,
    trips,
    unfilled,
    usable,
    with_copies,
    USABLE,
)
from checks.output import plain, sql_round, sql_time
from meterline.operators import clean
from meterline.plans.jobs import clean_job
from meterline.sources.raw import prepare_raw
from meterline.sources.staging import scratch_path
from meterline.sources.tables import write_table

ENTRIES: dict = {}

_MONEY = "trip_distance fare_amount extra mta_tax tip_amount tolls_amount total_amount".split()
_IDS = "trip_id vendor_id rate_code store_and_fwd_flag pickup_location_id dropoff_location_id payment_type".split()
ROW = [*_IDS, "passenger_count", "pickup_datetime", "dropoff_datetime", *_MONEY]
ROW_SQL = (
    ", ".join([*_IDS, "passenger_count"])
    + ", "
    + sql_time("pickup_datetime", "dropoff_datetime")
    + ", "
    + sql_round(*_MONEY)
)
DERIVED = ["hour_of_day", "day_of_week", "month", "is_weekend"]
DERIVED_SQL = ", ".join(DERIVED) + ", " + sql_round("trip_duration", "trip_duration_minutes", "speed_mph")
DERIVED = [*DERIVED, "trip_duration", "trip_duration_minutes", "speed_mph"]


def raw_copies(spark, sf_dir):
    """Prepared trips with repeated rows."""
    return prepare_raw(with_copies(trips(spark, sf_dir)), keep=KEEP)


ENTRIES["C1_dedupe"] = (
    lambda spark, sf_dir: plain(clean.dedupe(raw_copies(spark, sf_dir)).select(*ROW)),
    sql(f"SELECT {ROW_SQL} FROM prepared", *BASE),
)

ENTRIES["C2_drop_missing"] = (
    lambda spark, sf_dir: plain(clean.drop_missing(unfilled(spark, sf_dir)).select(*ROW)),
    sql(
        f"SELECT {ROW_SQL} FROM unfilled WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"
        " AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

_IMPUTED = ("passenger_count", "trip_distance", "fare_amount")
ENTRIES["C3_impute_median"] = (
    lambda spark, sf_dir: plain(
        clean.impute_median(unfilled(spark, sf_dir).select("trip_id", *_IMPUTED)).select(
            F.col("trip_id").cast("bigint").alias("trip_id"), *_IMPUTED
        )
    ),
    sql(
        "SELECT trip_id, "
        + sql_round(
            *[f"coalesce({c}, (SELECT median({c}) FROM unfilled)) AS {c}" for c in _IMPUTED]
        )
        + " FROM unfilled",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

ENTRIES["C4_impute_mode"] = (
    lambda spark, sf_dir: clean.impute_mode(
        unfilled(spark, sf_dir)
        .select("trip_id", "store_and_fwd_flag")
        .withColumn("empty", F.lit(None).cast("string"))
    ),
    sql(
        "SELECT trip_id, coalesce(store_and_fwd_flag, (SELECT store_and_fwd_flag FROM unfilled"
        " WHERE store_and_fwd_flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))"
        " AS store_and_fwd_flag, 'Unknown' AS empty FROM unfilled",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

ENTRIES["C5_drop_invalid"] = (
    lambda spark, sf_dir: plain(clean.drop_invalid(unfilled(spark, sf_dir)).select(*ROW)),
    sql(f"SELECT {ROW_SQL} FROM unfilled WHERE {VALID}", SQL_TRIPS, SQL_UNFILLED),
)

_CAPPED = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def _cap_sql(low: str, high: str) -> str:
    columns = [
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, (SELECT greatest(0, {low.format(c=c)}) FROM unfilled)),"
        f" (SELECT {high.format(c=c)} FROM unfilled)) END AS {c}"
        for c in _CAPPED
    ]
    return sql("SELECT trip_id, " + sql_round(*columns) + " FROM unfilled", SQL_TRIPS, SQL_UNFILLED)


_IQR = "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
ENTRIES["C6_cap_iqr"] = (
    lambda spark, sf_dir: plain(
        clean.cap_outliers(unfilled(spark, sf_dir), method="iqr", factor=0.5).select("trip_id", *_CAPPED)
    ),
    _cap_sql("quantile_cont({c}, 0.25) - 0.5 * " + _IQR, "quantile_cont({c}, 0.75) + 0.5 * " + _IQR),
)
ENTRIES["C7_cap_percentile"] = (
    lambda spark, sf_dir: plain(
        clean.cap_outliers(unfilled(spark, sf_dir), method="percentile").select("trip_id", *_CAPPED)
    ),
    _cap_sql("quantile_cont({c}, 0.01)", "quantile_cont({c}, 0.99)"),
)


def fix_types(spark, sf_dir):
    """The prepared trips as text, some of it unreadable, turned back into types."""
    text = unfilled(spark, sf_dir).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("string"),
            "payment_type": F.when(F.col("payment_type") == 4, "cash").otherwise(
                F.col("payment_type").cast("string")
            ),
            "pickup_datetime": F.when(F.col("vendor_id") == 2, "unknown").otherwise(
                F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")
            ),
        }
    )
    return plain(clean.fix_types(text).select(*ROW))


ENTRIES["C8_fix_types"] = (
    fix_types,
    sql(
        f"""SELECT {ROW_SQL} FROM (SELECT * REPLACE (
 coalesce(CAST(passenger_count AS INT), 0) AS passenger_count,
 CASE WHEN payment_type = 4 THEN 0 ELSE payment_type END AS payment_type,
 CASE WHEN vendor_id = 1 THEN pickup_datetime END AS pickup_datetime,
 coalesce(trip_distance, 0) AS trip_distance, coalesce(fare_amount, 0) AS fare_amount) FROM unfilled)""",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

ENTRIES["C9_derive_trip"] = (
    lambda spark, sf_dir: plain(usable(spark, sf_dir).select("trip_id", *DERIVED)),
    sql(f"SELECT trip_id, {DERIVED_SQL} FROM usable", *USABLE),
)


def clean_all(spark, sf_dir):
    return plain(clean.clean_all(raw_copies(spark, sf_dir)).trips.select(*ROW, *DERIVED))


ENTRIES["C10_clean_all"] = (clean_all, sql(f"SELECT {ROW_SQL}, {DERIVED_SQL} FROM clean", *SQL_CLEAN))


def clean_counters(spark, sf_dir):
    return plain(clean.clean_all(raw_copies(spark, sf_dir)).counters)


COUNTERS_SQL = """SELECT i AS initial_rows, i - d AS duplicates_removed, 0 AS missing_removed, a AS distance_removed,
 b AS fare_removed, c AS passengers_removed, d - a - b - c - f AS datetime_order_removed, f AS final_rows,
 i - f AS total_removed, round((i - f) * 100.0::DOUBLE / i, 6) + 0.0 AS removal_percentage
 FROM (SELECT (SELECT count(*) FROM copies) AS i, (SELECT count(*) FROM distinct_trips) AS d,
 (SELECT count(*) FROM distinct_trips WHERE NOT trip_distance > 0) AS a,
 (SELECT count(*) FROM distinct_trips WHERE trip_distance > 0 AND NOT fare_amount >= 0) AS b,
 (SELECT count(*) FROM distinct_trips WHERE trip_distance > 0 AND fare_amount >= 0 AND NOT passenger_count > 0) AS c,
 (SELECT count(*) FROM sound) AS f)"""
ENTRIES["C10_clean_counters"] = (clean_counters, sql(COUNTERS_SQL, *SQL_CLEAN))


def clean_table(spark, sf_dir):
    """The whole job from table to table; what it wrote, per payment type."""
    mark = uuid.uuid4().hex
    source, target = f"raw_{mark}", f"processed_{mark}"
    write_table(raw_copies(spark, sf_dir), source, "fail", path=scratch_path(spark, "raw"))
    clean_job(spark, source, target, path=scratch_path(spark, "processed"))
    return plain(
        spark.table(target)
        .groupBy("payment_type")
        .agg(
            F.count("*").alias("trips"),
            F.sum("total_amount").alias("revenue"),
            F.avg("speed_mph").alias("avg_speed"),
        )
    )


ENTRIES["C11_clean_job"] = (
    clean_table,
    sql(
        "SELECT payment_type, count(*) AS trips, "
        + sql_round("sum(total_amount) AS revenue", "avg(speed_mph) AS avg_speed")
        + " FROM clean GROUP BY 1",
        *SQL_CLEAN,
    ),
)


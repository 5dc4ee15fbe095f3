"""Trip tables derived from the given tables, for Spark and as SQL text.

``TRIPS`` is the same text in both engines. The other SQL pieces restate in plain SQL what the
operators compute, so that a query can be compared with an independent formulation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.operators.clean import derive_trip, drop_invalid, fix_types
from meterline.schemas import COORDINATES
from meterline.sources.files import scan_parquet
from meterline.sources.raw import prepare_raw

TRIPS = """
 SELECT trip_id,
 CAST(l_suppkey % 2 + 1 AS INT) AS VendorID,
 pu AS tpep_pickup_datetime,
 pu + dur * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
 CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST((l_partkey + l_linenumber) % 7 AS DOUBLE) END AS passenger_count,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -dist ELSE dist END AS trip_distance,
 CAST(1 + l_linenumber % 5 AS DOUBLE) AS RatecodeID,
 CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
 CAST(l_partkey % 265 + 1 AS INT) AS PULocationID,
 CAST((l_suppkey*7 + l_linenumber) % 265 + 1 AS INT) AS DOLocationID,
 CAST(l_linenumber % 4 + 1 AS INT) AS payment_type,
 CASE WHEN l_orderkey % 107 = 0 THEN -fare WHEN l_orderkey % 109 = 0 THEN NULL ELSE fare END AS fare_amount,
 CAST(l_tax * 10 AS DOUBLE) AS extra,
 CAST(0.5 AS DOUBLE) AS mta_tax,
 fare * l_discount * 2 AS tip_amount,
 CASE WHEN l_linenumber = 7 THEN CAST(6.55 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
 CAST(0.3 AS DOUBLE) AS improvement_surcharge,
 fare * (1 + l_discount * 2) + l_tax * 10 AS total_amount,
 CAST(2.5 AS DOUBLE) AS congestion_surcharge,
 CAST(0 AS DOUBLE) AS airport_fee,
 CAST(40.45 AS DOUBLE) + CAST((l_partkey*37) % 1000 AS DOUBLE) / 2000 AS pickup_latitude,
 CAST(-74.2 AS DOUBLE) + CAST((l_partkey*53) % 1000 AS DOUBLE) / 2000 AS pickup_longitude,
 CAST(40.45 AS DOUBLE) + CAST((l_suppkey*71 + l_linenumber*113) % 1000 AS DOUBLE) / 2000 AS dropoff_latitude,
 CAST(-74.2 AS DOUBLE) + CAST((l_suppkey*89 + l_linenumber*131) % 1000 AS DOUBLE) / 2000 AS dropoff_longitude
FROM (
 SELECT (l_orderkey*100000 + l_partkey)*8 + l_linenumber AS trip_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_discount, l_tax,
  l_shipdate + ((l_orderkey*7919 + l_linenumber*977) % 86400) * INTERVAL '1' SECOND AS pu,
  (l_partkey*31 + l_orderkey*13 + l_linenumber*17) % 5400 - 60 AS dur,
  l_quantity / 4 AS dist,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 9000 AS DOUBLE) / 100 AS fare
 FROM {lineitem})
"""

KEEP = ("trip_id", *COORDINATES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the source file layout."""
    return spark.sql(TRIPS, lineitem=table(spark, sf_dir, "lineitem"))


def with_copies(df: DataFrame) -> DataFrame:
    """The same rows with one in 101 repeated."""
    return df.unionAll(df.filter("trip_id % 101 = 0"))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_raw(trips(spark, sf_dir), keep=KEEP)


def unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared trips whose nulls are kept."""
    return prepare_raw(trips(spark, sf_dir), fill_nulls=False, keep=KEEP)


def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid trips with derived columns, without deduplication and capping."""
    return derive_trip(drop_invalid(fix_types(prepared(spark, sf_dir))))


# --- SQL pieces -----------------------------------------------------------------------------

_RENAMED = """trip_id, VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
 tpep_dropoff_datetime AS dropoff_datetime, {passenger} AS passenger_count,
 {distance} AS trip_distance, RatecodeID AS rate_code, store_and_fwd_flag,
 PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id, payment_type,
 {fare} AS fare_amount, extra, mta_tax, tip_amount, tolls_amount, total_amount,
 pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude"""

SQL_TRIPS = "trips AS (" + TRIPS.format(lineitem="lineitem") + ")"
SQL_COPIES = "copies AS (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE trip_id % 101 = 0)"


def sql_renamed(name: str, source: str, fill: bool) -> str:
    wrap = "coalesce({}, 0)" if fill else "{}"
    columns = _RENAMED.format(
        passenger=wrap.format("passenger_count"),
        distance=wrap.format("trip_distance"),
        fare=wrap.format("fare_amount"),
    )
    return f"{name} AS (SELECT {columns} FROM {source})"


SQL_PREPARED = sql_renamed("prepared", "trips", True)
SQL_UNFILLED = sql_renamed("unfilled", "trips", False)

VALID = "trip_distance > 0 AND fare_amount >= 0 AND passenger_count > 0 AND dropoff_datetime > pickup_datetime"

DERIVED = """CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS DOUBLE) AS trip_duration,
 CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60 AS trip_duration_minutes,
 greatest(0, least(120, trip_distance / (CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS DOUBLE) / 3600))) AS speed_mph,
 CAST(hour(pickup_datetime) AS INT) AS hour_of_day,
 CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week,
 CAST(month(pickup_datetime) AS INT) AS month,
 isodow(pickup_datetime) >= 6 AS is_weekend"""

SQL_USABLE = f"""usable AS (SELECT * REPLACE (CAST(passenger_count AS INT) AS passenger_count), {DERIVED}
 FROM prepared WHERE {VALID})"""

BASE = (SQL_TRIPS, SQL_PREPARED)
USABLE = (*BASE, SQL_USABLE)


def sql(body: str, *pieces: str) -> str:
    """A query with its common table expressions."""
    return f"WITH {', '.join(pieces)} {body}" if pieces else body


# cleaned trips: distinct rows, valid ones, limits at 3 IQR, derived columns
SQL_CLEAN = (
    *BASE,
    sql_renamed("filled_copies", "copies", True),
    "distinct_trips AS (SELECT DISTINCT * REPLACE (CAST(passenger_count AS INT) AS passenger_count) FROM filled_copies)",
    f"sound AS (SELECT * FROM distinct_trips WHERE {VALID})",
    "limits AS (SELECT "
    + ", ".join(
        f"greatest(0, quantile_cont({c}, 0.25) - 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))) AS {c}_low, "
        f"quantile_cont({c}, 0.75) + 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_high"
        for c in ("trip_distance", "fare_amount", "tip_amount", "total_amount")
    )
    + " FROM sound)",
    "capped AS (SELECT sound.* REPLACE ("
    + ", ".join(
        f"least(greatest({c}, {c}_low), {c}_high) AS {c}"
        for c in ("trip_distance", "fare_amount", "tip_amount", "total_amount")
    )
    + ") FROM sound, limits)",
    f"clean AS (SELECT *, {DERIVED} FROM capped)",
)
SQL_CLEAN = (SQL_CLEAN[0], SQL_COPIES, *SQL_CLEAN[1:])

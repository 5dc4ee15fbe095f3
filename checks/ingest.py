"""Sources, sinks and table access."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.fixture import (
    BASE,
    SQL_TRIPS,
    SQL_UNFILLED,
    prepared,
    sql,
    table,
    trips,
    unfilled,
)
from checks.output import plain, sql_round, sql_time
from checks.pieces import PREPARED_COLUMNS, PREPARED_NUMERIC, describe, null_counts
from meterline import schemas
from meterline.operators.sampling import sample_n
from meterline.operators.views import payment_distribution
from meterline.sources import files, footers, raw, tables
from meterline.sources.staging import scratch_path

ENTRIES: dict = {}

FILES = files.month_files(2023, 1, 3)


def _monthly(spark, sf_dir):
    """Three monthly files of the trips; the second one lacks a column."""
    folder = scratch_path(spark, "monthly")
    source = trips(spark, sf_dir)
    paths = files.month_paths(folder, 2023, 1, 3)
    for i, path in enumerate(paths):
        part = source.filter(F.col("PULocationID") % 3 == i)
        (part.drop("airport_fee") if i == 1 else part).write.parquet(path)
    return paths


def month_paths(spark, sf_dir):
    paths = _monthly(spark, sf_dir)
    rows = spark.read.schema(schemas.struct(("trip_id", schemas.LONG))).parquet(*paths)
    return rows.select(footers.file_name(F.col("_metadata.file_path")).alias("file_name"), "trip_id").groupBy("file_name").agg(
        F.count("*").alias("total_rows")
    )


ENTRIES["S1_month_paths"] = (
    month_paths,
    sql(
        "SELECT CASE PULocationID % 3 "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(FILES))
        + " END AS file_name, count(*) AS total_rows FROM trips GROUP BY 1",
        SQL_TRIPS,
    ),
)

ENTRIES["S2_scan_parquet"] = (
    lambda spark, sf_dir: plain(table(spark, sf_dir, "orders")),
    "SELECT o_orderkey, o_custkey, o_orderstatus, "
    + sql_round("o_totalprice")
    + ", "
    + sql_time("o_orderdate")
    + ", o_orderpriority FROM orders",
)


def ingest_many(spark, sf_dir):
    paths = _monthly(spark, sf_dir)
    loaded = files.ingest_many(spark, [*paths, paths[0].replace("2023-01", "2023-12")])
    good = plain(
        loaded.trips.groupBy(F.col("source_file").alias("file_name")).agg(
            F.count("*").alias("total_rows"),
            F.count("airport_fee").alias("with_airport_fee"),
            F.sum("fare_amount").alias("fare_total"),
        )
    )
    bad = loaded.rejected.select(
        F.regexp_extract("path", r"[^/]+$", 0).alias("file_name"),
        F.lit(0).cast("bigint").alias("total_rows"),
        F.lit(0).cast("bigint").alias("with_airport_fee"),
        F.lit(None).cast("double").alias("fare_total"),
    )
    return good.unionByName(bad)


ENTRIES["S3_ingest_many"] = (
    ingest_many,
    sql(
        "SELECT CASE PULocationID % 3 "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(FILES))
        + " END AS file_name, count(*) AS total_rows,"
        " count(CASE WHEN PULocationID % 3 <> 1 THEN airport_fee END) AS with_airport_fee,"
        " round(sum(fare_amount), 6) + 0.0 AS fare_total FROM trips GROUP BY 1"
        " UNION ALL SELECT 'yellow_tripdata_2023-12.parquet', 0, 0, NULL",
        SQL_TRIPS,
    ),
)

_DECLARED = ", ".join(f"('{n}')" for n in schemas.SOURCE_TRIPS.names)
_ESSENTIAL = ", ".join(f"('{n}')" for n in schemas.ESSENTIAL_SOURCE)


def schema_check(spark, sf_dir):
    return raw.source_schema_check(
        trips(spark, sf_dir).drop("airport_fee").withColumnRenamed("fare_amount", "fare")
    )


ENTRIES["S4_source_schema_check"] = (
    schema_check,
    sql(
        f"""SELECT 'missing' AS check_name, n AS column_name, true AS passed FROM declared WHERE n NOT IN (SELECT column_name FROM have)
 UNION ALL SELECT 'extra', column_name, true FROM have WHERE column_name NOT IN (SELECT n FROM declared)
 UNION ALL SELECT 'essential', n, false FROM (VALUES {_ESSENTIAL}) e(n) WHERE n NOT IN (SELECT column_name FROM have)
 UNION ALL SELECT 'schema', NULL, count(*) = 0 FROM (VALUES {_ESSENTIAL}) e(n) WHERE n NOT IN (SELECT column_name FROM have)""",
        SQL_TRIPS,
        f"declared(n) AS (VALUES {_DECLARED})",
        "have AS (SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE (airport_fee) RENAME (fare_amount AS fare) FROM trips))",
    ),
)

_MONEY = "trip_distance fare_amount extra mta_tax tip_amount tolls_amount total_amount".split()
_PLAIN_TRIP = (
    "trip_id, vendor_id, passenger_count, rate_code, store_and_fwd_flag, pickup_location_id, "
    "dropoff_location_id, payment_type, "
    + sql_time("pickup_datetime", "dropoff_datetime")
    + ", "
    + sql_round(*_MONEY)
)

ENTRIES["S5_prepare_raw"] = (
    lambda spark, sf_dir: plain(raw.prepare_raw(trips(spark, sf_dir), keep=("trip_id",))),
    sql(f"SELECT {_PLAIN_TRIP} FROM prepared", *BASE),
)

SAMPLE_KEY = ("trip_id", "pickup_location_id", "dropoff_location_id")
_SAMPLE_SQL = (
    "SELECT trip_id, pickup_location_id, dropoff_location_id FROM prepared "
    "ORDER BY md5(concat_ws('-', trip_id, pickup_location_id, dropoff_location_id, '42')), trip_id LIMIT {n}"
)

ENTRIES["S6_sample_n"] = (
    lambda spark, sf_dir: sample_n(prepared(spark, sf_dir).select(*SAMPLE_KEY), 5000, SAMPLE_KEY),
    sql(_SAMPLE_SQL.format(n=5000), *BASE),
)
ENTRIES["S6_sample_n_large"] = (
    lambda spark, sf_dir: sample_n(
        prepared(spark, sf_dir).select(*SAMPLE_KEY), 40000, SAMPLE_KEY, top_k_limit=1000
    ),
    sql(_SAMPLE_SQL.format(n=40000), *BASE),
)


def read_table(spark, sf_dir):
    prepared(spark, sf_dir).createOrReplaceTempView("raw_trips")
    return plain(
        tables.read_table(spark, "raw_trips").select("trip_id", "pickup_datetime", "fare_amount")
    )


ENTRIES["S7_read_table"] = (
    read_table,
    sql(
        "SELECT trip_id, "
        + sql_time("pickup_datetime")
        + ", "
        + sql_round("fare_amount")
        + " FROM prepared",
        *BASE,
    ),
)


def write_table(spark, sf_dir):
    """Replace, then append twice; fail must refuse the existing table."""
    name = f"meterline_{uuid.uuid4().hex}"
    path = scratch_path(spark, "table")
    rows = prepared(spark, sf_dir)
    for mode in ("replace", "append", "append"):
        tables.write_table(rows, name, mode, path=path)
    try:
        tables.write_table(rows, name, "fail", path=path)
        refused = False
    except Exception:
        refused = True
    return plain(
        tables.read_table(spark, name).agg(
            F.count("*").alias("total_rows"), F.sum("fare_amount").alias("fare_total")
        )
    ).withColumn("refused", F.lit(refused))


ENTRIES["S8_write_table"] = (
    write_table,
    sql(
        "SELECT count(*) * 3 AS total_rows, round(sum(fare_amount) * 3, 6) + 0.0 AS fare_total, true AS refused FROM prepared",
        *BASE,
    ),
)


def run_sql(spark, sf_dir):
    return plain(
        tables.run_sql(
            spark,
            "SELECT payment_type, count(*) AS trips, avg(fare_amount) AS avg_fare FROM {trips} "
            "WHERE trip_distance >= :miles AND store_and_fwd_flag = :flag GROUP BY payment_type",
            {"miles": 3.0, "flag": "N"},
            trips=prepared(spark, sf_dir),
        )
    )


ENTRIES["S9_run_sql"] = (
    run_sql,
    sql(
        "SELECT payment_type, count(*) AS trips, "
        + sql_round("avg(fare_amount) AS avg_fare")
        + " FROM prepared WHERE trip_distance >= 3.0 AND store_and_fwd_flag = 'N' GROUP BY 1",
        *BASE,
    ),
)


def table_info(spark, sf_dir):
    name = f"meterline_{uuid.uuid4().hex}"
    tables.write_table(prepared(spark, sf_dir), name, "fail", path=scratch_path(spark, "info"))
    info = tables.table_info(spark, name)
    return info.unionByName(tables.table_info(spark, name + "_absent"))


ENTRIES["S10_table_info"] = (table_info, None)

_NO_TEXT = ", CAST(NULL AS VARCHAR) AS text"
ENTRIES["S11_ingest_stats"] = (
    lambda spark, sf_dir: plain(raw.ingest_stats(unfilled(spark, sf_dir).drop("trip_id")), 9),
    sql(
        f"""SELECT '*' AS column_name, 'total_rows' AS stat, count(*)::DOUBLE AS value{_NO_TEXT} FROM unfilled
 UNION ALL SELECT '*', 'total_columns', {len(PREPARED_COLUMNS)}::DOUBLE, NULL
 UNION ALL SELECT '*', 'start', NULL, strftime(min(pickup_datetime), '%Y-%m-%d') FROM unfilled
 UNION ALL SELECT '*', 'end', NULL, strftime(max(pickup_datetime), '%Y-%m-%d') FROM unfilled
 UNION ALL SELECT column_name, 'null_count', null_count::DOUBLE, NULL FROM ({null_counts("unfilled", PREPARED_COLUMNS)})
 UNION ALL {describe("unfilled", PREPARED_NUMERIC, _NO_TEXT)}""",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

ENTRIES["S12_verify_load"] = (
    lambda spark, sf_dir: plain(raw.verify_load(prepared(spark, sf_dir))),
    sql(
        "SELECT count(*) AS row_count, "
        + sql_time("min(pickup_datetime) AS first_pickup", "max(pickup_datetime) AS last_pickup")
        + " FROM prepared",
        *BASE,
    ),
)

ENTRIES["S13_fingerprint"] = (lambda spark, sf_dir: raw.fingerprint(prepared(spark, sf_dir)), None)


def export(spark, sf_dir):
    """JSON out and in, CSV out and in."""
    json_path, csv_path = scratch_path(spark, "json"), scratch_path(spark, "csv")
    shares = payment_distribution(prepared(spark, sf_dir))
    files.write_json(shares, json_path)
    back = spark.read.schema(shares.schema).json(json_path)
    back.write.csv(csv_path, header=True)
    return plain(files.read_csv(spark, csv_path, shares.schema))


ENTRIES["S14_export_json_csv"] = (
    export,
    sql(
        "SELECT payment_type, count(*) AS trip_count, "
        + sql_round("avg(tip_amount) AS avg_tip", "avg(total_amount) AS avg_total")
        + " FROM prepared GROUP BY 1",
        *BASE,
    ),
)


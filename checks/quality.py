"""Validation and profiling."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from checks.fixture import (
    BASE,
    SQL_COPIES,
    SQL_TRIPS,
    SQL_UNFILLED,
    prepared,
    sql,
    sql_renamed,
    trips,
    unfilled,
    with_copies,
)
from checks.output import plain, sql_half_up, sql_round
from checks.pieces import PREPARED_COLUMNS, PREPARED_NUMERIC, describe, fences, null_counts, union
from meterline.operators import profile, validate
from meterline.plans.jobs import quality_job
from meterline.sources.raw import prepare_raw
from meterline.sources.staging import scratch_path
from meterline.sources.tables import write_table

ENTRIES: dict = {}


def checked(spark, sf_dir):
    """Trips with nulls and repeated rows, as validation meets them."""
    source = with_copies(trips(spark, sf_dir))
    return prepare_raw(source, fill_nulls=False, keep=PREPARED_COLUMNS[-4:])


def no_id(spark, sf_dir):
    return unfilled(spark, sf_dir).drop("trip_id")


CHECKED = (
    SQL_TRIPS,
    SQL_COPIES,
    sql_renamed("checked_id", "copies", False),
    "checked AS (SELECT * EXCLUDE (trip_id) FROM checked_id)",
)
UNFILLED = (SQL_TRIPS, SQL_UNFILLED)

_RESULT = "metric_name, passed, round(metric_value, 6) + 0.0 AS metric_value, threshold, critical"


def results(df):
    return plain(df.drop("message"))


_SCHEMA_SQL = "SELECT 'schema' AS metric_name, true AS passed, 1.0::DOUBLE AS metric_value, 1.0::DOUBLE AS threshold, true AS critical"
_NULL_SQL = (
    "SELECT 'null_' || column_name AS metric_name, null_count / total_rows <= 0.3 AS passed,"
    " null_count / total_rows AS metric_value, 0.3::DOUBLE AS threshold, false AS critical"
    f" FROM ({null_counts('checked', PREPARED_COLUMNS)}) WHERE null_count > 0"
)
_DUP_SQL = (
    "SELECT 'duplicates' AS metric_name, s <= 0.05 AS passed, s AS metric_value, 0.05::DOUBLE AS threshold,"
    " true AS critical FROM (SELECT ((SELECT count(*) FROM checked) - (SELECT count(*) FROM"
    " (SELECT DISTINCT * FROM checked))) / (SELECT count(*) FROM checked) AS s)"
)
_OUT_SQL = (
    "SELECT 'outliers_' || column_name AS metric_name, true AS passed, outlier_count / total_rows AS metric_value,"
    " 0.1::DOUBLE AS threshold, false AS critical"
    f" FROM ({fences('checked', PREPARED_NUMERIC)}) WHERE outlier_count > 0"
)
_ALL_SQL = union([_SCHEMA_SQL, _NULL_SQL, _DUP_SQL, _OUT_SQL])


def _result_sql(text: str) -> str:
    return sql(f"SELECT {_RESULT} FROM ({text})", *CHECKED)


def required(spark, sf_dir):
    """A sound table and one without three of the columns, with their rows counted."""
    good = checked(spark, sf_dir)
    bad = good.drop("fare_amount", "total_amount", "trip_distance")
    out = None
    for df in (good, bad):
        part = results(validate.required_columns(df)).withColumn("columns", F.lit(len(df.columns)))
        out = part if out is None else out.unionByName(part)
    return out


ENTRIES["V1_required_columns"] = (
    required,
    f"SELECT *, {len(PREPARED_COLUMNS)} AS columns FROM ({_SCHEMA_SQL}) UNION ALL"
    f" SELECT 'schema', false, 0.0, 1.0, true, {len(PREPARED_COLUMNS) - 3}",
)
ENTRIES["V2_null_check"] = (
    lambda spark, sf_dir: results(validate.null_check(checked(spark, sf_dir))),
    _result_sql(_NULL_SQL),
)
ENTRIES["V3_duplicate_check"] = (
    lambda spark, sf_dir: results(validate.duplicate_check(checked(spark, sf_dir))),
    _result_sql(_DUP_SQL),
)
ENTRIES["V4_outlier_check"] = (
    lambda spark, sf_dir: results(validate.outlier_check(checked(spark, sf_dir))),
    _result_sql(_OUT_SQL),
)
ENTRIES["V5_range_check"] = (
    lambda spark, sf_dir: validate.range_check(checked(spark, sf_dir)),
    sql(
        """SELECT * FROM (SELECT 'trip_distance' AS issue, count(*) FILTER (WHERE trip_distance <= 0) AS row_count FROM checked
 UNION ALL SELECT 'fare_amount', count(*) FILTER (WHERE fare_amount < 0) FROM checked
 UNION ALL SELECT 'passenger_count', count(*) FILTER (WHERE passenger_count <= 0) FROM checked
 UNION ALL SELECT 'datetime', count(*) FILTER (WHERE dropoff_datetime <= pickup_datetime) FROM checked) WHERE row_count > 0""",
        *CHECKED,
    ),
)
ENTRIES["V6_validate_all"] = (
    lambda spark, sf_dir: results(validate.validate_all(checked(spark, sf_dir))),
    _result_sql(_ALL_SQL),
)


def summary(spark, sf_dir):
    found = validate.validate_all(checked(spark, sf_dir))
    valid = validate.overall(found).scalar()
    return validate.validation_summary(found).withColumn("valid", valid)


ENTRIES["V7_validation_summary"] = (
    summary,
    sql(
        "SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,"
        " count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE critical AND NOT passed) = 0 AS valid"
        f" FROM ({_ALL_SQL})",
        *CHECKED,
    ),
)

ENTRIES["Q1_summary_stats"] = (
    lambda spark, sf_dir: plain(profile.summary_stats(no_id(spark, sf_dir)), 9),
    sql(
        f"""SELECT '*' AS column_name, 'total_rows' AS stat, count(*)::DOUBLE AS value FROM unfilled
 UNION ALL SELECT '*', 'total_columns', {len(PREPARED_COLUMNS)}::DOUBLE
 UNION ALL SELECT '*', 'days', floor(date_diff('second', min(pickup_datetime), max(pickup_datetime)) / 86400) FROM unfilled
 UNION ALL {describe("unfilled", PREPARED_NUMERIC)}""",
        *UNFILLED,
    ),
)
_NULL_PCT_SQL = (
    "SELECT column_name, null_count, "
    + sql_half_up("null_count * 100.0::DOUBLE / total_rows", 2)
    + f" AS null_percentage FROM ({null_counts('unfilled', PREPARED_COLUMNS)})"
)
ENTRIES["Q2_null_percent"] = (
    lambda spark, sf_dir: plain(profile.null_percent(no_id(spark, sf_dir))),
    sql(_NULL_PCT_SQL, *UNFILLED),
)
ENTRIES["Q2_null_totals"] = (
    lambda spark, sf_dir: profile.null_totals(profile.null_percent(no_id(spark, sf_dir))),
    sql(
        "SELECT CAST(sum(null_count) AS BIGINT) AS total_nulls, count(*) FILTER (WHERE null_count > 0) AS columns_with_nulls"
        f" FROM ({_NULL_PCT_SQL})",
        *UNFILLED,
    ),
)
_OUTLIER_SQL = (
    "SELECT column_name, outlier_count, "
    + sql_half_up("outlier_count * 100.0::DOUBLE / total_rows", 2)
    + " AS outlier_percentage, "
    + sql_round("lower_bound", "upper_bound")
    + f" FROM ({fences('unfilled', PREPARED_NUMERIC)})"
)
ENTRIES["Q3_outlier_table"] = (
    lambda spark, sf_dir: plain(profile.outlier_table(no_id(spark, sf_dir))),
    sql(_OUTLIER_SQL, *UNFILLED),
)
_NULLABLE = ("passenger_count", "trip_distance", "store_and_fwd_flag", "fare_amount")
ENTRIES["Q4_missing_pattern"] = (
    lambda spark, sf_dir: profile.missing_pattern(no_id(spark, sf_dir)),
    sql(
        "SELECT concat_ws(',', "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _NULLABLE)
        + ") AS missing_columns, count(*) AS row_count FROM unfilled GROUP BY 1",
        *UNFILLED,
    ),
)
_HISTOGRAM = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def histogram_sql(table: str, columns, bins: int = 50) -> str:
    return union(
        [
            f"""SELECT '{c}' AS column_name, CAST(least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin,
 round(lo + least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins - 1}) * ((hi - lo) / {bins}), 6) + 0.0 AS bin_start, count(*) AS row_count
 FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) WHERE {c} IS NOT NULL GROUP BY ALL"""
            for c in columns
        ]
    )


ENTRIES["Q5_histogram"] = (
    lambda spark, sf_dir: plain(profile.histogram(unfilled(spark, sf_dir), _HISTOGRAM)),
    sql(histogram_sql("unfilled", _HISTOGRAM), *UNFILLED),
)


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(PREPARED_NUMERIC):
        for b in PREPARED_NUMERIC[i + 1 :]:
            constant = "mta_tax" in (a, b)
            value = "CAST(NULL AS DOUBLE)" if constant else f"round(corr({a}, {b}), 6) + 0.0"
            parts.append(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, {value} AS correlation FROM unfilled"
                + (" LIMIT 1" if constant else "")
            )
    return union([f"({p})" for p in parts])


ENTRIES["Q6_correlation"] = (
    lambda spark, sf_dir: plain(profile.correlation(no_id(spark, sf_dir))),
    sql(_corr_sql(), *UNFILLED),
)
ENTRIES["Q7_daily_counts"] = (
    lambda spark, sf_dir: plain(
        profile.daily_counts(prepared(spark, sf_dir).filter("rate_code = 5"))
    ),
    sql(
        """SELECT strftime(d, '%Y-%m-%d') AS day, count(pickup_datetime) AS trips FROM
 (SELECT unnest(generate_series(min(pickup_datetime)::DATE, max(pickup_datetime)::DATE, INTERVAL 1 DAY)) AS d FROM rated)
 LEFT JOIN rated ON pickup_datetime::DATE = d::DATE GROUP BY 1""",
        *BASE,
        "rated AS (SELECT * FROM prepared WHERE rate_code = 5)",
    ),
)
_METRIC_SQL = f"""SELECT 'trips' AS table_name, 'null_pct_' || column_name AS metric_name, null_percentage AS metric_value,
 30.0::DOUBLE AS threshold_value, CASE WHEN null_percentage <= 30 THEN 'pass' ELSE 'fail' END AS status FROM ({_NULL_PCT_SQL})
 UNION ALL SELECT 'trips', 'outliers_' || column_name, outlier_percentage, 10.0, 'info' FROM ({_OUTLIER_SQL})"""
ENTRIES["Q8_quality_metrics"] = (
    lambda spark, sf_dir: plain(profile.quality_metrics(no_id(spark, sf_dir), "trips")),
    sql(_METRIC_SQL, *UNFILLED),
)


def report(spark, sf_dir):
    """The report job on a written table, with the stored metrics beside it."""
    mark = uuid.uuid4().hex
    write_table(no_id(spark, sf_dir), f"q_{mark}", "fail", path=scratch_path(spark, "q"))
    at = dt.datetime(2024, 1, 1)
    rows = quality_job(spark, f"q_{mark}", f"m_{mark}", at, path=scratch_path(spark, "m"))
    stored = spark.table(f"m_{mark}").select(
        F.lit("stored metric").alias("section"),
        F.col("metric_name").alias("name"),
        F.col("status").alias("value"),
    )
    return rows.unionByName(stored)


ENTRIES["Q9_quality_report"] = (report, None)


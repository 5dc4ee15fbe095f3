"""SQL views and dashboard aggregates."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from checks.cleaning import raw_copies
from checks.features import _STORED_CTE, STORED
from checks.fixture import BASE, SQL_CLEAN, SQL_TRIPS, SQL_UNFILLED, prepared, sql, table, unfilled, usable
from checks.output import plain, sql_half_up, sql_round, sql_time
from checks.pieces import describe, union
from checks.quality import histogram_sql
from meterline.operators import features, profile, trip, views
from meterline.operators.clean import clean_all
from meterline.operators.describe import describe_numeric
from meterline.sources.staging import scratch_path
from meterline.sources.tables import write_table

ENTRIES: dict = {}

SUMMARY_SQL = (
    "SELECT strftime(pickup_datetime, '%Y-%m-%d') AS trip_date, count(*) AS total_trips, "
    + sql_round(
        "avg(trip_distance) AS avg_distance",
        "avg(trip_duration_minutes) AS avg_duration",
        "avg(fare_amount) AS avg_fare",
        "avg(tip_amount) AS avg_tip",
        "sum(total_amount) AS total_revenue",
        digits=10,
    )
    + " FROM clean GROUP BY 1"
)
ENTRIES["A1_trip_summary"] = (
    lambda spark, sf_dir: plain(views.trip_summary(clean_all(raw_copies(spark, sf_dir)).trips), 10),
    sql(SUMMARY_SQL, *SQL_CLEAN),
)


def payments(spark, sf_dir):
    """Through the registered view."""
    views.register_views(clean_all(raw_copies(spark, sf_dir)).trips)
    return plain(spark.table("v_payment_distribution"))


ENTRIES["A2_payment_distribution"] = (
    payments,
    sql(
        "SELECT payment_type, count(*) AS trip_count, "
        + sql_round("avg(tip_amount) AS avg_tip", "avg(total_amount) AS avg_total")
        + " FROM clean GROUP BY 1",
        *SQL_CLEAN,
    ),
)
ENTRIES["A3_trip_stats"] = (
    lambda spark, sf_dir: plain(views.trip_stats(prepared(spark, sf_dir))),
    sql(
        "SELECT count(*) AS total_trips, "
        + sql_round(
            "avg(trip_distance) AS avg_distance",
            "avg(fare_amount) AS avg_fare",
            "min(fare_amount) AS min_fare",
            "max(fare_amount) AS max_fare",
        )
        + " FROM prepared",
        *BASE,
    ),
)
ENTRIES["A4_payment_share"] = (
    lambda spark, sf_dir: plain(views.payment_share(prepared(spark, sf_dir))),
    sql(
        "SELECT payment_type, count(*) AS trip_count, "
        + sql_half_up("count(*) * 100.0::DOUBLE / (SELECT count(*) FROM prepared)", 2)
        + " AS percentage FROM prepared GROUP BY 1 ORDER BY 2 DESC, 1",
        *BASE,
    ),
)


def table_counts(spark, sf_dir):
    mark = uuid.uuid4().hex
    names = {k: f"{k}_{mark}" for k in ("raw_trips", "processed_trips", "feature_store", "absent")}
    write_table(prepared(spark, sf_dir), names["raw_trips"], "fail", path=scratch_path(spark, "c"))
    write_table(usable(spark, sf_dir), names["processed_trips"], "fail", path=scratch_path(spark, "c"))
    store = features.to_feature_store(usable(spark, sf_dir), "trip_id", "v1", ["fare_amount"])
    write_table(store, names["feature_store"], "fail", path=scratch_path(spark, "c"))
    counts = views.table_counts(spark, list(names.values()))
    return counts.withColumn("table_name", F.regexp_replace("table_name", "_[0-9a-f]{32}$", ""))


ENTRIES["A5_table_counts"] = (
    table_counts,
    sql(
        "SELECT 'raw_trips' AS table_name, count(*) AS row_count FROM prepared"
        " UNION ALL SELECT 'processed_trips', count(*) FROM stored"
        " UNION ALL SELECT 'feature_store', count(*) FROM stored UNION ALL SELECT 'absent', 0",
        *_STORED_CTE,
    ),
)


def store_stats(spark, sf_dir):
    store = features.to_feature_store(
        trip.trip_features(usable(spark, sf_dir)), "trip_id", "v1", STORED
    ).join(
        usable(spark, sf_dir).groupBy("trip_id").agg(F.min("pickup_datetime").alias("created_at")),
        "trip_id",
    )
    return plain(views.feature_store_stats(store))


ENTRIES["A6_feature_store_stats"] = (
    store_stats,
    sql(
        f"SELECT count(*) * {len(STORED)} AS total_features, "
        + sql_time("min(pickup_datetime) AS oldest_record", "max(pickup_datetime) AS newest_record")
        + " FROM usable",
        *_STORED_CTE,
    ),
)
AS_OF = dt.datetime(2000, 1, 1)
ENTRIES["A7_recent_rows"] = (
    lambda spark, sf_dir: plain(
        views.recent_rows(
            table(spark, sf_dir, "orders"), "o_orderdate", AS_OF, 365, 500, tie=("o_orderkey",)
        )
    ),
    "SELECT o_orderkey, o_custkey, o_orderstatus, "
    + sql_round("o_totalprice")
    + ", "
    + sql_time("o_orderdate")
    + ", o_orderpriority FROM (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 365 DAY"
    " ORDER BY o_orderdate DESC, o_orderkey LIMIT 500)",
)


def explorer(spark, sf_dir):
    """Histogram, box plot and description of one feature, as (part, name, value)."""
    df = unfilled(spark, sf_dir)
    bars = profile.histogram(df, ["fare_amount"]).select(
        F.lit("histogram").alias("part"),
        F.col("bin").cast("string").alias("name"),
        F.col("row_count").cast("double").alias("value"),
    )
    box = profile.box_plot(df, "fare_amount")
    box = box.select(*[F.col(c).cast("double").alias(c) for c in box.columns])
    box = box.unpivot([F.lit("box").alias("part")], box.columns, "name", "value")
    numbers = describe_numeric(df, ["fare_amount"]).select(
        F.lit("describe").alias("part"), F.col("stat").alias("name"), "value"
    )
    return plain(bars.unionByName(box).unionByName(numbers), 9)


ENTRIES["A8_feature_explorer"] = (
    explorer,
    sql(
        union(
            [
                f"SELECT 'histogram' AS part, CAST(bin AS VARCHAR) AS name, row_count::DOUBLE AS value FROM ({histogram_sql('unfilled', ['fare_amount'])})",
                f"SELECT 'describe', stat, value FROM ({describe('unfilled', ['fare_amount'])})",
                """SELECT 'box', unnest(['whisker_low','q1','median','q3','whisker_high','outlier_count']),
 round(unnest([min(x) FILTER (WHERE x BETWEEN a AND b), min(q1), min(q2), min(q3), max(x) FILTER (WHERE x BETWEEN a AND b),
 (count(*) FILTER (WHERE x < a OR x > b))::DOUBLE]), 6) + 0.0 FROM (SELECT fare_amount AS x, q1, q2, q3, q1 - 1.5 * (q3 - q1) AS a, q3 + 1.5 * (q3 - q1) AS b
 FROM unfilled, (SELECT quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.5) AS q2, quantile_cont(fare_amount, 0.75) AS q3 FROM unfilled))""",
            ]
        ),
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)

"""SQL texts that several sections use."""

from __future__ import annotations

from collections.abc import Sequence

RAW_NUMERIC = (
    "vendor_id passenger_count trip_distance rate_code pickup_location_id dropoff_location_id "
    "payment_type fare_amount extra mta_tax tip_amount tolls_amount total_amount"
).split()
COORDINATE_NUMERIC = "pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude".split()
PREPARED_NUMERIC = [*RAW_NUMERIC, *COORDINATE_NUMERIC]
PREPARED_COLUMNS = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "rate_code",
    "store_and_fwd_flag",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    *COORDINATE_NUMERIC,
]


def union(parts: Sequence[str]) -> str:
    return " UNION ALL ".join(parts)


def describe(table: str, columns: Sequence[str], extra: str = "") -> str:
    return union(
        [
            f"""SELECT '{c}' AS column_name,
 unnest(['count','mean','std','min','25%','50%','75%','max']) AS stat,
 round(unnest([count({c})::DOUBLE, avg({c}::DOUBLE), stddev_samp({c}::DOUBLE), min({c})::DOUBLE,
  quantile_cont({c}::DOUBLE, 0.25), quantile_cont({c}::DOUBLE, 0.5), quantile_cont({c}::DOUBLE, 0.75),
  max({c})::DOUBLE]), 9) + 0.0 AS value{extra} FROM {table}"""
            for c in columns
        ]
    )


def null_counts(table: str, columns: Sequence[str]) -> str:
    return union(
        [
            f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count FROM {table}"
            for c in columns
        ]
    )


def fences(table: str, columns: Sequence[str], factor: float = 1.5) -> str:
    """(column_name, total_rows, outlier_count, lower_bound, upper_bound)."""
    parts = []
    for c in columns:
        v = f"{c}::DOUBLE"
        parts.append(
            f"""SELECT '{c}' AS column_name, count(*) AS total_rows,
 count(*) FILTER (WHERE {v} < lo OR {v} > hi) AS outlier_count, min(lo) AS lower_bound, min(hi) AS upper_bound
 FROM {table}, (SELECT q1 - {factor} * (q3 - q1) AS lo, q3 + {factor} * (q3 - q1) AS hi FROM
  (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {table}))"""
        )
    return union(parts)

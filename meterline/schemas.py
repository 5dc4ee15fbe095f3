"""Declared schemas and the column groups the operators refer to."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BOOL, NTZ = T.StringType(), T.BooleanType(), T.TimestampNTZType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# The source file layout, as published by the data provider.
SOURCE_TRIPS = struct(
    ("VendorID", INT),
    ("tpep_pickup_datetime", NTZ),
    ("tpep_dropoff_datetime", NTZ),
    ("passenger_count", DOUBLE),
    ("trip_distance", DOUBLE),
    ("RatecodeID", DOUBLE),
    ("store_and_fwd_flag", STRING),
    ("PULocationID", INT),
    ("DOLocationID", INT),
    ("payment_type", INT),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE),
    ("airport_fee", DOUBLE),
)

ESSENTIAL_SOURCE = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
)

# Source column -> table column; the other source columns are not loaded.
RAW_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "total_amount": "total_amount",
}

COORDINATES = (
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
)

REQUIRED_TRIP = (
    "pickup_datetime",
    "dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
CRITICAL_TRIP = ("pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount")
DATETIME_TRIP = ("pickup_datetime", "dropoff_datetime")
INTEGER_TRIP = ("vendor_id", "passenger_count", "payment_type")
FLOAT_TRIP = (
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)
CAPPED_TRIP = ("trip_distance", "fare_amount", "tip_amount", "total_amount")

RUNS = T.StructType(
    [
        T.StructField("experiment_name", STRING),
        T.StructField("run_id", STRING),
        T.StructField("run_name", STRING),
        T.StructField("model_type", STRING),
        T.StructField("model_path", STRING),
        T.StructField("status", STRING),
        T.StructField("start_time", NTZ),
        T.StructField("end_time", NTZ),
        T.StructField("metrics", T.MapType(STRING, DOUBLE)),
        T.StructField("params", T.MapType(STRING, STRING)),
        T.StructField("tags", T.MapType(STRING, STRING)),
    ]
)


def numeric_columns(df, exclude=()) -> list[str]:
    """Numeric columns in schema order; booleans and timestamps are not numeric."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df, columns) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]

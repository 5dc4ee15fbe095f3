"""From the source file layout to the raw trip table, with load statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schemas
from meterline.operators.describe import describe_numeric, null_counts

CHECK = schemas.struct(
    ("check_name", schemas.STRING), ("column_name", schemas.STRING), ("passed", schemas.BOOL)
)


def source_schema_check(df: DataFrame) -> DataFrame:
    """One row per missing, extra or missing essential column and one verdict row."""
    declared, have = schemas.SOURCE_TRIPS.names, df.columns
    essential = [c for c in schemas.ESSENTIAL_SOURCE if c not in have]
    rows = [("missing", c, True) for c in declared if c not in have]
    rows += [("extra", c, True) for c in have if c not in declared]
    rows += [("essential", c, False) for c in essential]
    rows.append(("schema", None, not essential))
    return df.sparkSession.createDataFrame(rows, CHECK)


def as_datetime(df: DataFrame, name: str):
    """The column as a zone-free timestamp, null where the text is not a date."""
    if isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType)):
        return F.col(name)
    return F.expr(f"try_cast(`{name}` as timestamp_ntz)")


def prepare_raw(df: DataFrame, fill_nulls: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Select and rename the loaded columns, coerce the dates and fill numeric nulls with 0.

    ``keep`` passes further columns (a key, coordinates) through unchanged.
    """
    columns = []
    for source, name in schemas.RAW_NAMES.items():
        if source not in df.columns:
            continue
        value = F.col(source)
        if name in schemas.DATETIME_TRIP:
            value = as_datetime(df, source)
        elif fill_nulls and isinstance(df.schema[source].dataType, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(df.schema[source].dataType))
        columns.append(value.alias(name))
    return df.select(*columns, *schemas.present(df, keep))


def ingest_stats(df: DataFrame) -> DataFrame:
    """(column_name, stat, value, text): shape, pickup range, null counts, description.

    Numbers are in ``value``, the two dates in ``text``.
    """
    names = ["total_rows", "total_columns", "start", "end"]
    row = df.agg(
        F.count("*").cast("double").alias("total_rows"),
        F.date_format(F.min("pickup_datetime"), "yyyy-MM-dd").alias("start"),
        F.date_format(F.max("pickup_datetime"), "yyyy-MM-dd").alias("end"),
    ).withColumn("total_columns", F.lit(float(len(df.columns))))
    shape = row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("*").alias("column_name"),
                        F.lit(n).alias("stat"),
                        (F.col(n) if n.startswith("total") else F.lit(None).cast("double")).alias(
                            "value"
                        ),
                        (F.lit(None).cast("string") if n.startswith("total") else F.col(n)).alias(
                            "text"
                        ),
                    )
                    for n in names
                ]
            )
        )
    )
    no_text = F.lit(None).cast("string").alias("text")
    nulls = null_counts(df).select(
        "column_name",
        F.lit("null_count").alias("stat"),
        F.col("null_count").cast("double").alias("value"),
        no_text,
    )
    numbers = describe_numeric(df).select("column_name", "stat", "value", no_text)
    return shape.unionByName(nulls).unionByName(numbers)


def verify_load(df: DataFrame) -> DataFrame:
    """Row count and pickup range of a loaded table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("pickup_datetime").alias("last_pickup"),
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count, xor and sum of the row hashes: equal tables agree in any row order."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(
        F.count("*").alias("total_rows"),
        F.coalesce(F.bit_xor(row_hash), F.lit(0).cast("bigint")).alias("hash_xor"),
        F.sum(row_hash.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )

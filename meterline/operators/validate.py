"""Validation checks: they report, they never change data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.columns import number_literal, quoted, rows_from, text_literal
from meterline.operators.describe import null_counts
from meterline.operators.quantiles import iqr_fences

# Default thresholds as fractions of the rows.
NULL_LIMIT, DUPLICATE_LIMIT, OUTLIER_INFO = 0.3, 0.05, 0.1

RESULT = schemas.struct(
    ("metric_name", schemas.STRING),
    ("passed", schemas.BOOL),
    ("metric_value", schemas.DOUBLE),
    ("threshold", schemas.DOUBLE),
    ("message", schemas.STRING),
    ("critical", schemas.BOOL),
)


def required_columns(df: DataFrame, required: Sequence[str] = schemas.REQUIRED_TRIP) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    message = "Missing columns: " + ", ".join(missing) if missing else "All required columns present"
    row = ("schema", not missing, 0.0 if missing else 1.0, 1.0, message, True)
    return df.sparkSession.createDataFrame([row], RESULT)


def _percent(fraction):
    return F.format_string("%.2f%%", F.coalesce(fraction, F.lit(0.0)) * 100)


def _as_result(rows: DataFrame, name, passed, value, limit: float, message, critical: bool):
    return rows.select(
        name.alias("metric_name"),
        passed.alias("passed"),
        value.alias("metric_value"),
        F.lit(float(limit)).alias("threshold"),
        message.alias("message"),
        F.lit(critical).alias("critical"),
    )


def null_check(df: DataFrame, limit: float = NULL_LIMIT) -> DataFrame:
    """A row per column that has nulls, with the null fraction."""
    counts = null_counts(df).filter(F.col("null_count") > 0)
    share = F.col("null_count") / F.col("total_rows")
    return _as_result(
        counts,
        F.concat(F.lit("null_"), F.col("column_name")),
        share <= limit,
        share,
        limit,
        F.concat(F.col("column_name"), F.lit(": "), _percent(share), F.lit(" null values")),
        False,
    )


def duplicate_check(df: DataFrame, limit: float = DUPLICATE_LIMIT) -> DataFrame:
    """Rows beyond the first of each identical row, as a fraction of all rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    totals = copies.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
    )
    share = F.coalesce(F.try_divide(F.col("extra"), F.col("total")), F.lit(0.0))
    message = F.concat(
        F.format_string("%d", "extra"), F.lit(" duplicates ("), _percent(share), F.lit(")")
    )
    return _as_result(totals, F.lit("duplicates"), share <= limit, share, limit, message, True)


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5, approx: bool = False
) -> DataFrame:
    """(column_name, total_rows, outlier_count, lower_bound, upper_bound) per numeric column."""
    columns = schemas.present(df, columns) if columns is not None else schemas.numeric_columns(df)
    return count_outside(df, iqr_fences(df, columns, factor, approx))


def count_outside(df: DataFrame, fences: dict[str, tuple[float, float] | None]) -> DataFrame:
    counts, entries = ["count(*) AS n"], []
    for i, (c, found) in enumerate(fences.items()):
        low, high = found or (None, None)
        entry = {"column_name": text_literal(c), "total_rows": "n", "outlier_count": "CAST(0 AS BIGINT)"}
        entry |= {"lower_bound": number_literal(low), "upper_bound": number_literal(high)}
        if found:
            value = f"CAST({quoted(c)} AS DOUBLE)"
            counts.append(
                f"count_if({value} < {number_literal(low)} OR {value} > {number_literal(high)}) AS o{i}"
            )
            entry["outlier_count"] = f"o{i}"
        entries.append(entry)
    return rows_from(df.agg(*[F.expr(t) for t in counts]), entries)


def outlier_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row per column with values outside the fences; informational, always passed."""
    found = outlier_counts(df, columns).filter(F.col("outlier_count") > 0)
    share = F.col("outlier_count") / F.col("total_rows")
    message = F.concat(
        F.col("column_name"),
        F.lit(": "),
        F.format_string("%d", "outlier_count"),
        F.lit(" outliers ("),
        _percent(share),
        F.lit(")"),
    )
    return _as_result(
        found,
        F.concat(F.lit("outliers_"), F.col("column_name")),
        F.lit(True),
        share,
        OUTLIER_INFO,
        message,
        False,
    )


def range_check(df: DataFrame) -> DataFrame:
    """(issue, row_count) of the value rules that some rows break."""
    rules = [
        ("trip_distance", ("trip_distance",), "trip_distance <= 0"),
        ("fare_amount", ("fare_amount",), "fare_amount < 0"),
        ("passenger_count", ("passenger_count",), "passenger_count <= 0"),
        ("datetime", schemas.DATETIME_TRIP, "dropoff_datetime <= pickup_datetime"),
    ]
    usable = [(n, e) for n, cols, e in rules if all(c in df.columns for c in cols)]
    if not usable:
        return df.sparkSession.createDataFrame(
            [], schemas.struct(("issue", schemas.STRING), ("row_count", schemas.LONG))
        )
    row = df.agg(*[F.count_if(F.expr(e)).alias(n) for n, e in usable])
    return row.unpivot([], [n for n, _ in usable], "issue", "row_count").filter("row_count > 0")


def validate_all(df: DataFrame) -> DataFrame:
    """All checks as result rows; a failed schema check stops the rest.

    Range issues never decide pass or fail, so they are reported by ``range_check`` alone.
    """
    schema = required_columns(df)
    if any(c not in df.columns for c in schemas.REQUIRED_TRIP):
        return schema
    return (
        schema.unionByName(null_check(df)).unionByName(duplicate_check(df)).unionByName(outlier_check(df))
    )


def overall(results: DataFrame) -> DataFrame:
    """One row: the table passes unless a critical check failed."""
    return results.agg(
        (F.count_if(F.col("critical") & ~F.col("passed")) == 0).alias("valid")
    )


def validation_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )

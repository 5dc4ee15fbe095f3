"""Feature dictionary and the narrow feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schemas
from meterline.functions.columns import quoted, rows_from, text_literal
from meterline.sources.staging import release_shuffles, stage

TOP_VALUES = 5
#: Columns whose distinct values are counted in one pass of a job.
COLUMNS_AT_ONCE = 8
STATISTICS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


VALUES = "column_name string, whole bigint, number double, text string, n bigint"


def _cell(place: int, name: str, kind: T.DataType) -> str:
    """The value in the one of three typed fields that holds its kind exactly, as SQL text."""
    c, field = quoted(name), "text"
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        field, value = "whole", f"CAST({c} AS BIGINT)"
    elif isinstance(kind, T.DateType):
        field, value = "whole", f"CAST(unix_date({c}) AS BIGINT)"
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        field, value = "number", f"CAST({c} AS DOUBLE)"
    else:  # times, decimals and binary values have exact texts of their own
        value = f"CAST({c} AS STRING)"
    empty = {"whole": "BIGINT", "number": "DOUBLE", "text": "STRING"}
    parts = [f"'{f}', {value if f == field else f'CAST(NULL AS {t})'}" for f, t in empty.items()]
    return f"named_struct('place', {place}, {', '.join(parts)})"


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each value stands in each column: one scan and one shuffle for all columns.

    A value is in ``whole``, ``number`` or ``text`` by its kind; rows collapse per value before the shuffle.
    Nulls are left out. Stage the result where several summaries follow.
    """
    wanted = set(df.columns if columns is None else columns)
    fields = [f for f in df.schema.fields if f.name in wanted]
    if not fields:
        return df.sparkSession.createDataFrame([], VALUES)
    # a number for the column keeps the grouping key short
    cells = [_cell(i, f.name, f.dataType) for i, f in enumerate(fields)]
    long = df.select(F.expr(f"inline(array({', '.join(cells)}))"))
    known = long.where("whole IS NOT NULL OR number IS NOT NULL OR text IS NOT NULL")
    counts = known.groupBy("place", "whole", "number", "text").agg(F.count("*").alias("n"))
    names = f"array({', '.join(text_literal(f.name) for f in fields)})"
    return counts.select(F.expr(f"{names}[place]").alias("column_name"), "whole", "number", "text", "n")


def top_values(df: DataFrame, n: int = TOP_VALUES, counts: DataFrame | None = None) -> DataFrame:
    """Most frequent values of every string column, by count and then by value.

    ``counts`` are value counts of the table, if there are any yet. The filter on ``row_number`` is applied
    inside each task before the shuffle.
    """
    columns = schemas.string_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, value string, n bigint, value_rank int"
        )
    counts = value_counts(df, columns) if counts is None else counts
    texts = counts.where(F.col("column_name").isin(*columns)).select(
        "column_name", F.col("text").alias("value"), "n"
    )
    by = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    ranked = texts.withColumn("value_rank", F.row_number().over(by))
    return ranked.filter(F.col("value_rank") <= n)


def distinct_values(
    df: DataFrame, approx: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """(column_name, unique_values), nulls not counted."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return row.unpivot([], df.columns, "column_name", "unique_values")
    counts = value_counts(df) if counts is None else counts
    return counts.groupBy("column_name").agg(F.count("*").alias("unique_values"))


def distinct_in_turns(df: DataFrame, columns: Sequence[str], most: int = COLUMNS_AT_ONCE) -> DataFrame:
    """``distinct_values`` of the columns, exact, ``most`` of them at a time.

    Values of a few columns only lie on the executors' disks at once, and none is written.
    """
    unique = df.sparkSession.createDataFrame([], "column_name string, unique_values bigint")
    for at in range(0, len(columns), most):
        counts = value_counts(df, columns[at : at + most])
        unique = unique.unionByName(stage(distinct_values(df, counts=counts), "unique"))
        del counts
        release_shuffles(df.sparkSession)
    return unique


def feature_dictionary(
    df: DataFrame, approx: bool = False, counts: DataFrame | None = None, unique: DataFrame | None = None
) -> DataFrame:
    """One row per column: type, nulls, distinct values and, if numeric, four statistics.

    ``unique`` are the ``distinct_values``, if they are known.
    """
    numeric = set(schemas.numeric_columns(df))
    aggregates, entries = ["count(*) AS n"], []
    for i, (c, dtype) in enumerate(df.dtypes):
        aggregates.append(f"count_if({quoted(c)} IS NULL) AS z{i}")
        entry = {
            "position": str(i),
            "column_name": text_literal(c),
            "data_type": text_literal(dtype),
            "null_count": f"z{i}",
            "null_percentage": f"floor(try_divide(z{i} * 100D, n) * 100D + 0.5D) / 100D",
        }
        for name, function in STATISTICS.items():
            entry[name] = "CAST(NULL AS DOUBLE)"
            if c in numeric:
                aggregates.append(f"{function}(CAST({quoted(c)} AS DOUBLE)) AS {name}{i}")
                entry[name] = f"floor({name}{i} * 10000D + 0.5D) / 10000D"
        entries.append(entry)
    facts = rows_from(df.agg(*[F.expr(t) for t in aggregates]), entries)
    unique = distinct_values(df, approx, counts) if unique is None else unique
    # both sides have one row per column of the table
    return facts.join(F.broadcast(unique), "column_name", "left").withColumn(
        "unique_values", F.coalesce("unique_values", F.lit(0).cast("bigint"))
    )


def to_feature_store(
    df: DataFrame, id_column: str, version: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """(trip_id, feature_name, feature_value, feature_version): one row per trip and feature."""
    columns = list(columns) if columns is not None else schemas.numeric_columns(df, (id_column,))
    wide = df.select(
        F.col(id_column).alias("trip_id"), *[F.col(c).cast("double").alias(c) for c in columns]
    )
    return wide.unpivot("trip_id", columns, "feature_name", "feature_value").withColumn(
        "feature_version", F.lit(version)
    )


def from_feature_store(store: DataFrame, version: str, names: Sequence[str]) -> DataFrame:
    """Back to one row per trip; the fixed name list keeps the pivot to a single pass.

    Where a trip has several values of a feature, the largest is taken.
    """
    return (
        store.filter((F.col("feature_version") == version) & F.col("feature_name").isin(*names))
        .groupBy("trip_id")
        .pivot("feature_name", list(names))
        .agg(F.max("feature_value"))
    )

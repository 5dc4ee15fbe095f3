"""One-pass column profiles in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.columns import number_literal, quoted, rows_from, text_literal
from meterline.operators.quantiles import quantiles

QUARTILES = ("25%", "50%", "75%")
STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, total_rows, null_count) for every column, from one pass."""
    counts = [f"count_if({quoted(c)} IS NULL) AS z{i}" for i, c in enumerate(df.columns)]
    row = df.agg(F.expr("count(*) AS n"), *[F.expr(t) for t in counts])
    return rows_from(
        row,
        [
            {"column_name": text_literal(c), "total_rows": "n", "null_count": f"z{i}"}
            for i, c in enumerate(df.columns)
        ],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, stat, value) with count, mean, std, min, quartiles and max."""
    columns = list(columns) if columns is not None else schemas.numeric_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, stat string, value double")
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75))
    functions = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    row = df.agg(
        *[
            F.expr(f"CAST({f}(CAST({quoted(c)} AS DOUBLE)) AS DOUBLE) AS `{i}:{s}`")
            for i, c in enumerate(columns)
            for s, f in functions.items()
        ]
    )
    return rows_from(
        row,
        [
            {
                "column_name": text_literal(c),
                "stat": text_literal(s),
                "value": f"`{i}:{s}`"
                if s in functions
                else number_literal(quartiles[c][QUARTILES.index(s)]),
            }
            for i, c in enumerate(columns)
            for s in STATS
        ],
    )

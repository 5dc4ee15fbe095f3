"""Alternatives to the default cleaning: z-score limits, flags, mean fill, removal, other scales.

Every limit, mean and scale is found in one pass (quantiles by rank selection) and enters the plan as a
literal. A row outside a limit is removed or counted by the same test; null is never outside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.columns import number_literal, quoted, rows_from
from meterline.operators.quantiles import iqr_fences, quantiles

# Fixed value: standard deviations beyond which a value is an outlier.
Z_LIMIT = 3.0

Bounds = dict[str, tuple[float, float]]


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return schemas.numeric_columns(df) if columns is None else schemas.present(df, columns)


def _value(c: str) -> str:
    return f"nanvl(CAST({quoted(c)} AS DOUBLE), NULL)"


def zscore_bounds(
    df: DataFrame, columns: Sequence[str] | None = None, limit: float = Z_LIMIT
) -> Bounds:
    """Mean minus and plus ``limit`` population deviations; columns without a value have no bounds."""
    columns = _numeric(df, columns)
    if not columns:
        return {}
    row = df.agg(
        *[F.expr(f"avg({_value(c)})").alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.expr(f"stddev_pop({_value(c)})").alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: (row[f"m{i}"] - limit * row[f"s{i}"], row[f"m{i}"] + limit * row[f"s{i}"])
        for i, c in enumerate(columns)
        if row[f"m{i}"] is not None
    }


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    limit: float | None = None,
) -> Bounds:
    """Bounds by quartile fences (``limit`` 1.5) or z-scores (``limit`` 3)."""
    if method == "zscore":
        return zscore_bounds(df, columns, Z_LIMIT if limit is None else limit)
    if method != "iqr":
        raise ValueError(f"unknown method {method!r}: use 'iqr' or 'zscore'")
    fences = iqr_fences(df, _numeric(df, columns), 1.5 if limit is None else limit)
    return {c: b for c, b in fences.items() if b is not None}


def _outside(c: str, bounds: Bounds) -> str:
    low, high = map(number_literal, bounds[c])
    return f"({_value(c)} < {low} OR {_value(c)} > {high})"


def count_outside(df: DataFrame, bounds: Bounds) -> DataFrame:
    """(column_name, total_rows, outlier_count, lower_bound, upper_bound), a row per column."""
    columns = list(bounds)
    if not columns:
        return df.sparkSession.createDataFrame(
            [],
            "column_name string, total_rows long, outlier_count long, lower_bound double,"
            " upper_bound double",
        )
    row = df.agg(
        F.count("*").alias("n"),
        *[F.expr(f"count_if({_outside(c, bounds)})").alias(f"o{i}") for i, c in enumerate(columns)],
    )
    return rows_from(
        row,
        [
            {
                "column_name": "'" + c.replace("'", "\\'") + "'",
                "total_rows": "n",
                "outlier_count": f"o{i}",
                "lower_bound": number_literal(bounds[c][0]),
                "upper_bound": number_literal(bounds[c][1]),
            }
            for i, c in enumerate(columns)
        ],
    )


def zscore_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, limit: float = Z_LIMIT
) -> DataFrame:
    return count_outside(df, zscore_bounds(df, columns, limit))


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    limit: float | None = None,
) -> DataFrame:
    """Rows with no value outside the bounds; bounds come from all rows, before any goes."""
    bounds = outlier_bounds(df, columns, method, limit)
    tests = [f"NOT coalesce({_outside(c, bounds)}, false)" for c in bounds]
    return df.where(" AND ".join(tests)) if tests else df


def flag_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``<column>_missing`` for every column (or those given); NaN counts as missing."""
    names = df.columns if columns is None else schemas.present(df, columns)
    floating = {n for n, kind in df.dtypes if kind in ("double", "float")}
    flags = {
        f"{c}_missing": F.expr(
            f"{quoted(c)} IS NULL" + (f" OR isnan({quoted(c)})" if c in floating else "")
        )
        for c in names
    }
    return df.withColumns(flags) if flags else df


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers become the column's mean, as doubles; a column of nulls stays null."""
    columns = _numeric(df, columns)
    if not columns:
        return df
    row = df.agg(*[F.expr(f"avg({_value(c)})").alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns(
        {
            c: F.expr(f"coalesce({_value(c)}, {number_literal(row[f'm{i}'])})")
            for i, c in enumerate(columns)
        }
    )


Scales = dict[str, tuple[float, float]]


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scales:
    """Least value and width of the range; a constant column has width 1."""
    if not columns:
        return {}
    row = df.agg(
        *[F.expr(f"min({_value(c)})").alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.expr(f"max({_value(c)})").alias(f"h{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: (row[f"l{i}"], (row[f"h{i}"] - row[f"l{i}"]) or 1.0)
        for i, c in enumerate(columns)
        if row[f"l{i}"] is not None
    }


def fit_robust(df: DataFrame, columns: Sequence[str]) -> Scales:
    """Median and width between the quartiles; a width of 0 becomes 1."""
    found = quantiles(df, list(columns), (0.25, 0.5, 0.75))
    return {c: (q[1], (q[2] - q[0]) or 1.0) for c, q in found.items() if q[1] is not None}


def apply_scales(df: DataFrame, scales: Scales) -> DataFrame:
    """(x - centre) / width as doubles; null stays null."""
    if not scales:
        return df
    return df.withColumns(
        {
            c: F.expr(f"({_value(c)} - {number_literal(m)}) / {number_literal(w)}")
            for c, (m, w) in scales.items()
        }
    )

"""Quality profile: statistics, nulls, outliers, histograms, correlations, daily counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.columns import half_up, number_literal, rows_from, text_literal
from meterline.operators.describe import describe_numeric, null_counts
from meterline.operators.quantiles import quantiles
from meterline.operators.validate import outlier_counts

# Limits in percent that the stored quality metrics are judged by.
NULL_PERCENT_LIMIT, OUTLIER_PERCENT_INFO = 30.0, 10.0
HISTOGRAM_BINS = 50


def summary_stats(df: DataFrame) -> DataFrame:
    """(column_name, stat, value): shape, days covered and the numeric description."""
    shape = [F.count("*").cast("double").alias("total_rows")]
    stats = ["total_rows", "total_columns"]
    if "pickup_datetime" in df.columns:
        span = F.max("pickup_datetime") - F.min("pickup_datetime")
        # whole elapsed days
        shape.append(F.date_part(F.lit("DAY"), span).cast("double").alias("days"))
        stats.append("days")
    row = df.agg(*shape).withColumn("total_columns", F.lit(float(len(df.columns))))
    head = row.unpivot([F.lit("*").alias("column_name")], stats, "stat", "value")
    return head.unionByName(describe_numeric(df))


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def null_percent(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_percentage) for every column."""
    share = F.try_divide(F.col("null_count") * 100.0, F.col("total_rows"))
    return null_counts(df).select(
        "column_name", "null_count", half_up(share, 2).alias("null_percentage")
    )


def null_totals(nulls: DataFrame) -> DataFrame:
    return nulls.agg(
        F.sum("null_count").alias("total_nulls"),
        F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
    )


def outlier_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    share = F.coalesce(F.try_divide(F.col("outlier_count") * 100.0, F.col("total_rows")), F.lit(0.0))
    return outlier_counts(df, columns).select(
        "column_name",
        "outlier_count",
        half_up(share, 2).alias("outlier_percentage"),
        "lower_bound",
        "upper_bound",
    )


def missing_pattern(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Which columns are missing together, and in how many rows.

    The pattern is one text of 0/1 flags, so rows collapse before the shuffle.
    """
    columns = list(columns) if columns is not None else df.columns
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    pattern = F.array_join(names, ",")
    return (
        df.select(pattern.alias("missing_columns"))
        .groupBy("missing_columns")
        .agg(F.count("*").alias("row_count"))
    )


def bin_index(col: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin of a value; the maximum belongs to the last bin."""
    if high == low:
        return F.when(col.isNotNull(), F.lit(bins // 2))
    at = F.floor((col - F.lit(low)) / F.lit((high - low) / bins)).cast("int")
    # least alone would turn null into the last bin
    return F.when(col.isNotNull(), F.least(at, F.lit(bins - 1)))


def _finite(name: str):
    return F.when(F.abs(F.col(name)) < float("inf"), F.col(name))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(column_name, bin, bin_start, row_count) of the non-empty equal-width bins.

    The bins span the finite values; infinities are counted apart in the bins -1 and ``bins``.
    """
    columns = schemas.present(df, columns)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    limits = values.agg(
        *[f(_finite(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("l", F.min), ("h", F.max))]
    ).first()
    found = [(i, c) for i, c in enumerate(columns) if limits[f"l{i}"] is not None]
    if not found:
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, bin_start double, row_count bigint"
        )
    entries = []
    for i, c in found:
        low, high = limits[f"l{i}"], limits[f"h{i}"]
        # a constant column gets a bin range of width 1 around its value
        start, width = (low, (high - low) / bins) if high > low else (low - 0.5, 1.0 / bins)
        index = bin_index(_finite(c), low, high, bins)
        up, down = F.col(c) == float("inf"), F.col(c) == float("-inf")
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.when(up, F.lit(bins)).when(down, F.lit(-1)).otherwise(index).alias("bin"),
                F.when(up | down, F.col(c))
                .otherwise(F.lit(start) + index * F.lit(width))
                .alias("bin_start"),
            )
        )
    return (
        values.select(F.inline(F.array(*entries)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column_name", "bin", "bin_start")
        .agg(F.count("*").alias("row_count"))
    )


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation) of every pair, over the rows where both are present.

    A first pass finds means and counts. The second one sums products of centred values: one sum
    per pair, and further sums only for pairs in which a column has nulls, because only there
    the moments of a column depend on its partner. A constant column has no correlation.
    """
    columns = list(columns) if columns is not None else schemas.numeric_columns(df)
    numbers = range(len(columns))
    values = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    facts = values.agg(
        F.expr("count(*) AS n"),
        *[F.expr(f"avg(x{i}) AS a{i}") for i in numbers],
        *[F.expr(f"count(x{i}) AS n{i}") for i in numbers],
        *[F.expr(f"min(x{i}) = max(x{i}) AS k{i}") for i in numbers],
    ).first()
    centred = values.select(
        *[F.expr(f"x{i} - {number_literal(facts[f'a{i}'] or 0.0)} AS x{i}") for i in numbers]
    )
    full = [facts[f"n{i}"] == facts["n"] for i in numbers]
    varied = [i for i in numbers if facts[f"k{i}"] is False]
    sums: dict[str, str] = {}

    def moment(i: int, power: int, partner: int) -> str:
        """Name of the sum of x^power of column i over the rows where the partner is present."""
        value = (f"CASE WHEN x{i} IS NOT NULL THEN 1D END", f"x{i}", f"x{i} * x{i}")[power]
        name = f"s{power}_{i}"
        if not full[partner]:
            name, value = f"{name}_{partner}", f"CASE WHEN x{partner} IS NOT NULL THEN {value} END"
        sums[name] = f"sum({value}) AS {name}"
        return name

    entries = []
    for a, b in combinations(numbers, 2):
        value = "CAST(NULL AS DOUBLE)"
        if a in varied and b in varied:
            sums[f"p{a}_{b}"] = f"sum(x{a} * x{b}) AS p{a}_{b}"
            n, x, y = moment(a, 0, b), moment(a, 1, b), moment(b, 1, a)
            xx, yy = moment(a, 2, b), moment(b, 2, a)
            spread = f"({n} * {xx} - {x} * {x}) * ({n} * {yy} - {y} * {y})"
            value = f"try_divide({n} * p{a}_{b} - {x} * {y}, sqrt(greatest({spread}, 0D)))"
        entries.append(
            {
                "column_a": text_literal(columns[a]),
                "column_b": text_literal(columns[b]),
                "correlation": value,
            }
        )
    return rows_from(centred.agg(F.expr("count(*) AS n"), *map(F.expr, sums.values())), entries)


def daily_counts(df: DataFrame, column: str = "pickup_datetime") -> DataFrame:
    """(day, trips) for every calendar day of the range; empty days count 0."""
    per_day = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.to_date(column).alias("day"))
        .agg(F.count("*").alias("trips"))
    )
    days = per_day.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("day")
    )
    return days.join(per_day, "day", "left").select(
        "day", F.coalesce("trips", F.lit(0).cast("bigint")).alias("trips")
    )


def quality_metrics(df: DataFrame, table_name: str, checked_at: Column | None = None) -> DataFrame:
    """Rows for the quality metric table: null percentages and outlier percentages."""

    def rows(source, prefix, value, limit, status):
        return source.select(
            F.lit(table_name).alias("table_name"),
            F.concat(F.lit(prefix), F.col("column_name")).alias("metric_name"),
            F.col(value).alias("metric_value"),
            F.lit(limit).alias("threshold_value"),
            status.alias("status"),
        )

    nulls = rows(
        null_percent(df),
        "null_pct_",
        "null_percentage",
        NULL_PERCENT_LIMIT,
        F.when(F.col("null_percentage") <= NULL_PERCENT_LIMIT, "pass").otherwise("fail"),
    )
    outliers = rows(
        outlier_table(df), "outliers_", "outlier_percentage", OUTLIER_PERCENT_INFO, F.lit("info")
    )
    metrics = nulls.unionByName(outliers)
    return metrics if checked_at is None else metrics.withColumn("checked_at", checked_at)


def box_plot(df: DataFrame, column: str) -> DataFrame:
    """Five numbers of a box plot; whiskers end at the last value inside the fences."""
    q1, median, q3 = quantiles(df, [column], (0.25, 0.5, 0.75))[column]
    if q1 is None:
        low = high = None
    else:
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    col = F.col(column).cast("double")
    inside = F.when((col >= F.lit(low)) & (col <= F.lit(high)), col)
    return df.agg(
        F.min(inside).alias("whisker_low"),
        F.lit(q1).cast("double").alias("q1"),
        F.lit(median).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"),
        F.max(inside).alias("whisker_high"),
        F.count_if((col < F.lit(low)) | (col > F.lit(high))).alias("outlier_count"),
    )

"""Drift between two windows of a table, and runs that fell behind their baseline.

The two-sample Kolmogorov-Smirnov test compares, for every numeric column at once, the cumulative
distributions of a reference window and of the window after it. Rows collapse to (column, value,
count, count) first, with map-side counters; the running totals are distributed prefix sums over
(column, value), so neither a column nor the table meets in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.columns import quoted
from meterline.operators.ordered import running_totals
from meterline.tracking.runs import lower_is_better, run_metrics

# Days of a window, the level of the test, and the share by which a metric may be worse.
WINDOW_DAYS = 30
SIGNIFICANCE = 0.05
ALERT_SHARE = 0.1

#: Terms of the Kolmogorov series; below ``FLAT`` all of them leave 1 to the last digit.
TERMS, FLAT = 100, 0.04


def kolmogorov_p(scaled: Column) -> Column:
    """Chance of a scaled statistic (the gap times the root of the effective size) this large."""
    term = "(CASE WHEN j % 2 = 1 THEN 2D ELSE -2D END) * exp(-2D * j * j * _s * _s)"
    series = F.expr(f"aggregate(sequence(1, {TERMS}), 0D, (a, j) -> a + {term})")
    return F.when(scaled < FLAT, 1.0).when(scaled.isNotNull(), F.greatest(F.lit(0.0), series))


def two_windows(
    df: DataFrame,
    time: str,
    as_of: dt.datetime,
    reference_days: int = WINDOW_DAYS,
    current_days: int = WINDOW_DAYS,
) -> DataFrame:
    """Rows of [as_of - current_days, as_of) and of the reference window right before it.

    ``in_reference`` tells them apart; rows without a time are in neither.
    """
    start = as_of - dt.timedelta(days=current_days)
    first = start - dt.timedelta(days=reference_days)
    at = F.col(time)
    inside = df.where((at >= F.lit(first)) & (at < F.lit(as_of)))
    return inside.withColumn("in_reference", at < F.lit(start))


def drift_ks(
    df: DataFrame,
    in_reference: str = "in_reference",
    columns: Sequence[str] | None = None,
    significance: float = SIGNIFICANCE,
) -> DataFrame:
    """(column_name, reference_rows, current_rows, statistic, p_value, drifted) per numeric column.

    Null and NaN values don't count. Without a value on one side there is no statistic, and no drift
    is reported. The p-value is the limit distribution's, good from a few dozen values a side.
    """
    columns = schemas.numeric_columns(df, (in_reference,)) if columns is None else list(columns)
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in columns], "column_name string")
    cells = [
        f"named_struct('column_name', '{c}', 'value', nanvl(CAST({quoted(c)} AS DOUBLE), NULL))"
        for c in columns
    ]
    if not cells:
        cells = ["named_struct('column_name', '', 'value', CAST(NULL AS DOUBLE))"]
    long = df.select(
        F.col(in_reference).alias("_old"), F.expr(f"inline(array({', '.join(cells)}))")
    ).where("value IS NOT NULL AND _old IS NOT NULL")
    counts = long.groupBy("column_name", "value").agg(
        F.count_if("_old").alias("old"), F.count_if(~F.col("_old")).alias("new")
    )
    running = running_totals(counts, ["value"], ["old", "new"], ["column_name"])
    sizes = running.groupBy("column_name").agg(
        F.max("old_running").alias("reference_rows"), F.max("new_running").alias("current_rows")
    )
    gap = F.abs(
        F.try_divide(F.col("old_running").cast("double"), F.col("reference_rows"))
        - F.try_divide(F.col("new_running").cast("double"), F.col("current_rows"))
    )
    widest = (
        running.join(F.broadcast(sizes), "column_name")  # one row per column
        .groupBy("column_name")
        .agg(
            F.first("reference_rows").alias("reference_rows"),
            F.first("current_rows").alias("current_rows"),
            F.max(gap).alias("statistic"),
        )
    )
    old, new = F.col("reference_rows").cast("double"), F.col("current_rows").cast("double")
    tested = widest.withColumn("_s", F.sqrt(F.try_divide(old * new, old + new)) * F.col("statistic"))
    tested = tested.withColumn("p_value", kolmogorov_p(F.col("_s")))
    return names.join(tested, "column_name", "left").select(
        "column_name",
        F.coalesce("reference_rows", F.lit(0)).alias("reference_rows"),
        F.coalesce("current_rows", F.lit(0)).alias("current_rows"),
        "statistic",
        "p_value",
        F.coalesce(F.col("p_value") < significance, F.lit(False)).alias("drifted"),
    )


def degradation_alerts(
    runs: DataFrame, baseline: DataFrame | None = None, share: float = ALERT_SHARE
) -> DataFrame:
    """Newest run of every model against its baseline: one row per metric both have.

    ``baseline`` has (run_name, metric, baseline_value); by default it is the model's oldest run. A metric
    is worse by the share of the baseline it lost, by the metric's direction; it alerts above
    ``share``. A baseline of 0 gives no share and no alert.
    """
    by = Window.partitionBy("run_name")
    placed = runs.select(
        "run_name",
        "run_id",
        F.row_number().over(by.orderBy(F.col("start_time"), "run_id")).alias("_age"),
        F.row_number().over(by.orderBy(F.col("start_time").desc(), F.col("run_id").desc())).alias(
            "_new"
        ),
    )
    metrics = run_metrics(runs)
    newest = placed.where("_new = 1").join(metrics, "run_id")
    if baseline is None:
        oldest = placed.where("_age = 1").join(metrics, "run_id")
        baseline = oldest.select("run_name", "metric", F.col("value").alias("baseline_value"))
    both = newest.join(baseline, ["run_name", "metric"])
    lost = F.when(
        lower_is_better(F.col("metric")), F.col("value") - F.col("baseline_value")
    ).otherwise(F.col("baseline_value") - F.col("value"))
    worse = F.try_divide(lost, F.abs("baseline_value"))
    return both.select(
        "run_name",
        "run_id",
        "metric",
        "baseline_value",
        F.col("value").alias("current_value"),
        worse.alias("worse_share"),
        F.coalesce(worse > share, F.lit(False)).alias("alert"),
    )

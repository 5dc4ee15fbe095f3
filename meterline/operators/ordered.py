"""Lag and rolling features over a total order, without one task holding a whole key.

A plain ``Window`` puts every key (or, without a key, the whole table) into one task. Here the
rows are range-sorted by (key, order) and numbered, cut into runs of equal length, and every run
also receives the last rows of the run before it. Windows then work inside a run. The order
columns must be unique within a key, otherwise a lag has no defined value.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.sources.staging import stage

LAGS = (1, 7, 30)
ROLLING_ROWS = (7, 14, 30)
RUN_LENGTH = 100_000

_AGGREGATES = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
}
_NAMES = {*_AGGREGATES, "median"}


def _framed(name: str, column: str, frame, size: int):
    """The function over a frame; a median sorts the few values of a full window itself."""
    if name != "median":
        return _AGGREGATES[name](F.col(column)).over(frame)
    values = F.array_sort(F.collect_list(column).over(frame))
    middle = F.get(values, F.lit((size - 1) // 2)) + F.get(values, F.lit(size // 2))
    return middle / 2


def number_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_rn``, the 0-based position in the total order of (key, order).

    The sorted rows are written once, because a second run could draw other range bounds.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*key, *order]
    placed = (
        df.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stage(placed, "ordered")
    part = F.shiftright("_at", 33).cast("int")
    sizes = {
        r["part"]: r["rows"]
        for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    }  # one row per range partition
    rows = [sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)]
    starts = F.array(*[F.lit(s).cast("bigint") for s in accumulate([0, *rows[:-1]])])
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_rn", F.element_at(starts, part + 1) + inside).drop("_at")


def _runs(numbered: DataFrame, reach: int, length: int) -> DataFrame:
    """Rows with their run ``_run``, plus copies of the last ``reach`` rows for the next run."""
    length = max(length, reach)
    run = F.floor(F.col("_rn") / length)
    own = F.struct(run.alias("_run"), F.lit(True).alias("_own"))
    ahead = F.struct((run + 1).alias("_run"), F.lit(False).alias("_own"))
    to = F.when(F.col("_rn") % length >= length - reach, F.array(own, ahead)).otherwise(F.array(own))
    return numbered.select("*", F.inline(to))


def ordered_features(
    df: DataFrame,
    column: str,
    order: Sequence[str],
    key: Sequence[str] = (),
    lags: Sequence[int] = (),
    windows: Sequence[int] = (),
    functions: Sequence[str] = ("mean", "std"),
    run_length: int = RUN_LENGTH,
) -> DataFrame:
    """Lagged values and trailing row windows of a column in one pass.

    A window is null until it is full and where any value in it is null. With a key, rows of
    other keys never count: they sort before, and the window also partitions by the key.
    """
    if column not in df.columns:
        return df
    unknown = set(functions) - _NAMES
    if unknown:
        raise ValueError(f"unknown functions {sorted(unknown)}")
    reach = max([*lags, *[w - 1 for w in windows], 1])
    runs = _runs(number_rows(df, key, order), reach, run_length)
    by = Window.partitionBy("_run", *key).orderBy("_rn")
    new = {f"{column}_lag_{p}": F.lag(column, p).over(by) for p in lags}
    for w in windows:
        frame = by.rowsBetween(-(w - 1), 0)
        full = F.count(column).over(frame) == w
        for name in functions:
            new[f"{column}_rolling_{w}_{name}"] = F.when(full, _framed(name, column, frame, w))
    return runs.withColumns(new).filter("_own").drop("_own", "_run", "_rn")


def lag_features(df, column, order, key=(), lags=LAGS, run_length=RUN_LENGTH) -> DataFrame:
    return ordered_features(df, column, order, key, lags=lags, run_length=run_length)


def rolling_features(
    df,
    column,
    order,
    key=(),
    windows=ROLLING_ROWS,
    functions=("mean", "std"),
    run_length=RUN_LENGTH,
) -> DataFrame:
    return ordered_features(
        df, column, order, key, windows=windows, functions=functions, run_length=run_length
    )


def running_totals(
    df: DataFrame, order: Sequence[str], columns: Sequence[str], key: Sequence[str] = ()
) -> DataFrame:
    """Add ``<column>_running``, the inclusive cumulative sum over the order within each key.

    The sums inside a range partition are windows; the totals of the partitions before it are
    added from a table with one row per partition and key.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*key, *order]
    placed = df.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id())
    placed = stage(placed, "running")
    inside = Window.partitionBy("_part", *key).orderBy(*order)
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *key).agg(*[F.sum(c).alias(c) for c in columns])
    before = totals.select(
        F.col("_part").alias("_of_part"),
        *[F.col(k).alias(f"_of_{k}") for k in key],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in columns],
    )
    same = F.col("_part") == F.col("_of_part")
    for k in key:  # a null key is a key like any other
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return (
        placed.withColumns({f"_{c}_inside": F.sum(c).over(inside) for c in columns})
        .join(before, same)
        .withColumns(
            {f"{c}_running": F.col(f"_{c}_before") + F.col(f"_{c}_inside") for c in columns}
        )
        .drop("_part", "_of_part", *[f"_of_{k}" for k in key], *[f"_{c}_{x}" for c in columns for x in ("before", "inside")])
    )

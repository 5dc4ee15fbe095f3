"""Linear models from moments: one pass over the rows serves every fold, penalty and solver.

A pass returns, per group, the number of rows, sums and products of the features and the target. Sums are
added on the executors by position, so the driver gets (columns + 1) ** 2 numbers a group whatever
the table. Moments can be added and subtracted: the training moments of a fold are the whole's minus
the fold's own. Fits and their errors follow on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.columns import md5_bucket, number_literal, quoted
from meterline.learn import prep

#: Groups of one pass; each brings (columns + 1) ** 2 numbers to the driver.
MAX_GROUPS = 1000
FOLDS = 5


@dataclass(frozen=True)
class Moments:
    """Rows, sums and products of (features..., target) about ``shift``."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray
    incomplete: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        return self._with(other, 1.0)

    def __sub__(self, other: Moments) -> Moments:
        return self._with(other, -1.0)

    def _with(self, other: Moments, sign: float) -> Moments:
        return Moments(
            self.n + sign * other.n,
            self.sums + sign * other.sums,
            self.products + sign * other.products,
            self.shift,
            self.incomplete + sign * other.incomplete,
        )

    @property
    def means(self) -> np.ndarray:
        return self.shift + self.sums / max(self.n, 1.0)

    @property
    def scatter(self) -> np.ndarray:
        """Sums of products about the mean."""
        return self.products - np.outer(self.sums, self.sums) / max(self.n, 1.0)


PARTIAL = "key string, at int, value double"


def _partial(shift: np.ndarray):
    """A task's moments per group, one row per group and cell."""
    width = len(shift)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str | None, np.ndarray] = {}
        for batch in batches:
            known = batch.column(0).dictionary_encode(null_encoding="encode")
            codes = known.indices.to_numpy(zero_copy_only=False)
            z = np.stack(
                [batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(width)], axis=1
            )
            whole = np.isfinite(z).all(axis=1)
            z -= shift
            for code, key in enumerate(known.dictionary.to_pylist()):
                own = codes == code
                rows = z[own & whole]
                cells = state.setdefault(key, np.zeros(2 + width + width * width))
                cells[0] += len(rows)
                cells[1] += (own & ~whole).sum()
                cells[2 : 2 + width] += rows.sum(axis=0)
                cells[2 + width :] += (rows.T @ rows).ravel()
        for key, cells in state.items():
            columns = [
                pa.array([key] * len(cells), pa.string()),
                pa.array(np.arange(len(cells), dtype=np.int32)),
                pa.array(cells),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "at", "value"])

    return task


def moments(
    df: DataFrame, columns: Sequence[str], target: str, by: Column | None = None
) -> dict[str | None, Moments]:
    """Moments of complete rows per value of ``by``; rows with a null or non-finite cell are counted."""
    names = [*columns, target]
    cells = [F.expr(f"CAST({quoted(c)} AS DOUBLE)").alias(f"z{i}") for i, c in enumerate(names)]
    key = (F.lit("all") if by is None else by).cast("string").alias("key")
    narrow = df.select(key, *cells)
    # about any row's values, so that large ones don't drown their differences
    some = narrow.dropna().first()
    shift = np.array([v if np.isfinite(v) else 0.0 for v in some[1:]] if some else [0.0] * len(names))
    parts = narrow.mapInArrow(_partial(shift), PARTIAL)
    totals = parts.groupBy("key", "at").agg(F.sum("value").alias("value"))
    limit = MAX_GROUPS * (2 + len(names) + len(names) ** 2)
    found = totals.limit(limit + 1).collect()  # groups x cells
    if len(found) > limit:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    flat: dict[str | None, np.ndarray] = {}
    size = 2 + len(names) + len(names) ** 2
    for key, at, value in found:
        flat.setdefault(key, np.zeros(size))[at] = value
    width = len(names)
    return {
        k: Moments(v[0], v[2 : 2 + width], v[2 + width :].reshape(width, width), shift, v[1])
        for k, v in flat.items()
    }


class LinearScorer(
    Transformer, HasInputCols, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Adds the prediction of a linear model over named columns; saved and loaded like any stage."""

    weights = Param(Params._dummy(), "weights", "a weight per column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the constant", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, weights=None, intercept=None, predictionCol="prediction"):  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self):
        return Vectors.dense(self.getOrDefault(self.weights))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        terms = [
            f"CAST({quoted(c)} AS DOUBLE) * {number_literal(w)}"
            for c, w in zip(self.getInputCols(), self.getOrDefault(self.weights), strict=True)
        ]
        text = " + ".join([number_literal(self.getOrDefault(self.intercept)), *terms])
        return dataset.withColumn(self.getPredictionCol(), F.expr(text))


@dataclass(frozen=True)
class LinearFit:
    columns: tuple[str, ...]
    weights: np.ndarray
    intercept: float
    params: dict[str, float] = field(default_factory=dict)

    def scorer(self) -> LinearScorer:
        return LinearScorer(
            inputCols=list(self.columns),
            weights=[float(w) for w in self.weights],
            intercept=float(self.intercept),
        )

    def pipeline(self) -> PipelineModel:
        return PipelineModel([self.scorer()])

    def errors(self, m: Moments) -> dict[str, float | None]:
        """mse, rmse and r2 on the rows of ``m``, from its moments alone; null without rows."""
        if not m.n:
            return {"mse": None, "rmse": None, "r2": None}
        s, w, means = m.scatter, self.weights, m.means
        bias = means[-1] - self.intercept - means[:-1] @ w
        left = s[-1, -1] - 2 * w @ s[:-1, -1] + w @ s[:-1, :-1] @ w
        mse = max(left, 0.0) / m.n + bias**2
        spread = s[-1, -1] / m.n
        r2 = 1 - mse / spread if spread > 0 else None
        return {"mse": float(mse), "rmse": float(np.sqrt(mse)), "r2": r2 if r2 is None else float(r2)}


def _fit(m: Moments, columns: Sequence[str], weights: np.ndarray, **params: float) -> LinearFit:
    means = m.means
    return LinearFit(tuple(columns), weights, float(means[-1] - means[:-1] @ weights), params)


def _units(s: np.ndarray, n: float) -> np.ndarray:
    """Root of each column's scatter; a constant column, whose scatter is rounding, has none."""
    size = np.sqrt(np.maximum(np.diag(s)[:-1], 0.0))
    return np.where(size > 1e-9 * np.sqrt(max(n, 1.0)), size, np.inf)


def least_squares(m: Moments, columns: Sequence[str]) -> LinearFit:
    """Ordinary least squares; of columns that determine each other, the shortest solution."""
    s = m.scatter
    unit = _units(s, m.n)
    scaled = s[:-1, :-1] / np.outer(unit, unit)
    weights = np.linalg.lstsq(scaled, s[:-1, -1] / unit, rcond=1e-12)[0] / unit
    return _fit(m, columns, weights)


def ridge(m: Moments, columns: Sequence[str], alpha: float = 1.0) -> LinearFit:
    """Minimises |y - Xw - b|^2 + alpha |w|^2."""
    if not alpha:
        return least_squares(m, columns)
    s = m.scatter
    weights = np.linalg.solve(s[:-1, :-1] + alpha * np.eye(len(s) - 1), s[:-1, -1])
    return _fit(m, columns, weights, alpha=alpha)


def lasso(
    m: Moments,
    columns: Sequence[str],
    alpha: float = 1.0,
    tolerance: float = 1e-12,
    max_iter: int = 100_000,
) -> LinearFit:
    """Minimises |y - Xw - b|^2 / 2n + alpha |w| by coordinate descent on the moment matrix.

    Ends when no weight moved its share of the fit by more than ``tolerance`` in a sweep.
    """
    s = m.scatter / max(m.n, 1.0)
    gram, pull = s[:-1, :-1], s[:-1, -1]
    unit = _units(s, 1.0)
    size, scale = np.diag(gram), max(np.sqrt(s[-1, -1]), 1e-300)
    weights, slope = np.zeros(len(pull)), pull.astype(float).copy()
    for _ in range(max_iter):
        moved = 0.0
        for j in np.flatnonzero(np.isfinite(unit)):
            old = weights[j]
            open_ = slope[j] + size[j] * old
            new = np.sign(open_) * max(abs(open_) - alpha, 0.0) / size[j]
            if new != old:
                weights[j] = new
                slope -= gram[:, j] * (new - old)
                moved = max(moved, abs(new - old) * unit[j] / scale)
        if moved <= tolerance:
            break
    return _fit(m, columns, weights, alpha=alpha)


def complete_moments(
    df: DataFrame, columns: Sequence[str], target: str, split: str = "split", train: str = "train"
) -> tuple[dict[str | None, Moments], DataFrame]:
    """Moments per split, and the rows they describe.

    One pass when no cell is missing; otherwise medians of the training rows fill the gaps and a second
    pass follows.
    """
    parts = moments(df, columns, target, F.col(split))
    if any(m.incomplete for m in parts.values()):
        gaps = prep.incomplete(df, columns)
        df = prep.fill_medians(df, prep.fit_medians(df.where(F.col(split) == train), gaps))
        parts = moments(df, columns, target, F.col(split))
    return parts, df


SOLVERS = {"LinearRegression": least_squares, "Ridge": ridge, "Lasso": lasso}


def total(parts: Mapping[str | None, Moments]) -> Moments:
    return reduce(Moments.__add__, parts.values())


GRIDS: dict[str, Sequence[dict[str, float]]] = {
    "LinearRegression": ({},),
    "Ridge": tuple({"alpha": a} for a in (0.01, 0.1, 1.0, 10.0, 100.0)),
    "Lasso": tuple({"alpha": a} for a in (0.001, 0.01, 0.1, 1.0, 10.0)),
}

SCORES = (
    "model string, alpha double, fold int, train_rows long, test_rows long,"
    " rmse double, r2 double"
)


def fold_of(key: Sequence[str], folds: int = FOLDS, seed: int = 42) -> Column:
    """Fold 0..folds-1 by a digest of the key, whatever the partitioning."""
    return md5_bucket(key, seed, folds)


def cross_validate(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    key: Sequence[str],
    grids: Mapping[str, Sequence[Mapping[str, float]]] | None = None,
    folds: int = FOLDS,
    seed: int = 42,
) -> DataFrame:
    """Held-out scores of every model, penalty and fold, from one pass over the rows.

    Rows with a missing cell are left out, as in the training tables. A fold without rows has no score.
    """
    parts = moments(df, columns, target, fold_of(key, folds, seed))
    rows = []
    whole = total(parts) if parts else None
    for name, grid in (grids or GRIDS).items():
        for params in grid:
            for fold in range(folds):
                own = parts.get(str(fold))
                if own is None or not own.n or whole.n <= own.n:
                    continue
                train = whole - own
                scores = SOLVERS[name](train, columns, **params).errors(own)
                alpha = params.get("alpha")
                rows.append(
                    (name, alpha, fold, int(train.n), int(own.n), scores["rmse"], scores["r2"])
                )
    return df.sparkSession.createDataFrame(rows, SCORES)


def best_parameters(scores: DataFrame) -> DataFrame:
    """Per model the grid point of the least mean error: (model, alpha, mean_rmse, std_rmse, folds)."""
    means = scores.groupBy("model", "alpha").agg(
        F.avg("rmse").alias("mean_rmse"),
        F.stddev_pop("rmse").alias("std_rmse"),
        F.count("*").alias("folds"),
    )
    order = F.struct("mean_rmse", F.col("alpha"), "std_rmse", "folds")
    return means.groupBy("model").agg(F.min(order).alias("b")).select(
        "model", "b.alpha", "b.mean_rmse", "b.std_rmse", "b.folds"
    )


def coefficient_table(spark: SparkSession, fit: LinearFit, name: str) -> DataFrame:
    """(model, term, value), the intercept included."""
    rows = [(name, c, float(w)) for c, w in zip(fit.columns, fit.weights, strict=True)]
    rows.append((name, "(intercept)", float(fit.intercept)))
    return spark.createDataFrame(rows, "model string, term string, value double")

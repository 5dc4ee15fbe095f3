"""Gaussian mixtures with full covariances, many numbers of components in the same passes over the rows.

Starts, steps and the stopping rule are those of Spark's mixture, whose starting point is taken as it is. Its
steps visit rows one by one, though. Here rows are packed into blocks of bytes once a fit, and a pass is a few
matrix products a chunk for the components of all unfinished runs; tasks return sums by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.stat import MultivariateGaussian
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.learn.lloyd import packed, summed
from meterline.learn.prep import held

#: Spark's floor of a component's density, and the change of the log-likelihood that ends a run.
FLOOR, TOLERANCE = float(np.finfo(float).eps), 0.01


@dataclass(frozen=True)
class Summary:
    logLikelihood: float  # noqa: N815  as the fitted models of Spark
    numIter: int  # noqa: N815


def _density(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray):
    """y -> weighted densities, a row per component; y has a row per feature, so that loops run along rows.

    A singular covariance counts by its pseudo-inverse.
    """
    k, d = means.shape
    roots, offsets, heights = np.zeros((k * d, d)), np.zeros((k * d, 1)), np.zeros((k, 1))
    for i in range(k):
        values, vectors = np.linalg.eigh((covariances[i] + covariances[i].T) / 2)
        solid = values > FLOOR * values.max() * d
        if not solid.any():
            raise ValueError("a component's covariance is zero: there are too few different rows")
        root = (vectors * np.where(solid, 1 / np.sqrt(np.where(solid, values, 1.0)), 0.0)).T
        roots[i * d : (i + 1) * d] = root
        offsets[i * d : (i + 1) * d, 0] = root @ means[i]
        heights[i] = -0.5 * (d * np.log(2 * np.pi) + np.log(values[solid]).sum())
    shares = weights[:, None]

    def densities(y: np.ndarray) -> np.ndarray:
        away = roots @ y
        away -= offsets
        np.multiply(away, away, out=away)
        return shares * np.exp(heights - 0.5 * away.reshape(k, d, -1).sum(axis=1)) + FLOOR

    return densities


@dataclass
class Mixture:
    """A fitted mixture."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    summary: Summary

    def getK(self) -> int:  # noqa: N802
        return len(self.weights)

    @property
    def gaussians(self) -> list[MultivariateGaussian]:
        d = self.means.shape[1]
        return [
            MultivariateGaussian(DenseVector(m), DenseMatrix(d, d, c.ravel(order="F")))
            for m, c in zip(self.means, self.covariances, strict=True)
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``, a vector, and ``prediction``, the likeliest component."""
        densities = _density(self.weights, self.means, self.covariances)
        k, d = self.means.shape

        @F.arrow_udf("array<double>")
        def shares(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            p = densities(np.ascontiguousarray(x.T))
            p /= p.sum(axis=0)
            ends = np.arange(0, k * len(x) + 1, k, dtype=np.int32)
            return pa.ListArray.from_arrays(ends, p.T.ravel())

        best = F.expr("CAST(array_position(_p, array_max(_p)) - 1 AS INT)")
        scored = df.withColumn("_p", shares(vector_to_array("features")))
        return scored.withColumns({"probability": array_to_vector("_p"), "prediction": best}).drop("_p")


def _pass(blocks: DataFrame, runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int):
    """(log-likelihood, weights, sums, products) of each run's components."""
    densities = [_density(*run) for run in runs]

    def cells_of(x, weight):
        y, cells = np.ascontiguousarray(x.T), []
        for of in densities:
            p = of(y)
            total = p.sum(axis=0)
            p *= weight / total
            cells += [[np.log(total) @ weight], p.sum(axis=1), (p @ x).ravel()]
            cells += [((y * own) @ x).ravel() for own in p]
        return np.concatenate(cells)

    sizes = [1 + len(w) * (1 + width + width * width) for w, _, _ in runs]
    flat, found, at = summed(blocks, cells_of, sum(sizes), width), [], 0
    for (w, _, _), size in zip(runs, sizes, strict=True):
        k, own = len(w), flat[at : at + size]
        sums, products = own[1 + k : 1 + k + k * width], own[1 + k + k * width :]
        found.append((own[0], own[1 : 1 + k], sums.reshape(k, width), products.reshape(k, width, width)))
        at += size
    return found


def fit_many(df: DataFrame, ks: Sequence[int], max_iter: int = 100, seed: int = 42) -> dict[int, Mixture]:
    """A mixture for each k; ``df`` has ``features`` and should be held, as every start samples it."""
    runs = {}
    for k in dict.fromkeys(ks):
        start = GaussianMixture(k=k, maxIter=0, seed=seed).fit(df)
        parts = start.gaussians
        means = np.array([g.mean.toArray() for g in parts])
        runs[k] = (np.array(start.weights), means, np.array([g.cov.toArray() for g in parts]))
    width = next(iter(runs.values()))[1].shape[1]
    rows = df.select(vector_to_array("features").alias("x"), F.lit(1.0).alias("w"))
    reached = dict.fromkeys(runs, (-np.inf, 0))
    active = list(runs)
    with held(packed(rows), 1) as blocks:
        for number in range(1, max_iter + 1):
            moved = _pass(blocks, [runs[k] for k in active], width)
            for k, (fit, weights, sums, products) in zip(list(active), moved, strict=True):
                means = sums / weights[:, None]
                covariances = products / weights[:, None, None] - means[:, :, None] * means[:, None, :]
                runs[k] = (weights / weights.sum(), means, covariances)
                if abs(fit - reached[k][0]) <= TOLERANCE:
                    active.remove(k)
                reached[k] = (float(fit), number)
            if not active:
                break
    return {k: Mixture(*run, Summary(*reached[k])) for k, run in runs.items()}

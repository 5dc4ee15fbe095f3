"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it. A block of vectors Q is
multiplied by the covariance in one pass over the rows: every task computes its part of X'(XQ) with
centred rows, and the parts are summed by position. A Chebyshev polynomial of the covariance, evaluated
by its three-term recurrence (one pass a degree), damps the part of the spectrum below the block; QR and
Rayleigh-Ritz follow. Rounds go on until every wanted residual is certified: at most ``CERTIFIED`` of the
largest eigenvalue, or no longer shrinking and below ``SETTLED`` of it. Else the fit raises.

Rows are whole numbers: an entry c becomes x = floor(1024 c) + 100000. Sums and deviations from the mean
are exact integers (``n * x - S``); only the division by n and what follows is in floating point.

The driver holds the block (dimensions x ``components + guard`` numbers) and never a row. Prepared rows are
staged once, since every degree reads them.

Defined results: rows whose vector is null or holds a null or non-finite entry are left out; a shorter vector
counts its missing entries as c = 0; repeated rows and null ids count like any other row; components whose
variance is 0 (constant tables, fewer rows than components) do not exist and give no rows; an empty
table gives no rows; entries with 1024 * abs(c) of 2**52 or more raise; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import map_batches
from meterline.sources.staging import stage

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**52
DEGREE = 10
CERTIFIED, SETTLED = 5e-14, 1e-10
MOST_ROUNDS = 60


@dataclass(frozen=True)
class Whitening:
    """Components as columns of ``vectors``; ``total`` is the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    total: float
    residual: float
    passes: int


def prepare(rows: DataFrame, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(id, x) of the rows that take part; ``x`` is an array of long."""
    vec = F.col(vector)
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = F.transform(
        vec,
        lambda c: F.when(
            F.abs(c.cast("double")) * SCALE >= LARGEST, F.raise_error("entry out of range")
        ).otherwise(F.floor(c.cast("double") * SCALE) + SHIFT),
    )
    return rows.where(vec.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_column).alias("id"), whole.cast("array<long>").alias("x")
    )


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows' whole numbers, one row each; missing entries are those of c = 0."""
    column = batch.column("x")
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.full((len(lengths), width), SHIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class _Centred:
    """Rows minus the mean: n * x - S is exact before it is divided."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        self.n, self.sums, self.width = n, sums, len(sums)

    def scaled(self, batch: pa.RecordBatch) -> np.ndarray:
        """n * x - S; Python integers where 64 bits might not hold it."""
        x = matrix(batch, self.width)
        most = int(np.abs(x).max(initial=0))
        if self.n * most + max(map(abs, self.sums), default=0) < 2**63:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, scaled: np.ndarray) -> np.ndarray:
        return (scaled / self.n).astype(np.float64)

    def deviations(self, scaled: np.ndarray) -> list[int]:
        """The exact sum of squares of each row."""
        if scaled.dtype == object or np.abs(scaled).max(initial=0) >= 2**53 or self.width > 512:
            return (scaled.astype(object) ** 2).sum(axis=1).tolist()
        high, low = scaled >> 26, scaled & (2**26 - 1)
        parts = [(high * high).sum(1), (high * low).sum(1), (low * low).sum(1)]
        return [
            (a << 52) + (b << 27) + c for a, b, c in zip(*(p.tolist() for p in parts), strict=True)
        ]


class _Sums:
    def __init__(self, width: int):
        self.width = width

    def __call__(self, batch: pa.RecordBatch) -> dict:
        x = matrix(batch, self.width)
        wide = len(x) * int(np.abs(x).max(initial=0)) >= 2**63
        sums = (x.astype(object) if wide else x).sum(axis=0)
        return {"at": range(self.width), "value": [str(v) for v in sums]}


class _Product:
    """A batch's part of X'(XQ)."""

    def __init__(self, centre: _Centred, block: np.ndarray):
        self.centre, self.block = centre, block

    def __call__(self, batch: pa.RecordBatch) -> dict:
        x = self.centre.rows(self.centre.scaled(batch))
        part = (x.T @ (x @ self.block)).ravel()
        return {"at": range(len(part)), "value": part}


class _Moments:
    """A batch's sums and products of whitened values, and its part of the trace."""

    def __init__(self, centre: _Centred, block: np.ndarray):
        self.centre, self.block = centre, block

    def __call__(self, batch: pa.RecordBatch) -> dict:
        x = self.centre.rows(self.centre.scaled(batch))
        w = x @ self.block
        part = np.concatenate([w.sum(0), (w.T @ w).ravel(), [(x * x).sum()]])
        return {"at": range(len(part)), "value": part}


def _total(rows: DataFrame, part, size: int) -> np.ndarray:
    """Tasks' parts summed by position on the executors; the driver gets ``size`` numbers."""
    parts = map_batches(rows, part, "at int, value double").groupBy("at").agg(F.sum("value"))
    out = np.zeros(size)
    for at, value in parts.collect():
        out[at] = value
    return out


class _Operator:
    """The covariance as a map of blocks, one pass over the rows a call."""

    def __init__(self, rows: DataFrame, centre: _Centred):
        self.rows, self.centre, self.passes = rows, centre, 0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        self.passes += 1
        part = _Product(self.centre, block)
        return _total(self.rows, part, block.size).reshape(block.shape) / self.centre.n


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors in an orthonormal block, and the vectors' images."""
    small = block.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1]
    return values[order], block @ turn[:, order], image @ turn[:, order]


def _filter(
    apply: _Operator, block: np.ndarray, image: np.ndarray, low: float, high: float, top: float
) -> np.ndarray:
    """A Chebyshev polynomial of the operator applied to ``block``: small on [low, high], 1 at ``top``.

    Scaled at each step so that the largest wanted part neither grows nor vanishes.
    """
    middle, half = (high + low) / 2, max((high - low) / 2, np.finfo(float).tiny)
    first = half / (top - middle) if top > middle else 1.0
    sigma, before = first, block
    now = (image - middle * block) * (first / half)
    for _ in range(2, DEGREE + 1):
        following = 1 / (2 / first - sigma)
        after = (apply(now) - middle * now) * (2 * following / half) - sigma * following * before
        before, now, sigma = now, after, following
    return now


def fit(rows: DataFrame, components: int = 8, guard: int = 24, seed: int = 7) -> Whitening:
    """The leading components of ``prepare``d rows; staged, as every degree is a pass over them."""
    size = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    n, width = size[0], size[1] or 0
    if not n or not width:
        return Whitening(n, (0,) * width, np.zeros((width, 0)), np.zeros(0), 0.0, 0.0, 0)
    parts = map_batches(rows, _Sums(width), "at int, value string")
    found = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("string"))
    by_place = {at: int(value) for at, value in found.collect()}
    centre = _Centred(n, tuple(by_place[i] for i in range(width)))
    apply = _Operator(rows, centre)

    start = np.random.default_rng(seed).standard_normal((width, min(width, components + guard)))
    block = np.linalg.qr(start)[0]
    wanted, last, residual = min(components, width), math.inf, math.inf
    low = 0.0  # the covariance has no negative eigenvalue
    for _ in range(MOST_ROUNDS):
        values, block, image = _ritz(block, apply(block))
        scale = max(values[0], 0.0)
        residuals = np.linalg.norm(image - block * values, axis=0)
        residual = residuals[:wanted].max()
        if residual <= CERTIFIED * scale or (residual <= SETTLED * scale and residual > last / 2):
            break
        last = residual
        block = np.linalg.qr(_filter(apply, block, image, low, max(values[-1], 0.0), scale))[0]
    else:
        raise ArithmeticError(f"residual {residual:.1e} after {MOST_ROUNDS} rounds")

    trace = _total(rows, _Moments(centre, np.zeros((width, 0))), 1)[0] / n
    real = values[:wanted] > 1e-13 * max(trace, 0.0)
    return Whitening(
        n,
        centre.sums,
        block[:, :wanted][:, real],
        values[:wanted][real],
        float(trace),
        float(residual),
        apply.passes,
    )


class _Project:
    def __init__(self, model: Whitening, error: float):
        self.centre, self.model, self.error = _Centred(model.n, model.sums), model, error
        self.turn = model.vectors / np.sqrt(model.values)

    def __call__(self, batch: pa.RecordBatch) -> dict:
        scaled = self.centre.scaled(batch)
        k, rows = self.turn.shape[1], len(scaled)
        white = self.centre.rows(scaled) @ self.turn
        return {
            "id": batch.column("id").take(pa.array(np.repeat(np.arange(rows), k))),
            "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
            "n": [self.model.n] * (rows * k),
            "deviation": [str(d) for d in self.centre.deviations(scaled) for _ in range(k)],
            "whitened": white.ravel(),
            "explained": np.tile(self.model.values / self.model.total, rows),
            "identity_error": [self.error] * (rows * k),
        }


def whiten(rows: DataFrame, model: Whitening, id_column: str = "vec_id") -> DataFrame:
    """One row per prepared row and component; ``deviation`` is decimal(38,0), exact at any size."""
    k, error = len(model.values), 0.0
    if k:
        turn = model.vectors / np.sqrt(model.values)
        sums = _total(rows, _Moments(_Centred(model.n, model.sums), turn), k + k * k + 1) / model.n
        spread = sums[k : k + k * k].reshape(k, k) - np.outer(sums[:k], sums[:k])
        error = float(np.abs(spread - np.eye(k)).max())
    kind = T.StructType().add("id", rows.schema["id"].dataType).simpleString()[7:-1]
    schema = (
        f"{kind.replace(':', ' ', 1)}, component int, n long, deviation string, whitened double,"
        " explained double, identity_error double"
    )
    source = rows if k else rows.limit(0)
    out = map_batches(source, _Project(model, error), schema)
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")).withColumnRenamed(
        "id", id_column
    )


def whitened_table(
    rows: DataFrame,
    components: int = 8,
    vector: str = "embedding",
    id_column: str = "vec_id",
) -> DataFrame:
    """``prepare``, ``fit`` and ``whiten`` of a whole table."""
    ready = stage(prepare(rows, vector, id_column), "whitening-rows")
    return whiten(ready, fit(ready, components), id_column)

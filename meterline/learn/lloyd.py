"""k-means for many starts and numbers of clusters in the same passes over the rows.

Equal vectors become one weighted row first, and rows are packed into blocks of bytes once, so that a pass
hands them to numpy as they are. Every pass sends the current centres of all unfinished runs to the
tasks; a task adds up sizes, sums and costs of all runs by matrix products and returns one row, whose cells
are summed by position. So ten restarts, or ten restarts of nine numbers of clusters, cost as
many scans as the slowest of them.

Starts come from all rows, by oversampling: in each of ``ROUNDS`` rounds a vector becomes a candidate with
a chance that follows its weight and its squared distance to the candidates so far, so a small group
far from all others is met. Every restart then draws from the candidates, weighted by the rows
nearest to them. A round draws ``OVERSAMPLE`` candidates per cluster in the mean, whatever the table
and however often one vector stands in it, and that is all of the rows that the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.learn.prep import held

#: Rounds that draw candidates, candidates of a round per cluster, and steps taken on candidates alone.
ROUNDS, OVERSAMPLE, LOCAL_STEPS = 5, 4, 20
#: Rows of a matrix product, so that its operands stay in a core's cache.
CHUNK = 2048
#: Bytes of a row of packed vectors.
PIECE = 384 << 10


@dataclass
class Centres:
    """A fitted k-means: centres, sum of squared distances, and passes until they stood still."""

    points: np.ndarray
    cost: float
    passes: int

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802  as the fitted models of Spark
        return list(self.points)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the index of the nearest centre, the first one of equals."""
        distances = (
            " + ".join(f"pow(_x[{i}] - CAST('{float(v)!r}' AS DOUBLE), 2)" for i, v in enumerate(p))
            for p in self.points
        )
        nearest = "_d -> CAST(array_position(_d, array_min(_d)) - 1 AS INT)"
        found = F.expr(f"transform(array(array({', '.join(distances)})), {nearest})[0]")
        return df.withColumn("_x", vector_to_array("features")).withColumn("prediction", found).drop("_x")


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None] - centres) ** 2).sum(axis=2)


def _start(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """k-means++ on weighted candidates, and a few steps on them.

    Each centre is drawn by weight and squared distance to the nearest one so far.
    """
    picked = [points[random.choice(len(points), p=weights / weights.sum())]]
    nearest = _distances(points, np.array(picked))[:, 0]
    for _ in range(1, k):
        pull = nearest * weights
        total = pull.sum()
        at = random.choice(len(points), p=pull / total) if total > 0 else random.integers(len(points))
        picked.append(points[at])
        nearest = np.minimum(nearest, _distances(points, points[at : at + 1])[:, 0])
    centres = np.array(picked)
    for _ in range(LOCAL_STEPS):
        label = _distances(points, centres).argmin(axis=1)
        for i in range(k):
            own = label == i
            if own.any() and weights[own].sum() > 0:
                centres[i] = np.average(points[own], axis=0, weights=weights[own])
    return centres[np.lexsort(centres.T)]


def packed(rows: DataFrame) -> DataFrame:
    """(x, w) rows as blocks: the numbers of many vectors and weights end to end, as bytes.

    A block is cut into rows of about ``PIECE`` bytes, whole chunks; ``left`` is how many of its vectors follow.
    Hold the rows with one of them a cached batch.
    """
    chunk, most = CHUNK, PIECE

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = len(batch.column(0).flatten()) // max(batch.num_rows, 1)
            piece = chunk * max(most // (8 * chunk * max(width, 1)), 1)
            for at in range(0, batch.num_rows, piece):
                part = batch.slice(at, piece)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False)
                weight = part.column(1).to_numpy(zero_copy_only=False)
                cells = [x.astype(np.float64).tobytes(), weight.astype(np.float64).tobytes()]
                arrays = [pa.array([c], pa.binary()) for c in cells]
                left = pa.array([batch.num_rows - at - part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([*arrays, left], ["x", "w", "left"])

    return rows.mapInArrow(blocks, "x binary, w binary, left int")


def summed(blocks: DataFrame, cells_of, size: int, width: int) -> np.ndarray:
    """``cells_of(x, weight)`` of all blocks, summed by position; the driver gets ``size`` numbers."""
    chunk = CHUNK

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block, weights in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width)
                weight = np.frombuffer(weights.as_buffer(), np.float64)
                for at in range(0, len(x), chunk):
                    flat = cells_of(x[at : at + chunk], weight[at : at + chunk])
                    total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["cells"])

    cells = blocks.mapInArrow(partial, "cells array<double>").select(F.posexplode("cells").alias("at", "v"))
    flat = np.zeros(size)
    for at, value in cells.groupBy("at").agg(F.sum("v").alias("v")).collect():
        flat[at] = value
    return flat


def _drawn(rows: DataFrame, centres: np.ndarray, share: float, number: int, seed: int) -> np.ndarray:
    """Rows that fall below ``share`` x weight x squared distance to the centres, by a hash of the row."""
    width = centres.shape[1]
    draw = F.pmod(F.xxhash64("x", F.lit(seed), F.lit(number)), F.lit(1 << 52)) / float(1 << 52)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                near = np.full(len(x), np.inf)
                for c in centres:
                    near = np.minimum(near, ((x - c) ** 2).sum(axis=1))
                weight = batch.column(1).to_numpy(zero_copy_only=False)
                kept = batch.column(2).to_numpy(zero_copy_only=False) < share * weight * near
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept))], ["x"])

    found = rows.withColumn("u", draw).mapInArrow(chosen, "x array<double>").collect()
    return np.array([r["x"] for r in found]).reshape(-1, width)


def candidates(
    rows: DataFrame, most: int, seed: int, blocks: DataFrame | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Starting points drawn from all rows, and the rows nearest to each; ``most`` clusters at most.

    ``blocks`` are the same rows, packed and kept.
    """
    blocks = packed(rows) if blocks is None else blocks
    first = rows.orderBy(F.xxhash64("x", F.lit(seed)), "x").select("x").first()
    points = np.array([first["x"]])
    width = points.shape[1]
    if most == 1:  # one centre moves to the mean of all rows from wherever it starts
        return points, np.ones(1)

    def cost_to(centres):
        def cells(x, weight):
            near = np.full(len(x), np.inf)
            for c in centres:
                near = np.minimum(near, ((x - c) ** 2).sum(axis=1))
            return np.array([(near * weight).sum()])

        return cells

    for number in range(ROUNDS):
        cost = summed(blocks, cost_to(points), 1, width)[0]
        if cost <= 0:
            break
        found = _drawn(rows, points, OVERSAMPLE * most / cost, number, seed)
        points = np.unique(np.vstack([points, found]), axis=0)
    if len(points) < most:  # few distinct rows: all of them are candidates
        some = rows.orderBy(F.xxhash64("x", F.lit(seed)), "x").select("x").limit(OVERSAMPLE * most)
        points = np.unique(np.vstack([points, [r["x"] for r in some.collect()]]), axis=0)

    def nearest_of(x, weight):
        best, label = np.full(len(x), np.inf), np.zeros(len(x), int)
        for i, c in enumerate(points):
            distance = ((x - c) ** 2).sum(axis=1)
            label[distance < best] = i
            best = np.minimum(best, distance)
        return np.bincount(label, weight, len(points))

    return points, summed(blocks, nearest_of, len(points), width)


def _pass(blocks: DataFrame, centres: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(sizes, sums, cost) of each run's centres."""
    width = centres[0].shape[1]
    every = np.vstack(centres)
    norms, twice = (every * every).sum(axis=1)[:, None], -2 * every
    ends = np.cumsum([len(c) for c in centres]).tolist()
    starts = [0, *ends[:-1]]

    def cells_of(x, weight):
        # a row per centre of every run, the chunk's rows side by side: distances, then own weights in their place
        own = twice @ x.T
        own += norms
        square, costs = (x * x).sum(axis=1), []
        for first, end in zip(starts, ends, strict=True):
            part = own[first:end]
            near = part.min(axis=0)
            np.equal(part, near, out=part, casting="unsafe")
            if np.count_nonzero(part) > len(x):  # the first one of equally near centres
                part[np.cumsum(part, axis=0) > 1] = 0.0
            costs.append((np.maximum(near + square, 0) * weight).sum())
        own *= weight
        return np.concatenate([own.sum(axis=1), (own @ x).ravel(), costs])

    total = len(every)
    flat = summed(blocks, cells_of, total * (width + 1) + len(centres), width)
    sizes, sums = flat[:total], flat[total : total * (width + 1)].reshape(total, width)
    costs = flat[total * (width + 1) :]
    return [
        (sizes[first:end], sums[first:end], float(cost))
        for first, end, cost in zip(starts, ends, costs, strict=True)
    ]


def weighted(df: DataFrame) -> DataFrame:
    """(x, w): the distinct feature vectors and how often each stands in the table."""
    rows = df.select(vector_to_array("features").alias("x"))
    return rows.groupBy("x").agg(F.count("*").alias("w"))


def silhouettes(blocks: DataFrame, found: dict[int, Centres]) -> dict[int, float | None]:
    """For each k the mean silhouette with squared distances, in two passes for all of them.

    None where fewer than two clusters have rows. The rows of a cluster of one count as 0.
    """
    models = {k: c.points for k, c in found.items()}
    width = next(iter(models.values())).shape[1]

    def labels(x, points):
        # as ``transform`` measures: differences, not products
        near, label = np.full(len(x), np.inf), np.zeros(len(x), int)
        for i, c in enumerate(points):
            distance = ((x - c) ** 2).sum(axis=1)
            np.putmask(label, distance < near, i)
            np.minimum(near, distance, out=near)
        return label

    def facts(x, weight):
        square, cells = (x * x).sum(axis=1) * weight, []
        for points in models.values():
            own = (labels(x, points) == np.arange(len(points))[:, None]) * weight
            cells += [own.sum(axis=1), own @ (square / weight), (own @ x).ravel()]
        return np.concatenate(cells)

    flat = summed(blocks, facts, sum(len(p) * (2 + width) for p in models.values()), width)
    means, at = {}, 0
    for k, points in models.items():
        n = len(points)
        sizes, squares, sums = np.split(flat[at : at + n * (2 + width)], [n, 2 * n])
        at += n * (2 + width)
        some = np.maximum(sizes, 1)[:, None]
        # of an empty cluster no row is near
        offset = np.where(sizes[:, None] > 0, squares[:, None] / some, np.inf)
        means[k] = sizes, offset, -2 * sums.reshape(n, width) / some

    def scores(x, weight):
        square, place, cells = (x * x).sum(axis=1), np.arange(len(x)), []
        for k, (sizes, offset, middles) in means.items():
            label = labels(x, models[k])
            away = middles @ x.T
            away += offset
            away += square
            rows = sizes[label]
            own = away[label, place] * rows / np.maximum(rows - 1, 1)
            away[label, place] = np.inf
            other = away.min(axis=0)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(own < other, 1 - own / other, np.where(own > other, other / own - 1, 0.0))
            cells.append((np.where(rows > 1, score, 0.0) * weight).sum())
        return np.array(cells)

    totals = summed(blocks, scores, len(means), width)
    return {
        k: float(total / sizes.sum()) if (sizes > 0).sum() > 1 else None
        for total, (k, (sizes, _, _)) in zip(totals, means.items(), strict=True)
    }


@contextmanager
def ready(df: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The weighted rows of ``df``, which has ``features``, and the same ones packed, held for many passes."""
    with held(weighted(df)) as rows, held(packed(rows), 1) as blocks:
        if rows.isEmpty():
            raise ValueError("there are no rows to cluster")
        yield rows, blocks


def fit_many(
    df: DataFrame,
    ks: Sequence[int],
    restarts: int = 10,
    max_iter: int = 300,
    tolerance: float = 0.01,
    seed: int = 42,
) -> dict[int, Centres]:
    """The best of ``restarts`` starts for each k; ``df`` has ``features``.

    A run ends once all its centres together moved less than ``tolerance``; equal starts run once.
    """
    with ready(df) as (rows, blocks):
        return fit_ready(rows, blocks, ks, restarts, max_iter, tolerance, seed)


def fit_ready(
    rows: DataFrame,
    blocks: DataFrame,
    ks: Sequence[int],
    restarts: int = 10,
    max_iter: int = 300,
    tolerance: float = 0.01,
    seed: int = 42,
) -> dict[int, Centres]:
    """``fit_many`` on the rows and blocks of ``ready``."""
    points, weights = candidates(rows, max(ks), seed, blocks)
    runs: dict[tuple[int, bytes], np.ndarray] = {}
    for k in ks:
        for r in range(restarts):
            start = _start(points, weights, k, np.random.default_rng([seed, k, r]))
            runs[k, start.tobytes()] = start
    done: list[tuple[int, Centres]] = []
    for number in range(1, max_iter + 1):
        names = list(runs)
        moved = _pass(blocks, [runs[n] for n in names])
        for name, (sizes, sums, cost) in zip(names, moved, strict=True):
            old = runs[name]
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], old)
            if np.sqrt(((new - old) ** 2).sum()) < tolerance or number == max_iter:
                done.append((name[0], Centres(old, cost, number)))
                del runs[name]
            else:
                runs[name] = new
        if not runs:
            break
    return {k: min((c for n, c in done if n == k), key=lambda c: c.cost) for k in ks}

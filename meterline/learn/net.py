"""A feed-forward classifier with rectified units, trained by mini-batch Adam in parallel.

An epoch is one pass over the rows. Every task starts from the shared weights, takes Adam steps on small
batches of its own rows, and returns its weights and moments times its number of rows; the averages
over all rows are the next shared state. Sums are added by position on the executors, so the driver
gets three numbers a weight, whatever the table.

A tenth of the rows, by a digest of their values, is held out. The same pass scores them with the weights
it started from; training stops once their accuracy has not grown by ``TOLERANCE`` for ``PATIENCE``
epochs, and the best weights stay. The loss curve has a row per epoch.

Rows are packed into blocks of bytes once a fit, so that an epoch hands them to numpy as they are.
Features are standardised by the rows' means and deviations, which are part of the model. A fit depends
on how the rows are dealt to tasks, as batches are, but not on the order in which tasks end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.learn.lloyd import packed
from meterline.learn.prep import held as held_rows

HELD_OUT, PATIENCE, TOLERANCE = 0.1, 10, 1e-4
BATCH, RATE, PENALTY = 200, 1e-3, 1e-4
DECAYS, EPSILON = (0.9, 0.999), 1e-8

CURVE = "epoch int, loss double, held_out_loss double, held_out_accuracy double"


def sizes_of(layers: Sequence[int]) -> int:
    return sum((a + 1) * b for a, b in zip(layers[:-1], layers[1:], strict=True))


def start_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights, wider for rectified units and narrower for many inputs and outputs."""
    random, parts = np.random.default_rng(seed), []
    for a, b in zip(layers[:-1], layers[1:], strict=True):
        reach = np.sqrt((6 if b != layers[-1] else 2) / (a + b))
        parts += [random.uniform(-reach, reach, a * b), random.uniform(-reach, reach, b)]
    return np.concatenate(parts)


def net_functions(layers: Sequence[int], penalty: float = PENALTY):
    """(probabilities, loss_and_slope) over a flat weight vector; plain closures for the tasks."""
    layers = tuple(layers)

    def cut(flat):
        at, out = 0, []
        for a, b in zip(layers[:-1], layers[1:], strict=True):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + (a + 1) * b]))
            at += (a + 1) * b
        return out

    def run(flat, x):
        seen, parts = [x], cut(flat)
        for i, (w, bias) in enumerate(parts):
            x = x @ w + bias
            if i < len(parts) - 1:
                x = np.maximum(x, 0.0)
                seen.append(x)
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True), seen

    def probabilities(flat, x):
        return run(flat, x)[0]

    def loss_and_slope(flat, x, y):
        """Mean log loss plus half the penalty on squared weights per row, and its slope."""
        p, seen = run(flat, x)
        n, parts, slopes = len(x), cut(flat), []
        loss = -np.log(np.maximum(p[np.arange(n), y], 1e-300)).sum() / n
        back = p.copy()
        back[np.arange(n), y] -= 1.0
        back /= n
        for i in range(len(parts) - 1, -1, -1):
            w = parts[i][0]
            loss += penalty * (w * w).sum() / (2 * n)
            slopes[:0] = [(seen[i].T @ back + penalty * w / n).ravel(), back.sum(axis=0)]
            if i:
                back = (back @ w.T) * (seen[i] > 0)
        return loss, np.concatenate(slopes)

    return probabilities, loss_and_slope


class NetModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction`` to a table with ``features``."""

    layers = Param(Params._dummy(), "layers", "units per layer", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "all weights, end to end", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean per feature", TypeConverters.toListFloat)
    widths = Param(Params._dummy(), "widths", "unit per feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, layers=None, weights=None, means=None, widths=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        probabilities, _ = net_functions(self.getOrDefault(self.layers))
        flat, means, widths = (
            np.array(self.getOrDefault(p)) for p in (self.weights, self.means, self.widths)
        )

        def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                if len(part):
                    x = (np.stack(part.to_numpy()) - means) / widths
                    yield pd.Series(list(probabilities(flat, x)))
                else:
                    yield pd.Series([], dtype=object)

        score = F.pandas_udf(scores, "array<double>")
        scored = dataset.withColumn("_p", score(vector_to_array("features")))
        best = F.expr("CAST(array_position(_p, array_max(_p)) - 1 AS DOUBLE)")
        return scored.withColumns({"probability": array_to_vector("_p"), "prediction": best}).drop("_p")


@dataclass(frozen=True)
class NetFit:
    model: NetModel
    curve: list[tuple[int, float, float | None, float | None]]

    def curve_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.curve, CURVE)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers and weights of each block of ``packed`` rows, whose rows follow each other."""
    x, w = [], []
    for batch in batches:
        for block, weights, left in zip(*batch.columns, strict=True):
            x.append(np.frombuffer(block.as_py(), np.float64))
            w.append(np.frombuffer(weights.as_py(), np.float64))
            if not left.as_py():
                yield np.concatenate(x), np.concatenate(w)
                x, w = [], []


def _epoch(layers, state, means, widths, step: float, seed: int):
    """A task's epoch: its rows' share of the next state, and scores under the shared weights."""
    probabilities, loss_and_slope = net_functions(layers)
    shared, first_m, first_v = state
    decay_m, decay_v = DECAYS
    batch_rows, rate, epsilon, width = BATCH, RATE, EPSILON, len(means)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, m, v, t = shared.copy(), first_m.copy(), first_v.copy(), step
        rows = loss = held = held_loss = right = 0.0
        random = np.random.default_rng(seed)
        for block, codes in _whole_blocks(batches):
            x = (block.reshape(-1, width) - means) / widths
            code = codes.astype(int)
            out = code < 0
            y = np.where(out, -1 - code, code)
            if out.any():
                p = probabilities(shared, x[out])
                held += out.sum()
                held_loss -= np.log(np.maximum(p[np.arange(len(p)), y[out]], 1e-300)).sum()
                right += (p.argmax(axis=1) == y[out]).sum()
            x, y = x[~out], y[~out]
            order = random.permutation(len(x))
            for at in range(0, len(x), batch_rows):
                own = order[at : at + batch_rows]
                value, slope = loss_and_slope(flat, x[own], y[own])
                loss += value * len(own)
                t += 1
                m = decay_m * m + (1 - decay_m) * slope
                v = decay_v * v + (1 - decay_v) * slope * slope
                size = rate * np.sqrt(1 - decay_v**t) / (1 - decay_m**t)
                flat = flat - size * m / (np.sqrt(v) + epsilon)
            rows += len(x)
        if rows or held:
            scores = [rows, loss, held, held_loss, right, t * rows]
            cells = np.concatenate([scores, flat * rows, m * rows, v * rows])
            yield pa.RecordBatch.from_arrays([pa.array([cells], pa.list_(pa.float64()))], ["cells"])

    return task


def fit_net(
    train: DataFrame,
    hidden: Sequence[int] = (100, 50),
    classes: int = 2,
    max_epochs: int = 500,
    seed: int = 42,
) -> NetFit:
    """Fit on (features, label), labels 0..classes-1; the table should be held in memory."""
    if train.isEmpty():
        raise ValueError("there are no rows to train on")
    row = train.select(Summarizer.metrics("mean", "std").summary(F.col("features")).alias("s")).first()
    means, widths = row["s"]["mean"].toArray(), row["s"]["std"].toArray()
    widths = np.where(widths > 1e-12 * np.maximum(1.0, np.abs(means)), widths, 1.0)
    layers = [len(means), *hidden, classes]
    out = F.pmod(F.xxhash64("x", "y", F.lit(seed)), F.lit(1000)) < int(HELD_OUT * 1000)
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"))
    # a held-out row has its label below 0
    coded = rows.select("x", F.when(out, -1 - F.col("y")).otherwise(F.col("y")).cast("double").alias("w"))
    with held_rows(packed(coded), 1) as blocks:
        return _fit_blocks(blocks, layers, means, widths, max_epochs, seed)


def _fit_blocks(blocks: DataFrame, layers, means, widths, max_epochs: int, seed: int) -> NetFit:
    size = sizes_of(layers)
    state = (start_weights(layers, seed), np.zeros(size), np.zeros(size))
    curve, best, waited, step = [], (-np.inf, state[0]), 0, 0.0
    for epoch in range(1, max_epochs + 1):
        task = _epoch(layers, state, means, widths, step, seed + epoch)
        cells = blocks.mapInArrow(task, "cells array<double>").select(
            F.posexplode("cells").alias("at", "v")
        )
        flat = np.zeros(6 + 3 * size)
        for at, value in cells.groupBy("at").agg(F.sum("v").alias("v")).collect():
            flat[at] = value  # three numbers a weight
        n, loss, held, held_loss, right, steps = flat[:6]
        if not n:
            raise ValueError("there are no rows to train on")
        score = right / held if held else -loss / n
        curve.append(
            (
                epoch,
                float(loss / n),
                float(held_loss / held) if held else None,
                float(right / held) if held else None,
            )
        )
        if score > best[0] + TOLERANCE:
            best, waited = (score, state[0]), 0
        else:
            waited += 1
            if waited >= PATIENCE:
                break
        state, step = tuple(flat[6:].reshape(3, size) / n), steps / n
    model = NetModel(
        layers=list(layers),
        weights=[float(w) for w in best[1]],
        means=[float(v) for v in means],
        widths=[float(v) for v in widths],
    )
    return NetFit(model, curve)

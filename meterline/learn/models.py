"""Regression and classification trainers over ``pyspark.ml``.

A trainer takes a table with a ``features`` vector and a ``label`` and returns the fitted model.
Penalties are translated so that the linear models have the usual closed-form objectives; tree
boosting is Spark's own, so its metrics are comparable with other libraries, not equal. The net is
in ``net``; linear fits for many folds and penalties at once are in ``moments``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.learn.net import fit_net
from meterline.learn.prep import SEED

MAX_DEPTH = 30
# histogram memory per task: more tree nodes per pass over the data
TREE_MEMORY_MB = 1024


@dataclass(frozen=True)
class Trained:
    """A fitted model with what a run record needs."""

    name: str
    family: str
    model: Model
    columns: list[str]
    params: dict[str, str] = field(default_factory=dict)

    def pipeline(self) -> PipelineModel:
        """Assembler and model in one, to be saved and loaded as a whole."""
        assembler = VectorAssembler(inputCols=self.columns, outputCol="features")
        return PipelineModel([assembler, self.model])


def linear(train: DataFrame) -> Model:
    return LinearRegression(regParam=0.0, solver="normal").fit(train)


def ridge(train: DataFrame, alpha: float = 1.0) -> Model:
    """Minimises |y - Xw|^2 + alpha |w|^2; Spark divides by n and scales by the label's std."""
    row = train.agg(F.count("*").alias("n"), F.stddev_pop("label").alias("s")).first()
    penalty = alpha * (row["s"] or 0.0) / max(row["n"], 1)
    return LinearRegression(
        elasticNetParam=0.0, regParam=penalty, standardization=False, solver="normal"
    ).fit(train)


def lasso(train: DataFrame, alpha: float = 1.0) -> Model:
    return LinearRegression(
        elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=1000
    ).fit(train)


def _depth(wanted: int | None) -> int:
    """Spark's trees stop at ``MAX_DEPTH``, which also stands for "no limit" (None)."""
    if wanted is not None and wanted > MAX_DEPTH:
        raise ValueError(f"max_depth {wanted} is beyond {MAX_DEPTH}, the deepest tree there is")
    return MAX_DEPTH if wanted is None else wanted


def _gathered(train: DataFrame) -> DataFrame:
    """At most one part a core: every part of a forest's pass returns the histograms of all nodes."""
    return train.coalesce(train.sparkSession.sparkContext.defaultParallelism)


def rf_regressor(
    train: DataFrame, n_estimators: int = 100, max_depth: int | None = 10, seed: int = SEED
) -> Model:
    return RandomForestRegressor(
        numTrees=n_estimators,
        maxDepth=_depth(max_depth),
        featureSubsetStrategy="all",
        maxMemoryInMB=TREE_MEMORY_MB,
        seed=seed,
    ).fit(_gathered(train))


def gbt_regressor(
    train: DataFrame,
    n_estimators: int = 100,
    max_depth: int = 6,
    learning_rate: float = 0.1,
    validation: str | None = None,
    seed: int = SEED,
) -> Model:
    """Boosted trees; ``validation`` names a boolean column of rows that stop the boosting."""
    trees = GBTRegressor(maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, seed=seed)
    return (trees.setValidationIndicatorCol(validation) if validation else trees).fit(train)


def logistic(train: DataFrame, C: float = 1.0, max_iter: int = 1000) -> Model:  # noqa: N803
    """Log loss summed over rows times C plus half the squared weights."""
    rows = train.count()
    return LogisticRegression(
        regParam=1.0 / (C * max(rows, 1)), elasticNetParam=0.0, maxIter=max_iter, standardization=False
    ).fit(train)


def rf_classifier(
    train: DataFrame,
    n_estimators: int = 100,
    max_depth: int = 10,
    min_samples_leaf: int = 2,
    seed: int = SEED,
) -> Model:
    return RandomForestClassifier(
        numTrees=n_estimators,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=TREE_MEMORY_MB,
        seed=seed,
    ).fit(_gathered(train))


def gbt_classifier(
    train: DataFrame,
    n_estimators: int = 100,
    max_depth: int = 6,
    learning_rate: float = 0.1,
    subsample: float = 0.8,
    colsample: float = 0.8,
    validation: str | None = None,
    seed: int = SEED,
) -> Model:
    trees = GBTClassifier(
        maxIter=n_estimators,
        maxDepth=max_depth,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(colsample),
        seed=seed,
    )
    return (trees.setValidationIndicatorCol(validation) if validation else trees).fit(train)


def mlp(
    train: DataFrame,
    hidden_layer_sizes: tuple[int, ...] = (100, 50),
    max_iter: int = 500,
    classes: int = 2,
    seed: int = SEED,
) -> Model:
    """A feed-forward net with rectified units: mini-batch Adam, stopped by held-out rows."""
    return fit_net(train, hidden_layer_sizes, classes, max_iter, seed).model


REGRESSORS: dict[str, Callable[..., Model]] = {
    "LinearRegression": linear,
    "Ridge": ridge,
    "Lasso": lasso,
    "RandomForestRegressor": rf_regressor,
    "GBTRegressor": gbt_regressor,
}
CLASSIFIERS: dict[str, Callable[..., Model]] = {
    "LogisticRegression": logistic,
    "RandomForestClassifier": rf_classifier,
    "GBTClassifier": gbt_classifier,
    "MLPClassifier": mlp,
}


def predict(model: Model, df: DataFrame, name: str) -> DataFrame:
    """(model, label, prediction, score); the score is the probability of class 1, if any."""
    out = model.transform(df)
    score = F.lit(None).cast("double")
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    return out.select(
        F.lit(name).alias("model"),
        F.col("label").cast("double").alias("label"),
        F.col("prediction").cast("double").alias("prediction"),
        score.alias("score"),
    )


IMPORTANCE = "model string, feature string, importance double"


def importance(spark: SparkSession, model: Model, columns: list[str], name: str) -> DataFrame:
    """(model, feature, importance): tree importances or absolute coefficients.

    A model of neither kind gives no rows. The vector has one entry per feature.
    """
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        weights = np.abs(model.coefficients.toArray())
    else:
        weights = []
    rows = [(name, c, float(w)) for c, w in zip(columns, weights, strict=False)]
    return spark.createDataFrame(rows, IMPORTANCE)


def coefficients(spark: SparkSession, model: Model, columns: list[str], name: str) -> DataFrame:
    """(model, term, value) of a linear model, the intercept included."""
    rows = [(name, c, float(w)) for c, w in zip(columns, model.coefficients.toArray(), strict=True)]
    rows.append((name, "(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "model string, term string, value double")

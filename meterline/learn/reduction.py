"""Principal components and linear discriminants."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VARIANCE = 0.95


@dataclass(frozen=True)
class Components:
    model: Model
    count: int
    columns: list[str]


def pca(
    df: DataFrame, columns: Sequence[str], count: int | None = None, variance: float = VARIANCE
) -> Components:
    """All components from one pass; ``count`` of them, or enough for the share of variance."""
    model = PCA(k=len(columns), inputCol="features", outputCol="components").fit(df)
    if count is None:
        reached = np.cumsum(model.explainedVariance.toArray())
        count = min(int(np.searchsorted(reached, variance, side="right")) + 1, len(columns))
    return Components(model, count, list(columns))


def explained_variance(spark: SparkSession, found: Components) -> DataFrame:
    """(component, ratio, cumulative, kept)."""
    ratios = found.model.explainedVariance.toArray()
    rows = [
        (i + 1, float(r), float(c), i < found.count)
        for i, (r, c) in enumerate(zip(ratios, np.cumsum(ratios), strict=True))
    ]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double, kept boolean")


def reduction_metrics(spark: SparkSession, ratios: Sequence[float]) -> DataFrame:
    """Number of components and the variance they explain; the first two where there are two."""
    rows = [("n_components", float(len(ratios))), ("total_variance_explained", float(sum(ratios)))]
    if len(ratios) >= 2:
        rows += [
            ("first_component_variance", float(ratios[0])),
            ("second_component_variance", float(ratios[1])),
        ]
    return spark.createDataFrame(rows, "metric string, value double")


def project(found: Components, df: DataFrame, key: Sequence[str], dimensions: int | None = None) -> DataFrame:
    """Key columns and PC1..PCk; two or three dimensions give the data of a scatter plot."""
    dimensions = dimensions or found.count
    values = vector_to_array("components")
    return found.model.transform(df).select(
        *key, *[values[i].alias(f"PC{i + 1}") for i in range(dimensions)]
    )


def loadings(spark: SparkSession, found: Components) -> DataFrame:
    """(component, feature, loading)."""
    matrix = found.model.pc.toArray()
    rows = [
        (j + 1, c, float(matrix[i, j]))
        for j in range(found.count)
        for i, c in enumerate(found.columns)
    ]
    return spark.createDataFrame(rows, "component int, feature string, loading double")


def top_features(table: DataFrame, n: int = 5) -> DataFrame:
    """The n features with the largest absolute loading per component."""
    by = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "feature")
    ranked = table.withColumn("feature_rank", F.row_number().over(by))
    return ranked.filter(F.col("feature_rank") <= n)


@dataclass(frozen=True)
class Discriminant:
    """A fitted linear discriminant: projection, class scores and variance ratios."""

    classes: list
    centre: np.ndarray
    projection: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    ratios: np.ndarray
    count: int


_MOMENTS = "label double, n double, sums array<double>, products array<double>"


#: Classes of one discriminant; each brings 1 + d + d * d numbers to the driver.
MAX_CLASSES = 1000


def _class_moments(
    df: DataFrame, width: int, shift: np.ndarray
) -> dict[float, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sums and products per class: one partial row per task and class, summed by position.

    ``shift`` is taken off every row first, so that large values don't drown their differences.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[float, list] = {}
        for batch in batches:
            for label, rows in batch.groupby("label"):
                x = np.stack(rows["x"].to_numpy()) - shift
                entry = state.setdefault(float(label), [0.0, np.zeros(width), np.zeros((width, width))])
                entry[0] += len(x)
                entry[1] += x.sum(axis=0)
                entry[2] += x.T @ x
        if state:
            yield pd.DataFrame(
                [(k, n, s, p.ravel()) for k, (n, s, p) in state.items()],
                columns=["label", "n", "sums", "products"],
            )

    parts = df.select(F.col("label").cast("double"), vector_to_array("features").alias("x")).mapInPandas(
        partial, _MOMENTS
    )
    cells = parts.select(
        "label", F.posexplode(F.concat(F.array("n"), "sums", "products")).alias("at", "value")
    )
    totals = cells.groupBy("label", "at").agg(F.sum("value").alias("value"))
    flat: dict[float, np.ndarray] = {}
    if totals.where("at = 0").limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: the label looks like a measurement")
    # classes times (1 + d + d * d) numbers
    for r in totals.collect():
        flat.setdefault(r["label"], np.zeros(1 + width + width * width))[r["at"]] = r["value"]
    return {
        k: (v[0], v[1 : 1 + width], v[1 + width :].reshape(width, width))
        for k, v in sorted(flat.items())
    }


def linear_discriminant(df: DataFrame, width: int, count: int | None = None) -> Discriminant:
    """Fit on (label, features), which are standardised here; constant directions are left out."""
    some = df.select(vector_to_array("features").alias("x")).first()
    shift = np.array(some["x"]) if some else np.zeros(width)
    moments = _class_moments(df, width, shift)
    sizes = np.array([m[0] for m in moments.values()])
    means = np.array([m[1] / m[0] for m in moments.values()])
    total, classes = sizes.sum(), len(moments)
    within = sum(m[2] - np.outer(m[1], m[1]) / m[0] for m in moments.values()) / (total - classes)
    centre = (sizes[:, None] * means).sum(axis=0) / total
    apart = sum(n * np.outer(m - centre, m - centre) for n, m in zip(sizes, means, strict=True))
    spread = np.sqrt(np.maximum(np.diag(within) * (total - classes) + np.diag(apart), 0) / total)
    # a constant column is left out by an endless unit
    unit = np.where(spread > 1e-12 * (1 + np.abs(centre)), spread, np.inf)
    within = within / np.outer(unit, unit)
    values, vectors = np.linalg.eigh((within + within.T) / 2)
    solid = values > 1e-10 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid]) / unit[:, None]
    between = np.sqrt(sizes / total)[:, None] * ((means - centre) @ whiten)
    _, strength, directions = np.linalg.svd(between, full_matrices=False)
    rank = int((strength > 1e-10 * strength[0]).sum()) if len(strength) else 0
    projection = whiten @ directions[:rank].T
    placed = (means - centre) @ projection
    ratios = strength[:rank] ** 2 / (strength[:rank] ** 2).sum()
    limit = min(count or classes - 1, rank)
    return Discriminant(
        classes=list(moments),
        centre=centre + shift,
        projection=projection[:, :limit],
        weights=projection @ placed.T,
        offsets=np.log(sizes / total) - 0.5 * (placed**2).sum(axis=1),
        ratios=ratios[:limit],
        count=limit,
    )


def _dot(weights: np.ndarray, shift: float, source: str = "x") -> str:
    terms = [f"{source}[{i}] * CAST('{float(w)!r}' AS DOUBLE)" for i, w in enumerate(weights)]
    return " + ".join([*terms, f"CAST('{float(shift)!r}' AS DOUBLE)"])


def discriminate(found: Discriminant, df: DataFrame) -> DataFrame:
    """Add LD1..LDk and ``prediction``, the class with the highest score."""
    outputs = {
        f"LD{j + 1}": _dot(found.projection[:, j], -found.centre @ found.projection[:, j])
        for j in range(found.count)
    }
    scores = [
        _dot(found.weights[:, k], found.offsets[k] - found.centre @ found.weights[:, k])
        for k in range(len(found.classes))
    ]
    labels = "array(" + ", ".join(f"CAST('{c!r}' AS DOUBLE)" for c in found.classes) + ")"
    with_scores = df.withColumn("x", vector_to_array("features")).withColumns(
        {**{n: F.expr(t) for n, t in outputs.items()}, "_scores": F.expr(f"array({', '.join(scores)})")}
    )
    best = F.expr(f"element_at({labels}, CAST(array_position(_scores, array_max(_scores)) AS INT))")
    return with_scores.withColumn("prediction", best).drop("_scores", "x")


def accuracy(df: DataFrame) -> DataFrame:
    right = F.count_if(F.col("label") == F.col("prediction"))
    return df.agg(F.try_divide(right.cast("double"), F.count("*")).alias("classification_accuracy"))

"""Clustering: models, quality measures, profiles and the choice of k."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import number_literal, quoted
from meterline.learn import lloyd
from meterline.learn import mixture as mixtures
from meterline.learn.lloyd import Centres, fit_many
from meterline.learn.prep import SEED


def kmeans(df: DataFrame, k: int = 8, restarts: int = 10, max_iter: int = 300, seed: int = SEED) -> Centres:
    """Best of several starts by the sum of squared distances, all in the same passes."""
    return fit_many(df, [k], restarts, max_iter, seed=seed)[k]


def gaussian_mixture(
    df: DataFrame, k: int = 8, max_iter: int = 100, seed: int = SEED
) -> mixtures.Mixture:
    return mixtures.fit_many(df, [k], max_iter, seed)[k]


def mixture_criteria(model: mixtures.Mixture, rows: int) -> dict[str, float]:
    """BIC and AIC of a full-covariance mixture."""
    k, d = model.means.shape
    free = (k - 1) + k * d + k * d * (d + 1) / 2
    fit = model.summary.logLikelihood
    return {"bic": free * math.log(rows) - 2 * fit, "aic": 2 * free - 2 * fit}


def assign(model: mixtures.Mixture | Centres, df: DataFrame) -> DataFrame:
    """Add ``cluster``; a mixture also leaves ``probability``."""
    return model.transform(df).withColumnRenamed("prediction", "cluster")


def silhouette_sq(labelled: DataFrame) -> float | None:
    """Silhouette with squared Euclidean distance, at a cost linear in the rows."""
    if labelled.select("cluster").distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(
        labelled.select("features", "cluster")
    )


SEPARATION = "clusters int, davies_bouldin_score double, calinski_harabasz_score double"


def separation(df: DataFrame, columns: Sequence[str], label: str = "cluster") -> DataFrame:
    """Davies-Bouldin and Calinski-Harabasz scores of labelled rows.

    Two passes: centres and sizes per cluster, then distances to the own centre. The driver sees
    one row per cluster, never the data.
    """
    spark = df.sparkSession
    centres = df.groupBy(label).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    )
    squares = " + ".join(f"pow({quoted(c)} - m{i}, 2)" for i, c in enumerate(columns))
    spread = (
        df.join(F.broadcast(centres), label)  # one row per cluster
        .withColumn("_sq", F.expr(squares))
        .groupBy(label)
        .agg(
            F.first("n").alias("n"),
            F.avg(F.sqrt("_sq")).alias("scatter"),
            F.sum("_sq").alias("within"),
            *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(columns))],
        )
    )
    groups = [(r["n"], r["scatter"], r["within"], [r[f"m{i}"] for i in range(len(columns))]) for r in spread.collect()]
    if len(groups) < 2:
        return spark.createDataFrame([(len(groups), None, None)], SEPARATION)
    worst = []
    for i, (_, s, _, m) in enumerate(groups):
        ratios = [
            (s + t) / distance if (distance := math.dist(m, q)) else math.inf
            for j, (_, t, _, q) in enumerate(groups)
            if i != j
        ]
        worst.append(max(ratios))
    rows = sum(g[0] for g in groups)
    middle = [sum(g[0] * g[3][i] for g in groups) / rows for i in range(len(columns))]
    between = sum(g[0] * math.dist(g[3], middle) ** 2 for g in groups)
    within = sum(g[2] for g in groups)
    ch = between * (rows - len(groups)) / (within * (len(groups) - 1)) if within else 1.0
    return spark.createDataFrame([(len(groups), sum(worst) / len(worst), ch)], SEPARATION)


def elbow(df: DataFrame, ks: Sequence[int] = range(2, 11), mixture: bool = False, restarts: int = 10) -> DataFrame:
    """(k, cost): inertia of k-means or BIC of a mixture. The table should be kept in memory."""
    if mixture:
        total = df.count()
        found = mixtures.fit_many(df, list(ks))
        costs = {k: mixture_criteria(model, total)["bic"] for k, model in found.items()}
    else:
        costs = {k: found.cost for k, found in fit_many(df, list(ks), restarts).items()}
    rows = [(k, float(cost)) for k, cost in costs.items()]
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def silhouette_scan(df: DataFrame, ks: Sequence[int] = range(2, 11), restarts: int = 10) -> DataFrame:
    """(k, silhouette_sq) of the best k-means for each k, scored together over the rows that were fitted."""
    with lloyd.ready(df) as (weighted, blocks):
        scores = lloyd.silhouettes(blocks, lloyd.fit_ready(weighted, blocks, list(ks), restarts))
    rows = [(k, scores[k]) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette_sq double")


def cluster_profile(df: DataFrame, columns: Sequence[str], label: str = "cluster") -> DataFrame:
    """Mean of every column, size and share per cluster."""
    sizes = df.groupBy(label).agg(
        *[F.avg(c).alias(c) for c in columns], F.count("*").alias("cluster_size")
    )
    total = sizes.agg(F.sum("cluster_size")).scalar()
    return sizes.withColumn("share", F.col("cluster_size") / total)


def centers(
    df: DataFrame, model: mixtures.Mixture | Centres, columns: Sequence[str], scales: dict[str, tuple[float, float]]
) -> DataFrame:
    """(cluster, column, value): centres or component means in the original units."""
    found = (
        [g.mean.toArray() for g in model.gaussians]
        if hasattr(model, "gaussians")
        else model.clusterCenters()
    )
    rows = [
        (i, c, float(v) * scales[c][1] + scales[c][0])
        for i, centre in enumerate(found)
        for c, v in zip(columns, centre, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "cluster int, column_name string, value double")


def soft_assign(model: mixtures.Mixture, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, component, probability) for every row."""
    parts = F.posexplode(vector_to_array("probability")).alias("component", "probability")
    return model.transform(df).select(*key, parts)


def nearest_center(df: DataFrame, columns: Sequence[str], points: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster``, the index of the closest of some given points."""
    distances = [
        " + ".join(f"pow({quoted(c)} - {number_literal(v)}, 2)" for c, v in zip(columns, p, strict=True))
        for p in points
    ]
    array = f"array({', '.join(distances)})"
    return df.withColumn("cluster", F.expr(f"array_position({array}, array_min({array})) - 1").cast("int"))

"""Training of model families on one shared split, with a run record per model."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.learn import clusters, evaluation, models, moments, prep, reduction
from meterline.learn.stages import scaled_pipeline
from meterline.tracking.runs import log_run, training_report
from meterline.tracking.scoring import save_model

log = logging.getLogger(__name__)

SPLIT_KEY = "split_key"
STOPPED_BY_VALIDATION = ("GBTRegressor", "GBTClassifier")


@dataclass(frozen=True)
class Target:
    """Where runs are recorded and models saved."""

    runs_table: str
    model_folder: str
    experiment: str
    runs_path: str | None = None


def _record(spark, where: Target, family: str, name: str, started, metrics, params, model):
    run_id = uuid.uuid4().hex
    path = f"{where.model_folder.rstrip('/')}/{run_id}"
    save_model(model, path)
    log_run(
        spark,
        where.runs_table,
        where.experiment,
        run_id,
        name,
        started,
        dt.datetime.now(),
        metrics,
        params,
        model_type=family,
        model_path=path,
        path=where.runs_path,
    )
    return run_id


def train_family(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    key: str,
    family: str,
    where: Target,
    trainers: Mapping[str, dict] | None = None,
) -> tuple[list[str], dict[str, str]]:
    """Train the models of a supervised family on (df, target).

    Returns the run ids and the models that failed with the reason; one failure does not stop
    the others. Medians come from the training rows. The linear regressors share one pass of moments;
    boosted trees stop by the validation rows. Runs record test metrics and, as ``val_*``, those of the
    validation rows.
    """
    known = models.REGRESSORS if family == "regression" else models.CLASSIFIERS
    metrics_of = evaluation.regression_metrics if family == "regression" else evaluation.binary_metrics
    columns = prep.select_numeric(df, target, [c for c in df.columns if c not in (key, target)])
    parted = prep.assign_split(df, [key])
    parts, filled = moments.complete_moments(parted, columns, target)
    ready = prep.assemble(filled.withColumn("label", F.col(target).cast("double")), columns)
    ready = ready.select("label", "features", "split", *columns)
    runs, failed = [], {}
    with prep.dealt(ready) as rows:
        seen = rows.filter("split <> 'test'").withColumn("validation", F.col("split") == "val")
        for name, params in (trainers or dict.fromkeys(known, {})).items():
            started = dt.datetime.now()
            try:
                if family == "regression" and name in moments.SOLVERS:
                    fit = moments.SOLVERS[name](parts["train"], columns, **params)
                    model, pipeline = fit.scorer(), fit.pipeline()
                else:
                    stops = name in STOPPED_BY_VALIDATION
                    train = seen if stops else rows.filter("split = 'train'")
                    own = {"validation": "validation", **params} if stops else params
                    fitted = models.Trained(name, family, known[name](train, **own), columns)
                    model, pipeline = fitted.model, fitted.pipeline()
                metrics = {}
                for split, prefix in (("test", ""), ("val", "val_")):
                    part = rows.filter(F.col("split") == split)
                    found = metrics_of(models.predict(model, part, name)).first().asDict()
                    metrics |= {f"{prefix}{k}": v for k, v in found.items()}
                runs.append(_record(spark, where, family, name, started, metrics, params, pipeline))
            except Exception as error:
                log.exception("training %s failed", name)
                failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    return runs, failed


def _each(spark, where: Target, family: str, fits: Mapping) -> tuple[list[str], dict[str, str]]:
    """Run the fits, each returning (metrics, parameters, pipeline); a failing one is listed."""
    runs, failed = [], {}
    for name, fit in fits.items():
        started = dt.datetime.now()
        try:
            runs.append(_record(spark, where, family, name, started, *fit()))
        except Exception as error:
            log.exception("training %s failed", name)
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    return runs, failed


def train_clusters(spark: SparkSession, df: DataFrame, where: Target, k: int = 5, restarts: int = 10):
    """Train k-means and a Gaussian mixture on standardised columns."""
    rows = prep.cluster_set(df)
    scales = prep.fit_scales(rows, rows.columns)
    ready = prep.assemble(prep.standardise(rows, scales), rows.columns)
    with prep.held(ready) as held:

        def measured(model):
            labelled = clusters.assign(model, held)
            found = clusters.separation(labelled, rows.columns).drop("clusters").first().asDict()
            return found | {"silhouette_sq": clusters.silhouette_sq(labelled)}

        def means():
            model = clusters.kmeans(held, k, restarts)
            metrics = measured(model) | {"inertia": model.cost}
            return metrics, {"n_clusters": k}, scaled_pipeline(model, rows.columns, scales)

        def mixture():
            model = clusters.gaussian_mixture(held, k)
            metrics = measured(model) | clusters.mixture_criteria(model, held.count())
            return metrics, {"n_components": k}, scaled_pipeline(model, rows.columns, scales)

        return _each(spark, where, "clustering", {"KMeans": means, "GaussianMixture": mixture})


def train_reductions(spark: SparkSession, df: DataFrame, where: Target):
    """Principal components, and the discriminant between high and low tips."""
    rows = prep.cluster_set(df)

    def metrics_of(table: DataFrame) -> dict[str, float]:
        return {r["metric"]: r["value"] for r in table.collect()}

    def components():
        scales = prep.fit_scales(rows, rows.columns)
        ready = prep.assemble(prep.standardise(rows, scales), rows.columns)
        found = reduction.pca(ready, rows.columns)
        ratios = found.model.explainedVariance.toArray()[: found.count]
        metrics = metrics_of(reduction.reduction_metrics(spark, ratios))
        return metrics, {}, scaled_pipeline(found, rows.columns, scales)

    def discriminants():
        tips = prep.tip_label(df)
        names = prep.select_numeric(tips, "high_tip")
        scales = prep.fit_scales(tips, names)
        scaled = prep.standardise(tips, scales)
        labelled = prep.assemble(scaled.withColumn("label", F.col("high_tip").cast("double")), names)
        found = reduction.linear_discriminant(labelled, len(names), 1)
        right = reduction.accuracy(reduction.discriminate(found, labelled)).first()
        metrics = metrics_of(reduction.reduction_metrics(spark, found.ratios)) | right.asDict()
        return metrics, {}, scaled_pipeline(found, names, scales)

    return _each(spark, where, "dim_reduction", {"PCA": components, "LDA": discriminants})


def run_all(
    spark: SparkSession,
    trips: DataFrame,
    where: Target,
    key: str = "trip_id",
    trainers: Mapping[str, Mapping[str, dict]] | None = None,
    clusters_k: int = 5,
    restarts: int = 10,
) -> tuple[DataFrame, dict[str, str]]:
    """All families over one table of trips: the training report, and what failed with the reason.

    ``trainers`` gives the models and parameters of a supervised family; the default is all of them.
    """
    given, failed = trainers or {}, {}
    keyed = trips.withColumn(SPLIT_KEY, F.col(key).cast("string"))  # a text key is no feature
    for family, table, target in (
        ("regression", prep.regression_set(keyed), "fare_amount"),
        ("classification", prep.tip_label(keyed), "high_tip"),
    ):
        own = given.get(family)
        failed |= train_family(spark, table, target, SPLIT_KEY, family, where, own)[1]
    failed |= train_clusters(spark, trips, where, clusters_k, restarts)[1]
    failed |= train_reductions(spark, trips, where)[1]
    return training_report(spark.table(where.runs_table)), failed

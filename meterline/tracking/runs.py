"""Runs, registered models and their comparison, as tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline import schemas
from meterline.sources.tables import write_table

# Metrics for which less is better, and the classes of the spread in percent.
LOWER_IS_BETTER = ("rmse", "mae", "mse", "mape", "loss", "error", "davies_bouldin_score")
SIMILAR_BELOW, MODERATE_BELOW = 5.0, 20.0
VARIATION_LIMIT = 0.2

HINTS = {
    "ensemble": "High Performance Variation: combine models in an ensemble",
    "boosting": "Tree-based Models: try gradient boosting libraries",
    "tuning": "Hyperparameter Optimization: search systematically",
    "features": "Feature Engineering: try polynomial, interaction or domain features",
    "validation": "Cross-Validation: estimate performance with stratified folds",
    "monitoring": "Model Monitoring: detect drift and retrain periodically",
}


def lower_is_better(metric: Column) -> Column:
    return F.lower(metric).isin(*LOWER_IS_BETTER)


def log_run(
    spark: SparkSession,
    table: str,
    experiment: str,
    run_id: str,
    run_name: str,
    start_time: dt.datetime,
    end_time: dt.datetime | None,
    metrics: Mapping[str, float | None],
    params: Mapping[str, object] = (),
    tags: Mapping[str, str] = (),
    model_type: str | None = None,
    model_path: str | None = None,
    status: str = "FINISHED",
    path: str | None = None,
) -> None:
    """Append one run record; null metrics are left out."""
    row = (
        experiment,
        run_id,
        run_name,
        model_type,
        model_path,
        status,
        start_time,
        end_time,
        {k: float(v) for k, v in metrics.items() if v is not None},
        {k: str(v) for k, v in dict(params).items()},
        dict(tags),
    )
    write_table(spark.createDataFrame([row], schemas.RUNS), table, "append", path=path)


def latest_runs(runs: DataFrame, experiment: str, n: int = 5) -> DataFrame:
    """Newest runs of an experiment, without null metrics."""
    known = F.map_filter("metrics", lambda _, v: v.isNotNull())
    return (
        runs.filter(F.col("experiment_name") == experiment)
        .orderBy(F.col("start_time").desc(), "run_id")
        .limit(n)
        .withColumn("metrics", known)
    )


def best_run(
    runs: DataFrame, experiment: str, metric: str = "rmse", mode: str = "min", positive_only: bool = True
) -> DataFrame:
    """The run with the least or greatest value of a metric; no row when none has it."""
    value = F.col("metrics")[metric]
    found = runs.filter((F.col("experiment_name") == experiment) & value.isNotNull())
    if positive_only:
        found = found.filter(value > 0)
    order = value.asc() if mode == "min" else value.desc()
    return found.orderBy(order, "run_id").limit(1)


def registered_versions(registry: DataFrame) -> DataFrame:
    """Latest version per model and stage over (name, stage, version, run_id, description)."""
    latest = F.max_by(F.struct("version", "run_id", "description"), "version").alias("latest")
    return registry.groupBy("name", "stage").agg(latest).select("name", "stage", "latest.*")


def run_metrics(runs: DataFrame) -> DataFrame:
    """(run_id, metric, value), null values left out."""
    return runs.select("run_id", F.explode("metrics").alias("metric", "value")).filter(
        F.col("value").isNotNull()
    )


def run_params(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", F.explode("params").alias("param", "value")).filter(
        F.col("value").isNotNull()
    )


def compare_runs(
    runs: DataFrame, experiment: str, metric: str = "rmse", max_models: int = 10
) -> DataFrame:
    """Newest runs side by side, a column per metric and parameter, best first."""
    latest = latest_runs(runs, experiment, max_models)
    # names of at most max_models runs
    names = latest.select(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("metrics"))))).alias("m"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("params"))))).alias("p"),
    ).first()
    wide = latest.select(
        "run_id",
        "run_name",
        "start_time",
        *[F.col("metrics")[m].alias(f"metric_{m}") for m in names["m"]],
        *[F.col("params")[p].alias(f"param_{p}") for p in names["p"]],
    )
    if metric not in names["m"]:
        return wide
    main = F.col(f"metric_{metric}")
    lower = metric.lower() in LOWER_IS_BETTER
    return wide.orderBy(main.asc_nulls_last() if lower else main.desc_nulls_last(), "run_id")


def metric_spread(runs: DataFrame) -> DataFrame:
    """Best, worst, mean, std and spread in percent per metric, with its class."""
    per_metric = (
        run_metrics(runs)
        .groupBy("metric")
        .agg(
            F.count("*").alias("runs"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
        )
    )
    lower = lower_is_better(F.col("metric"))
    spread = F.try_divide(F.col("high") - F.col("low"), F.col("mean")) * 100
    return per_metric.select(
        "metric",
        "runs",
        F.when(lower, F.col("low")).otherwise(F.col("high")).alias("best"),
        F.when(lower, F.col("high")).otherwise(F.col("low")).alias("worst"),
        "mean",
        "std",
        spread.alias("spread_percent"),
        F.when(spread < SIMILAR_BELOW, "similar")
        .when(spread < MODERATE_BELOW, "moderate")
        .otherwise("high")
        .alias("consistency"),
    )


def param_usage(runs: DataFrame) -> DataFrame:
    """Values of the parameters that differ between runs, with the range if all are numbers."""
    counts = run_params(runs).groupBy("param", "value").agg(F.count("*").alias("runs"))
    number = F.expr("try_cast(value AS DOUBLE)")
    # one row per parameter name
    facts = counts.groupBy("param").agg(
        F.count("*").alias("values"),
        F.when(F.count_if(number.isNull()) == 0, F.min(number)).alias("range_low"),
        F.when(F.count_if(number.isNull()) == 0, F.max(number)).alias("range_high"),
    )
    return counts.join(facts.filter("values > 1").drop("values"), "param")


def champion_challenger(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Metric by metric comparison for every (champion_id, challenger_id) pair of runs.

    A metric that only one run has is listed without a winner; ties go to the champion.
    """
    metrics = run_metrics(runs)
    sides = [
        pairs.join(metrics, F.col(f"{side}_id") == F.col("run_id")).select(
            "champion_id", "challenger_id", "metric", F.col("value").alias(side)
        )
        for side in ("champion", "challenger")
    ]
    both = sides[0].join(sides[1], ["champion_id", "challenger_id", "metric"], "full")
    diff = F.col("challenger") - F.col("champion")
    better = F.when(lower_is_better(F.col("metric")), diff < 0).otherwise(diff > 0)
    return both.select(
        "champion_id",
        "challenger_id",
        "metric",
        "champion",
        "challenger",
        diff.alias("difference"),
        F.when(diff.isNotNull(), F.coalesce(F.try_divide(diff, F.col("champion")) * 100, F.lit(0.0))).alias(
            "difference_percent"
        ),
        F.when(better, "challenger").when(diff.isNotNull(), "champion").alias("winner"),
    )


def champion_verdict(comparison: DataFrame) -> DataFrame:
    """promote, keep or tie per pair, by the number of metrics won."""
    wins = comparison.groupBy("champion_id", "challenger_id").agg(
        F.count_if(F.col("winner") == "champion").alias("champion_wins"),
        F.count_if(F.col("winner") == "challenger").alias("challenger_wins"),
    )
    a, b = F.col("champion_wins"), F.col("challenger_wins")
    return wins.withColumn(
        "verdict", F.when(b > a, "promote").when(a > b, "keep").otherwise("tie")
    ).withColumn("win_rate", F.when(a != b, F.greatest(a, b) * 100.0 / (a + b)))


def param_differences(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Parameters of both runs of each pair side by side."""
    params = run_params(runs)
    sides = [
        pairs.join(params, F.col(f"{side}_id") == F.col("run_id")).select(
            "champion_id", "challenger_id", "param", F.col("value").alias(side)
        )
        for side in ("champion", "challenger")
    ]
    return sides[0].join(sides[1], ["champion_id", "challenger_id", "param"], "full")


def training_report(runs: DataFrame) -> DataFrame:
    """(model_type, run_name, metric, value): the metrics each family reports; null when absent."""
    wanted = {
        "regression": ("mae", "rmse", "r2"),
        "classification": ("accuracy", "precision", "recall", "f1_score", "roc_auc"),
        "clustering": ("silhouette_sq", "davies_bouldin_score", "calinski_harabasz_score"),
        "dim_reduction": ("n_components", "total_variance_explained"),
    }
    names = F.lit(None).cast("array<string>")
    for family, metrics in wanted.items():
        names = F.when(
            F.col("model_type") == family, F.array(*[F.lit(m) for m in metrics])
        ).otherwise(names)
    rows = runs.select("model_type", "run_id", "run_name", "metrics", F.explode(names).alias("metric"))
    return rows.select(
        "model_type", "run_id", "run_name", "metric", F.col("metrics")[F.col("metric")].alias("value")
    )


def improvement_hints(runs: DataFrame, primary: str) -> DataFrame:
    """(hint, text): variation of the primary metric, tree models, and the general advice."""
    value = F.col("metrics")[primary]
    facts = runs.agg(
        F.count(value).alias("n"),
        F.try_divide(F.stddev_samp(value), F.avg(value)).alias("cv"),
        F.bool_or(F.map_contains_key("params", "n_estimators")).alias("trees"),
    )
    conditions = {
        "ensemble": (F.col("n") > 1) & (F.col("cv") > VARIATION_LIMIT),
        "boosting": F.col("trees"),
    }
    rows = [
        F.when(
            conditions.get(hint, F.lit(True)),
            F.struct(F.lit(hint).alias("hint"), F.lit(text).alias("text")),
        )
        for hint, text in HINTS.items()
    ]
    return facts.select(F.inline(F.array_compact(F.array(*rows))))


def top_importance(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n most important features per run over (run_id, feature, importance)."""
    by = Window.partitionBy("run_id").orderBy(F.col("importance").desc(), "feature")
    ranked = importance.withColumn("importance_rank", F.row_number().over(by))
    return ranked.filter(F.col("importance_rank") <= n)


def compared_experiments(names: Sequence[str]) -> dict[str, str]:
    """The metric an experiment is judged by, from its name."""
    rules = {"Regression": "rmse", "Classification": "f1_score", "Clustering": "silhouette_score"}
    return {n: next((m for k, m in rules.items() if k in n), "rmse") for n in names}

"""Batch scoring: a table of trips in, a table of predictions out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.tracking.runs import best_run

# Accepted input ranges, both ends included; distance may be absent.
LIMITS = {
    "pickup_latitude": (-90, 90),
    "pickup_longitude": (-180, 180),
    "dropoff_latitude": (-90, 90),
    "dropoff_longitude": (-180, 180),
    "passenger_count": (1, 6),
    "hour": (0, 23),
    "day_of_week": (0, 6),
}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(
    runs: DataFrame,
    registry: DataFrame | None = None,
    run_id: str | None = None,
    name: str | None = None,
    stage: str = "Production",
) -> PipelineModel:
    """The model of a run, or of the latest version of a registered name and stage."""
    if run_id is None:
        latest = (
            registry.filter((F.col("name") == name) & (F.col("stage") == stage))
            .orderBy(F.col("version").desc())
            .select("run_id")
            .first()
        )
        if latest is None:
            raise LookupError(f"no version of {name!r} in stage {stage!r}")
        run_id = latest["run_id"]
    found = runs.filter(F.col("run_id") == run_id).select("model_path").first()
    if found is None or found["model_path"] is None:
        raise LookupError(f"run {run_id!r} has no model")
    return PipelineModel.load(found["model_path"])


def best_model(runs: DataFrame, experiment: str, metric: str = "rmse", mode: str = "min"):
    """(run_id, model) of the best run of an experiment."""
    best = best_run(runs, experiment, metric, mode).select("run_id").first()
    if best is None:
        raise LookupError(f"no run of {experiment!r} has {metric!r}")
    return best["run_id"], load_model(runs, run_id=best["run_id"])


def score_batch(model: PipelineModel, df: DataFrame, columns: Sequence[str], run_id: str) -> DataFrame:
    """Add prediction, probabilities, confidence and run id; an absent feature counts as 0."""
    ready = df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
            for c in columns
        }
    )
    out = model.transform(ready)
    if "probability" in out.columns:
        probabilities = vector_to_array("probability")
    else:
        probabilities = F.lit(None).cast(T.ArrayType(T.DoubleType()))
    return out.select(
        *df.columns,
        F.col("prediction").cast("double").alias("prediction"),
        probabilities.alias("probabilities"),
        F.array_max(probabilities).alias("confidence"),
        F.lit(run_id).alias("model_run_id"),
    )


def check_requests(df: DataFrame) -> DataFrame:
    """Add ``reason``: the first input outside its limits, null when the request is valid."""
    reason = F.lit(None).cast("string")
    if "distance_miles" in df.columns:
        reason = F.when(F.col("distance_miles") < 0, "distance_miles")
    for name, (low, high) in reversed(LIMITS.items()):
        inside = F.coalesce(F.col(name).between(low, high), F.lit(False))
        reason = F.when(~inside, name).otherwise(reason)
    return df.withColumn("reason", reason)


def score_fare(
    model: PipelineModel, df: DataFrame, columns: Sequence[str], run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Predictions of the valid requests, and the rejected requests with their reason."""
    checked = check_requests(df)
    valid = checked.filter(F.col("reason").isNull()).drop("reason")
    if "distance_miles" in df.columns:
        valid = valid.withColumn("trip_distance", F.col("distance_miles"))
    rejected = checked.filter(F.col("reason").isNotNull())
    return score_batch(model, valid, columns, run_id), rejected


def log_predictions(scored: DataFrame, model_id: int, features: Sequence[str], created_at) -> DataFrame:
    """Rows for the prediction log: the input as JSON and the prediction."""
    return scored.select(
        F.lit(model_id).cast("bigint").alias("model_id"),
        F.to_json(F.struct(*features)).alias("input_features"),
        "prediction",
        created_at.alias("created_at"),
    )


def named_predictions(log: DataFrame, registry: DataFrame) -> DataFrame:
    """The log with model name and type. Spark broadcasts the registry if its size allows."""
    models = registry.select(F.col("id").alias("model_id"), "model_name", "model_type")
    return log.join(models, "model_id")

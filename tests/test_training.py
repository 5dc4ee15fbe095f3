"""Training jobs: every family is recorded, saved, loaded again and scores as it did when fitted."""

import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from meterline.learn import clusters, prep, reduction, stages
from meterline.plans import training


@pytest.fixture(scope="module")
def trips(spark):
    rng = np.random.default_rng(11)
    n = 900
    distance = rng.gamma(2, 2, n)
    group = rng.integers(0, 3, n)
    rows = [
        (i, float(d), float(g * 10 + e), float(3 * d + e), float(t))
        for i, (d, g, e, t) in enumerate(
            zip(distance, group, rng.normal(size=n), distance + rng.normal(size=n), strict=True)
        )
    ]
    schema = "trip_id long, trip_distance double, zone double, fare_amount double, tip_amount double"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def target(tmp_path):
    return training.Target(
        f"runs_{uuid.uuid4().hex}", str(tmp_path / "models"), "Trips", str(tmp_path / "runs")
    )


FEW = {"n_estimators": 3, "max_depth": 2}
TRAINERS = {
    "regression": {
        "LinearRegression": {},
        "Ridge": {"alpha": 1.0},
        "Lasso": {"alpha": 0.1},
        "RandomForestRegressor": FEW,
        "GBTRegressor": FEW,
        "Unknown": {},
    },
    "classification": {
        "LogisticRegression": {},
        "RandomForestClassifier": FEW,
        "GBTClassifier": FEW,
        "MLPClassifier": {"max_iter": 3, "hidden_layer_sizes": (4,)},
    },
}


def test_all_families(spark, trips, tmp_path):
    where = target(tmp_path)
    report, failed = training.run_all(spark, trips, where, trainers=TRAINERS, clusters_k=3, restarts=2)
    assert list(failed) == ["Unknown"]
    found = {(r.model_type, r.run_name, r.metric): r.value for r in report.collect()}
    assert len({k[:2] for k in found}) == 13 and None not in found.values()
    assert found["regression", "LinearRegression", "r2"] > 0.9
    assert found["classification", "LogisticRegression", "roc_auc"] > 0.8
    runs = {r.run_name: r for r in spark.table(where.runs_table).collect()}
    assert {"val_rmse", "rmse"} <= set(runs["GBTRegressor"].metrics)
    assert {"bic", "aic"} <= set(runs["GaussianMixture"].metrics)
    for name, run in runs.items():  # one of each kind is loaded and scores a table
        model = PipelineModel.load(run.model_path)
        out = model.transform(trips.withColumn("high_tip", F.lit(0)))
        column = {"PCA": "components"}.get(name, "prediction")
        assert out.select(column).dropna().count() == 900, name


def test_saved_clusters_and_discriminants_predict_the_same(spark, trips, tmp_path):
    rows = prep.cluster_set(trips)
    scales = prep.fit_scales(rows, rows.columns)
    ready = prep.assemble(prep.standardise(rows, scales), rows.columns)
    named = trips.withColumn("label", F.floor(F.col("zone") / 10 + 0.5).cast("double"))
    keyed = prep.assemble(prep.standardise(named, scales), rows.columns)
    fits = {
        "means": (clusters.kmeans(ready, 3, 2), lambda m: m.transform(keyed)),
        "lines": (
            reduction.linear_discriminant(keyed, len(rows.columns)),
            lambda m: reduction.discriminate(m, keyed),
        ),
    }
    for name, (model, placed) in fits.items():
        path = str(tmp_path / name)
        stages.scaled_pipeline(model, rows.columns, scales).write().overwrite().save(path)
        loaded = PipelineModel.load(path).transform(trips)
        want = {r.trip_id: r.prediction for r in placed(model).select("trip_id", "prediction").collect()}
        got = {r.trip_id: r.prediction for r in loaded.select("trip_id", "prediction").collect()}
        assert got == want and len(set(got.values())) == 3

"""Null scores and names, infinite values, repeated keys, scales: each has a defined result."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from conftest import rows
from meterline.learn import evaluation, models, reduction
from meterline.operators import features, profile
from meterline.operators.ordered import running_totals


def scored(spark):
    data = [
        (None, 1, 1, 0.9),
        (None, 0, 0, 0.2),
        ("a", 1, 1, 0.8),
        ("a", 0, 1, 0.7),
        ("a", 1, 0, None),
    ]
    return spark.createDataFrame(data, "model string, label int, prediction int, score double")


def test_a_model_without_a_name_is_compared(spark):
    got = {r["model"]: r for r in evaluation.compare_classifiers(scored(spark)).collect()}
    assert set(got) == {None, "a"}
    assert got[None]["roc_auc"] == 1.0 and got[None]["unscored"] == 0
    assert got["a"]["roc_auc"] == 1.0 and got["a"]["unscored"] == 1


def test_roc_points_are_those_of_the_scores(spark):
    one = scored(spark).where("model = 'a'").drop("model")
    assert rows(evaluation.roc_points(one)) == [(0.7, 1.0, 1.0), (0.8, 0.0, 1.0)]
    rng = np.random.default_rng(2)
    score = np.round(rng.random(500), 4)
    label = (rng.random(500) < score).astype(int)
    frame = spark.createDataFrame([(int(y), float(s)) for y, s in zip(label, score, strict=True)], "label int, score double")
    for r in evaluation.roc_points(frame).collect():
        above = score >= r["threshold"]
        assert r["tpr"] == pytest.approx(label[above].sum() / label.sum())
        assert r["fpr"] == pytest.approx((1 - label)[above].sum() / (1 - label).sum())
    assert evaluation.roc_points(frame, bins=10).count() == 10


def test_running_totals_of_a_null_key(spark):
    frame = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("k", 1, 7)], "k string, o int, v int")
    assert rows(running_totals(frame, ["o"], ["v"], ["k"]), "k", "o", "v_running") == sorted(
        [(None, 1, 5), (None, 2, 11), ("k", 1, 7)], key=repr
    )


def test_infinite_values_get_bins_of_their_own(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10, "inf", "-inf")] + [(None,)], "x double")
    got = {r["bin"]: r["row_count"] for r in profile.histogram(frame, ["x"], 10).collect()}
    assert got == {0: 1, 1: 1, 9: 2, 10: 1, -1: 1}


def test_a_repeated_feature_gives_its_largest_value(spark):
    store = spark.createDataFrame(
        [(1, "f", 2.0, "v"), (1, "f", 5.0, "v"), (1, "g", None, "v")],
        "trip_id long, feature_name string, feature_value double, feature_version string",
    )
    assert rows(features.from_feature_store(store, "v", ["f", "g"])) == [(1, 5.0, None)]


def test_depth_beyond_the_deepest_tree_is_refused(spark):
    frame = None  # refused before the rows are looked at
    for train in (models.rf_regressor, models.rf_classifier):
        with pytest.raises(ValueError, match="deepest"):
            train(frame, max_depth=31)


def test_discriminant_finds_a_small_column_beside_a_large_one(spark):
    rng = np.random.default_rng(1)
    data = [
        (float(k % 2), Vectors.dense([1e9 + 1e7 * rng.normal(), 1e-4 * (k % 2) + 1e-6 * rng.normal(), 3.0]))
        for k in range(400)
    ]
    frame = spark.createDataFrame(data, ["label", "features"])
    found = reduction.linear_discriminant(frame, 3)
    right = reduction.accuracy(reduction.discriminate(found, frame)).first()[0]
    assert found.count == 1 and right == 1.0


def test_a_measurement_is_no_label(spark, monkeypatch):
    monkeypatch.setattr(reduction, "MAX_CLASSES", 5)
    frame = spark.createDataFrame([(float(k), Vectors.dense([1.0 * k])) for k in range(20)], ["label", "features"])
    with pytest.raises(ValueError, match="classes"):
        reduction.linear_discriminant(frame, 1)

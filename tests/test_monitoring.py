"""Drift, degradation, alternative limits and scales."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from meterline.operators import adjust, drift

DAY = dt.datetime(2024, 1, 1)


def plain_ks(a, b):
    """Largest gap between the two empirical distributions, and the limit distribution's tail."""
    a, b = np.sort(a), np.sort(b)
    at = np.concatenate([a, b])
    gap = np.abs(
        np.searchsorted(a, at, side="right") / len(a) - np.searchsorted(b, at, side="right") / len(b)
    ).max()
    s = math.sqrt(len(a) * len(b) / (len(a) + len(b))) * gap
    tail = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * s * s) for j in range(1, 101))
    return gap, min(1.0, max(0.0, tail)) if s >= 0.04 else 1.0


@pytest.fixture(scope="module")
def windows(spark):
    rng = np.random.default_rng(5)
    old = rng.normal(size=(300, 3))
    new = rng.normal(size=(200, 3)) + [0, 0.6, 0]
    old[:, 2], new[:, 2] = np.round(old[:, 2]), np.round(new[:, 2])  # many ties
    data = [(DAY + dt.timedelta(days=int(i % 30), hours=1), *map(float, r)) for i, r in enumerate(old)]
    data += [(DAY + dt.timedelta(days=30 + int(i % 30)), *map(float, r)) for i, r in enumerate(new)]
    schema = "ts timestamp_ntz, same double, moved double, ties double"
    return spark.createDataFrame(data, schema).repartition(5), old, new


def test_drift_equals_sorted_samples(windows):
    df, old, new = windows
    seen = drift.two_windows(df, "ts", DAY + dt.timedelta(days=60))
    found = {r["column_name"]: r for r in drift.drift_ks(seen).collect()}
    assert set(found) == {"same", "moved", "ties"}
    for i, c in enumerate(("same", "moved", "ties")):
        gap, p = plain_ks(old[:, i], new[:, i])
        assert (found[c]["reference_rows"], found[c]["current_rows"]) == (300, 200)
        assert found[c]["statistic"] == pytest.approx(gap, abs=1e-12)
        assert found[c]["p_value"] == pytest.approx(p, abs=1e-9)
        assert found[c]["drifted"] == (p < 0.05)
    assert found["moved"]["drifted"] and not found["same"]["drifted"]


def test_drift_of_missing_values_and_empty_windows(spark, windows):
    df, old, new = windows
    seen = drift.two_windows(df, "ts", DAY + dt.timedelta(days=60))
    holed = seen.withColumn("moved", F.when(F.col("moved") > 0, F.col("moved"))).withColumn(
        "same", F.when(F.col("same") > 0, F.col("same")).otherwise(float("nan"))
    )
    holed = holed.withColumn("none", F.lit(None).cast("double")).withColumn("fixed", F.lit(1))
    found = {r["column_name"]: r for r in drift.drift_ks(holed).collect()}
    for i, c in ((0, "same"), (1, "moved")):
        gap, p = plain_ks(old[old[:, i] > 0, i], new[new[:, i] > 0, i])
        assert found[c]["statistic"] == pytest.approx(gap, abs=1e-12)
        assert found[c]["reference_rows"] == (old[:, i] > 0).sum()
    none = found["none"]
    assert (none["reference_rows"], none["statistic"], none["drifted"]) == (0, None, False)
    assert (found["fixed"]["statistic"], found["fixed"]["p_value"]) == (0.0, 1.0)
    for part in (seen.where("in_reference"), seen.where("NOT in_reference"), seen.limit(0)):
        assert {r["p_value"] for r in drift.drift_ks(part).collect()} == {None}
    one_side = drift.drift_ks(seen.where("in_reference")).first()
    assert (one_side["reference_rows"], one_side["current_rows"]) == (300, 0)


def test_drift_without_a_single_task(spark, windows):
    df, _, _ = windows
    seen = drift.two_windows(df, "ts", DAY + dt.timedelta(days=60))
    text = drift.drift_ks(seen)._jdf.queryExecution().toString()
    assert "SinglePartition" not in text and "Python" not in text


def test_windows_are_half_open(spark):
    at = [DAY, DAY + dt.timedelta(days=30), DAY + dt.timedelta(days=60), None]
    df = spark.createDataFrame([(t,) for t in at], "ts timestamp_ntz")
    found = drift.two_windows(df, "ts", DAY + dt.timedelta(days=60))
    assert rows(found) == [(DAY, True), (DAY + dt.timedelta(days=30), False)]


def test_degradation_follows_the_direction(spark):
    data = [
        ("a", "m", DAY, {"rmse": 2.0, "r2": 0.8, "zero": 0.0, "gone": 1.0}),
        ("b", "m", DAY + dt.timedelta(days=1), {"rmse": 9.0, "r2": 0.1}),
        ("c", "m", DAY + dt.timedelta(days=2), {"rmse": 2.3, "r2": 0.75, "zero": 1.0}),
        ("d", "n", DAY, {"rmse": 1.0}),
    ]
    runs = spark.createDataFrame(
        data, "run_id string, run_name string, start_time timestamp_ntz, metrics map<string,double>"
    )
    found = {(r.run_name, r.metric): r for r in drift.degradation_alerts(runs).collect()}
    assert set(found) == {("m", "rmse"), ("m", "r2"), ("m", "zero"), ("n", "rmse")}
    assert found["m", "rmse"].alert and found["m", "rmse"].worse_share == pytest.approx(0.15)
    assert not found["m", "r2"].alert and found["m", "r2"].worse_share == pytest.approx(0.0625)
    assert found["m", "zero"].worse_share is None and not found["m", "zero"].alert
    assert found["n", "rmse"].worse_share == 0
    given = spark.createDataFrame([("m", "r2", 0.9)], "run_name string, metric string, baseline_value double")
    alone = drift.degradation_alerts(runs, given).collect()
    assert [(r.metric, r.alert) for r in alone] == [("r2", True)]


@pytest.fixture(scope="module")
def values(spark):
    data = [(i, float(i % 10), 5.0, "x" if i % 3 else None) for i in range(100)]
    data += [(100, 1000.0, 5.0, "x"), (101, None, 5.0, None), (102, float("nan"), None, "y")]
    return spark.createDataFrame(data, "id int, v double, `c.d` double, s string")


def test_zscores(values):
    known = np.array([float(i % 10) for i in range(100)] + [1000.0])
    found = {r["column_name"]: r for r in adjust.zscore_outliers(values, ["v", "c.d"]).collect()}
    assert found["v"]["outlier_count"] == 1 and found["v"]["total_rows"] == 103
    assert found["v"]["upper_bound"] == pytest.approx(known.mean() + 3 * known.std())
    assert found["c.d"]["outlier_count"] == 0
    assert adjust.zscore_outliers(values.limit(0), ["v"]).count() == 0


def test_removal_keeps_missing_values(values):
    for method in ("iqr", "zscore"):
        kept = adjust.remove_outliers(values, ["v"], method)
        assert {r["id"] for r in kept.collect()} == set(range(103)) - {100}
    with pytest.raises(ValueError):
        adjust.remove_outliers(values, ["v"], "other")
    assert adjust.remove_outliers(values.limit(0)).count() == 0


def test_flags_and_mean(values):
    flagged = adjust.flag_missing(values)
    assert set(flagged.columns) - set(values.columns) == {f"{c}_missing" for c in values.columns}
    assert [r["id"] for r in flagged.where("v_missing").orderBy("id").collect()] == [101, 102]
    assert flagged.where("s_missing").count() == 35
    filled = {r["id"]: r["v"] for r in adjust.impute_mean(values, ["v", "c.d"]).collect()}
    assert filled[101] == filled[102] == pytest.approx((450 + 1000) / 101)
    assert filled[3] == 3.0


def test_scales(values):
    scaled = {r["id"]: r for r in adjust.apply_scales(values, adjust.fit_minmax(values, ["v", "c.d"])).collect()}
    assert scaled[100]["v"] == 1.0 and scaled[0]["v"] == 0.0 and scaled[5]["c.d"] == 0.0
    assert scaled[101]["v"] is None and scaled[102]["v"] is None
    low, mid, high = np.percentile([float(i % 10) for i in range(100)] + [1000.0], [25, 50, 75])
    robust = adjust.apply_scales(values, adjust.fit_robust(values, ["v"])).where("id = 7").first()
    assert robust["v"] == pytest.approx((7 - mid) / (high - low))
    assert adjust.apply_scales(values.limit(0), adjust.fit_minmax(values.limit(0), ["v"])).count() == 0

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from meterline.functions import clip, cut, cut_code, haversine, nan_to_null, seconds_between
from meterline.operators import geospatial, temporal, trip


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expression.alias("v")).first()["v"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2), (None, 3)], "x double, i int")
    assert rows(nan_to_null(df), "i", "x") == [(1, None), (2, 2.0), (3, None)]


@pytest.mark.parametrize("value,want", [(-1.0, 0.0), (5.0, 5.0), (200.0, 100.0), (None, None)])
def test_clip_keeps_null(spark, value, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(clip(F.col("x"), 0, 100)).first()[0] == want


@pytest.mark.parametrize(
    "value,label",
    [
        (0.0, None),
        (0.1, "very_slow"),
        (10.0, "very_slow"),
        (10.1, "slow"),
        (120.0, "very_fast"),
        (120.1, None),
        (None, None),
    ],
)
def test_bins_are_right_closed(spark, value, label):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(cut(F.col("x"), trip.SPEED_BINS, trip.SPEED_LABELS)).first()[0] == label


def test_grid_edges(spark):
    edges = geospatial.grid_edges("lat")
    df = spark.createDataFrame([(40.5,), (40.9,), (40.91,), (40.55,)], "x double")
    found = [r[0] for r in df.select(cut_code(F.col("x"), edges)).collect()]
    assert found == [None, 4, None, 0]


def test_haversine_of_equal_and_opposite_points(spark):
    assert one(spark, haversine(40.0, -74.0, 40.0, -74.0)) == 0
    assert one(spark, haversine(0.0, 0.0, 0.0, 180.0)) == pytest.approx(3959 * math.pi)
    with pytest.raises(ValueError):
        haversine(0.0, 0.0, 1.0, 1.0, unit="yards")


@pytest.mark.parametrize(
    "angle,name", [(45, "E"), (135, "S"), (225, "W"), (315, "N"), (44.9, "N"), (None, None)]
)
def test_direction_quadrants(spark, monkeypatch, angle, name):
    monkeypatch.setattr(geospatial, "bearing", lambda *a: F.lit(angle).cast("double"))
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0)], list(geospatial_columns()))
    assert geospatial.direction(df).first()["direction"] == name


def geospatial_columns():
    return ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]


def test_out_of_grid_is_never_the_same_zone(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (40.6, -74.0, 40.6, -74.0)], geospatial_columns())
    found = geospatial.grid_zone(df)
    assert rows(found, "pickup_zone", "same_zone") == [("1_0", True), (None, False)]


def test_geospatial_steps_skip_without_coordinates(spark):
    df = spark.createDataFrame([(1.0,)], ["trip_distance"])
    assert geospatial.all_geo(df).columns == ["trip_distance"]


def test_durations_ignore_the_session_zone(spark):
    text = "select timestamp_ntz'2023-03-12 01:30:00' a, timestamp_ntz'2023-03-12 03:30:00.25' b"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark.sql(text).select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 7200.25
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "hour,name", [(4, "night"), (5, "morning"), (12, "afternoon"), (17, "evening"), (21, "night")]
)
def test_time_of_day(spark, hour, name):
    assert one(spark, temporal.time_of_day(F.lit(hour))) == name


@pytest.mark.parametrize(
    "day,flag",
    [("2023-01-01", True), ("2023-07-04", True), ("2023-11-22", True), ("2023-11-28", True),
     ("2023-11-29", False), ("2023-12-25", True), ("2023-12-26", False)],
)
def test_holidays(spark, day, flag):
    df = spark.sql(f"select cast('{day} 10:00:00' as timestamp_ntz) pickup_datetime")
    assert temporal.holiday(df).first()["is_holiday"] is flag


def test_exact_thanksgiving(spark):
    days = [f"cast('2023-11-{d} 08:00:00' as timestamp_ntz)" for d in range(22, 29)]
    df = spark.sql(f"select explode(array({', '.join(days)})) pickup_datetime")
    found = temporal.holiday(df, exact_thanksgiving=True).filter("is_thanksgiving")
    assert [r.pickup_datetime.day for r in found.collect()] == [23]


def test_no_passengers_has_no_cost_per_person(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], ["total_amount", "passenger_count"])
    assert rows(trip.trip_features(df), "cost_per_person") == [(2.5,), (None,)]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from meterline.operators import clean, profile, validate
from meterline.sources import raw

T0 = dt.datetime(2023, 1, 1, 8)
SCHEMA = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_distance double, fare_amount double, "
    "total_amount double, passenger_count int, vendor_id int, payment_type int, tip_amount double"
)


def trip(i, distance=2.0, fare=10.0, passengers=1, minutes=10):
    start = T0 + dt.timedelta(minutes=i)
    return (start, start + dt.timedelta(minutes=minutes), distance, fare, 12.0, passengers, 1, 1, 1.0)


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame([trip(i, 1.0 + i % 9, 5.0 + i % 13) for i in range(100)], SCHEMA)


def metric(df, name):
    return {r["metric_name"]: r for r in df.collect()}[name]


def test_schema_failure_stops_validation(spark):
    bad = spark.createDataFrame([(1,), (2,)], ["col1"])
    found = validate.validate_all(bad)
    assert [r["metric_name"] for r in found.collect()] == ["schema"]
    assert validate.overall(found).first()["valid"] is False


def test_nulls_duplicates_and_outliers(spark, trips):
    holes = trips.withColumn(
        "trip_distance",
        F.when(F.col("pickup_datetime") > F.lit(T0 + dt.timedelta(minutes=10)), F.col("trip_distance")),
    )
    assert metric(validate.null_check(holes), "null_trip_distance")["metric_value"] == pytest.approx(0.11)
    twice = trips.unionAll(trips.limit(10))
    found = metric(validate.duplicate_check(twice), "duplicates")
    assert found["metric_value"] == pytest.approx(10 / 110) and not found["passed"]
    far = trips.unionAll(spark.createDataFrame([trip(500, distance=1000.0)], SCHEMA))
    assert metric(validate.outlier_check(far), "outliers_trip_distance")["passed"]


def test_range_issues_never_decide(spark, trips):
    bad = trips.unionAll(spark.createDataFrame([trip(300, -1.0), trip(301, fare=-2.0), trip(302, passengers=0)], SCHEMA))
    assert rows(validate.range_check(bad)) == [("fare_amount", 1), ("passenger_count", 1), ("trip_distance", 1)]
    assert validate.overall(validate.validate_all(bad)).first()["valid"] is True


def test_empty_table(trips):
    empty = trips.limit(0)
    summary = validate.validation_summary(validate.validate_all(empty)).first()
    assert (summary["total_checks"], summary["failed"]) == (2, 0)
    assert profile.null_percent(empty).first()["null_percentage"] is None
    assert clean.clean_all(empty).trips.count() == 0
    assert profile.daily_counts(empty).count() == 0


def test_capping(spark, trips):
    far = trips.unionAll(spark.createDataFrame([trip(500, distance=1000.0)], SCHEMA))
    assert clean.cap_outliers(far).agg(F.max("trip_distance")).first()[0] < 1000
    assert min(low for low, _ in clean.cap_bounds(far).values()) >= 0
    with pytest.raises(ValueError):
        clean.cap_outliers(far, method="sigma")


def test_a_null_fare_survives_unless_strict(spark, trips):
    some = trips.unionAll(spark.createDataFrame([trip(400, fare=None), trip(401, distance=-5.0)], SCHEMA))
    kept = clean.clean_all(some)
    assert kept.counters.first()["final_rows"] == 101
    strict = clean.clean_all(some, strict=True).counters.first()
    assert (strict["final_rows"], strict["missing_removed"], strict["distance_removed"]) == (100, 1, 1)


def test_clean_counters_add_up(trips):
    cleaned = clean.clean_all(trips.unionAll(trips.limit(7)))
    c = cleaned.counters.first()
    assert (c["initial_rows"], c["duplicates_removed"], c["final_rows"]) == (107, 7, 100)
    assert cleaned.trips.count() == 100


def test_unreadable_values(spark):
    df = spark.createDataFrame([("2023-01-01 08:00:00", "2", "x"), ("never", "NaN", "3.5")],
                               ["pickup_datetime", "passenger_count", "fare_amount"])
    found = rows(clean.fix_types(df), "pickup_datetime", "passenger_count", "fare_amount")
    assert found == [(None, 0, 3.5), (T0, 2, 0.0)] or found == [(T0, 2, 0.0), (None, 0, 3.5)]


def test_speed_limits(spark):
    fast = spark.createDataFrame([trip(0, distance=500.0, minutes=10)], SCHEMA)
    assert clean.derive_trip(fast).first()["speed_mph"] == 120.0
    still = spark.createDataFrame([trip(0, minutes=0)], SCHEMA)
    assert clean.derive_trip(still).count() == 0


def test_modes(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None), ("a", None), ("b", None)], "s string, e string")
    assert clean.modes(df, ["s", "e"]) == {"s": "a", "e": "Unknown"}


def test_correlation_with_nulls_and_constants(spark):
    data = [(float(i), float(i * i), 0.3, None if i % 3 else float(-i)) for i in range(50)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(6)
    found = {(r[0], r[1]): r[2] for r in profile.correlation(df).collect()}
    want = df.toPandas().corr()
    assert found["a", "c"] is None
    for pair in (("a", "b"), ("a", "d"), ("b", "d")):
        assert found[pair] == pytest.approx(want.loc[pair], rel=1e-9)


def test_histogram_of_constant_and_null_columns(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, None)], "a double, b double")
    assert rows(profile.histogram(df, ["a", "b"], 10), "column_name", "bin", "row_count") == [("a", 5, 2)]


def test_fingerprint_ignores_row_order(trips):
    a, b = raw.fingerprint(trips), raw.fingerprint(trips.repartition(5))
    assert rows(a) == rows(b)
    assert rows(a) != rows(raw.fingerprint(trips.limit(99)))

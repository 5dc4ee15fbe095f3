"""Temporal, geospatial, trip and ordered features; feature dictionary and store."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from checks.cleaning import raw_copies
from checks.fixture import BASE, SQL_CLEAN, USABLE, prepared, sql, table, usable
from checks.output import plain, sql_half_up, sql_round
from checks.pieces import union
from meterline.operators import features, geospatial, ordered, temporal, trip
from meterline.operators.clean import clean_all
from meterline.plans.jobs import feature_job
from meterline.sources.staging import scratch_path
from meterline.sources.tables import write_table

ENTRIES: dict = {}

# --- temporal -------------------------------------------------------------------------------

PARTS = "year month day hour minute day_of_week day_of_year week_of_year quarter".split()
PARTS_SQL = """CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month,
 CAST(day(pickup_datetime) AS INT) AS day, CAST(hour(pickup_datetime) AS INT) AS hour,
 CAST(minute(pickup_datetime) AS INT) AS minute, CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week,
 CAST(dayofyear(pickup_datetime) AS INT) AS day_of_year, CAST(week(pickup_datetime) AS INT) AS week_of_year,
 CAST(quarter(pickup_datetime) AS INT) AS quarter"""
SQL_PARTS = f"parts AS (SELECT trip_id, pickup_datetime, trip_distance, {PARTS_SQL} FROM prepared)"
CYCLES = [f"{c}_{f}" for c in temporal.CYCLES for f in ("sin", "cos")]
CYCLES_SQL = sql_round(
    *[
        f"{f}({c} * {2 * math.pi!r}::DOUBLE / {p}) AS {c}_{f}"
        for c, p in temporal.CYCLES.items()
        for f in ("sin", "cos")
    ]
)
CATEGORIES = "time_of_day is_rush_hour is_weekend is_business_hours".split()
CATEGORIES_SQL = """CASE WHEN hour >= 5 AND hour < 12 THEN 'morning' WHEN hour >= 12 AND hour < 17 THEN 'afternoon'
 WHEN hour >= 17 AND hour < 21 THEN 'evening' ELSE 'night' END AS time_of_day,
 hour IN (7, 8, 9, 17, 18, 19) AS is_rush_hour, day_of_week IN (5, 6) AS is_weekend,
 hour >= 9 AND hour <= 17 AND day_of_week < 5 AS is_business_hours"""
HOLIDAYS = "is_new_years is_july_4th is_thanksgiving is_christmas is_holiday".split()
HOLIDAYS_SQL = """strftime(pickup_datetime, '%m%d') = '0101' AS is_new_years, strftime(pickup_datetime, '%m%d') = '0704' AS is_july_4th,
 strftime(pickup_datetime, '%m%d') BETWEEN '1122' AND '1128' AS is_thanksgiving, strftime(pickup_datetime, '%m%d') = '1225' AS is_christmas,
 strftime(pickup_datetime, '%m%d') IN ('0101', '0704', '1122', '1123', '1124', '1125', '1126', '1127', '1128', '1225') AS is_holiday"""
TEMPORAL = (*BASE, SQL_PARTS)

ENTRIES["T1_datetime_parts"] = (
    lambda spark, sf_dir: temporal.datetime_parts(prepared(spark, sf_dir)).select("trip_id", *PARTS),
    sql(f"SELECT trip_id, {', '.join(PARTS)} FROM parts", *TEMPORAL),
)


def cyclical(spark, sf_dir):
    df = temporal.datetime_parts(prepared(spark, sf_dir))
    for column, period in temporal.CYCLES.items():
        df = temporal.cyclical(df, column, period)
    return plain(df.select("trip_id", *CYCLES))


ENTRIES["T2_cyclical"] = (cyclical, sql(f"SELECT trip_id, {CYCLES_SQL} FROM parts", *TEMPORAL))
ENTRIES["T3_time_category"] = (
    lambda spark, sf_dir: temporal.time_category(
        temporal.datetime_parts(prepared(spark, sf_dir))
    ).select("trip_id", *CATEGORIES),
    sql(f"SELECT trip_id, {CATEGORIES_SQL} FROM parts", *TEMPORAL),
)
ENTRIES["T4_holiday"] = (
    lambda spark, sf_dir: temporal.holiday(prepared(spark, sf_dir)).select("trip_id", *HOLIDAYS),
    sql(f"SELECT trip_id, {HOLIDAYS_SQL} FROM prepared", *BASE),
)
_EVENT_ROW = ("event_id", "value")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _lag_sql(by: str) -> str:
    return "SELECT event_id, " + sql_round(
        "value", *[f"lag(value, {p}) OVER ({by}) AS value_lag_{p}" for p in (1, 7, 30)]
    )


LAGGED = ("event_id", "value", "value_lag_1", "value_lag_7", "value_lag_30")
ENTRIES["T5_lag_features"] = (
    lambda spark, sf_dir: plain(
        ordered.lag_features(
            _events(spark, sf_dir), "value", order=("ts", "event_id"), run_length=1000
        ).select(*LAGGED)
    ),
    _lag_sql("ORDER BY ts, event_id") + " FROM events",
)
ENTRIES["T5_lag_features_by_key"] = (
    lambda spark, sf_dir: plain(
        ordered.lag_features(
            _events(spark, sf_dir), "value", ("ts", "event_id"), ("event_type",), run_length=700
        ).select(*LAGGED)
    ),
    _lag_sql("PARTITION BY event_type ORDER BY ts, event_id") + " FROM events",
)
_WINDOWS = (7, 14, 30)
ROLLED = [f"value_rolling_{w}_{f}" for w in _WINDOWS for f in ("mean", "std")]


def _rolling_sql(by: str, source: str) -> str:
    columns = []
    for w in _WINDOWS:
        frame = f"OVER ({by} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for name, f in (("mean", "avg"), ("std", "stddev_samp")):
            columns.append(
                f"CASE WHEN count(value) {frame} = {w} THEN {f}(value) {frame} END AS value_rolling_{w}_{name}"
            )
    return "SELECT event_id, " + sql_round(*columns, digits=4) + f" FROM {source}"


def _holes(df):
    return df.withColumn("value", F.when(F.col("event_id") % 50 != 0, F.col("value")))


_HOLES_SQL = "(SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN value END AS value) FROM events)"
ENTRIES["T6_rolling_features"] = (
    lambda spark, sf_dir: plain(
        ordered.rolling_features(
            _holes(_events(spark, sf_dir)), "value", ("ts", "event_id"), run_length=1000
        ).select("event_id", *ROLLED),
        4,
    ),
    _rolling_sql("ORDER BY ts, event_id", _HOLES_SQL),
)
ENTRIES["T6_rolling_features_by_key"] = (
    lambda spark, sf_dir: plain(
        ordered.rolling_features(
            _events(spark, sf_dir), "value", ("ts", "event_id"), ("user_id",), run_length=500
        ).select("event_id", *ROLLED),
        4,
    ),
    _rolling_sql("PARTITION BY user_id ORDER BY ts, event_id", "events"),
)
ENTRIES["T7_all_temporal"] = (
    lambda spark, sf_dir: plain(
        temporal.all_temporal(prepared(spark, sf_dir)).select(
            "trip_id", *PARTS, *CYCLES, *CATEGORIES, *HOLIDAYS
        )
    ),
    sql(
        f"SELECT trip_id, {', '.join(PARTS)}, {CYCLES_SQL}, {CATEGORIES_SQL}, {HOLIDAYS_SQL} FROM parts",
        *TEMPORAL,
    ),
)

# --- geospatial -----------------------------------------------------------------------------

_PU = ("pickup_latitude", "pickup_longitude")
_DO = ("dropoff_latitude", "dropoff_longitude")


def haversine_sql(lat1, lon1, lat2, lon2, radius=3959) -> str:
    return (
        f"2 * {radius} * asin(sqrt(least(1, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


HAVERSINE = haversine_sql(*_PU, *_DO)
MANHATTAN = "69 * abs(dropoff_latitude - pickup_latitude) + 54.6::DOUBLE * abs(dropoff_longitude - pickup_longitude)"
RATIO = f"greatest(0.5, least(5, trip_distance / ({HAVERSINE} + 0.001::DOUBLE)))"
DISTANCES_SQL = sql_round(
    f"{HAVERSINE} AS haversine_distance",
    f"{MANHATTAN} AS manhattan_distance",
    f"{RATIO} AS distance_ratio",
)
DISTANCES = "haversine_distance manhattan_distance distance_ratio".split()
BEARING = """CAST((degrees(atan2(sin(radians(dropoff_longitude - pickup_longitude)) * cos(radians(dropoff_latitude)),
 cos(radians(pickup_latitude)) * sin(radians(dropoff_latitude)) - sin(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
 * cos(radians(dropoff_longitude - pickup_longitude)))) + 360) % 360 AS DOUBLE)"""
# a bearing of exactly 360 after rounding is 0
DIRECTION_SQL = (
    sql_round("bearing", "sin(radians(bearing)) AS bearing_sin", "cos(radians(bearing)) AS bearing_cos")
    + ", CASE WHEN bearing < 45 OR bearing >= 315 THEN 'N' WHEN bearing < 135 THEN 'E' WHEN bearing < 225 THEN 'S' ELSE 'W' END AS direction"
)
DIRECTIONS = "bearing bearing_sin bearing_cos direction".split()
SQL_BEARING = f"turned AS (SELECT *, {BEARING} AS bearing FROM prepared)"


def _near(end: str, name: str) -> str:
    lat, lon = geospatial.LANDMARKS[name]
    point = _PU if end == "pickup" else _DO
    return haversine_sql(*point, f"{lat}::DOUBLE", f"({lon}::DOUBLE)")


_AIRPORTS = [n for n in geospatial.LANDMARKS if "airport" in n]
LANDMARK_COLUMNS = [f"pickup_dist_to_{n}" for n in geospatial.LANDMARKS] + [
    f"dropoff_dist_to_{n}" for n in _AIRPORTS
]
LANDMARK_SQL = sql_round(
    *[f"{_near('pickup', n)} AS pickup_dist_to_{n}" for n in geospatial.LANDMARKS],
    *[f"{_near('dropoff', n)} AS dropoff_dist_to_{n}" for n in _AIRPORTS],
)
_AT = {e: "(" + " OR ".join(f"{_near(e, n)} < 1" for n in _AIRPORTS) + ")" for e in ("pickup", "dropoff")}
FLAGS = "pickup_at_airport dropoff_at_airport is_airport_trip".split()
FLAGS_SQL = f"{_AT['pickup']} AS pickup_at_airport, {_AT['dropoff']} AS dropoff_at_airport, {_AT['pickup']} OR {_AT['dropoff']} AS is_airport_trip"


def _cell(column: str, axis: str) -> str:
    edges = geospatial.grid_edges(axis)
    cases = " ".join(f"WHEN {column} <= ({e!r}::DOUBLE) THEN {i}" for i, e in enumerate(edges[1:]))
    return f"CASE WHEN {column} <= ({edges[0]!r}::DOUBLE) THEN NULL {cases} END"


_ZONE = {
    e: f"{_cell(p[0], 'lat')} || '_' || {_cell(p[1], 'lon')}"
    for e, p in (("pickup", _PU), ("dropoff", _DO))
}
ZONES = "pickup_zone dropoff_zone same_zone".split()
ZONES_SQL = f"{_ZONE['pickup']} AS pickup_zone, {_ZONE['dropoff']} AS dropoff_zone, coalesce({_ZONE['pickup']} = {_ZONE['dropoff']}, false) AS same_zone"


def distance(spark, sf_dir):
    a = [F.col(c) for c in _PU]
    b = [F.col(c) for c in _DO]
    return plain(
        prepared(spark, sf_dir).select(
            "trip_id",
            geospatial.haversine(*a, *b).alias("miles"),
            geospatial.haversine(*a, *b, unit="km").alias("km"),
        )
    )


ENTRIES["G1_haversine"] = (
    distance,
    sql(
        "SELECT trip_id, "
        + sql_round(f"{HAVERSINE} AS miles", f"{haversine_sql(*_PU, *_DO, radius=6371)} AS km")
        + " FROM prepared",
        *BASE,
    ),
)
ENTRIES["G2_manhattan"] = (
    lambda spark, sf_dir: plain(
        prepared(spark, sf_dir).select(
            "trip_id",
            geospatial.manhattan(*[F.col(c) for c in (*_PU, *_DO)]).alias("manhattan_distance"),
        )
    ),
    sql("SELECT trip_id, " + sql_round(f"{MANHATTAN} AS manhattan_distance") + " FROM prepared", *BASE),
)
ENTRIES["G3_trip_distances"] = (
    lambda spark, sf_dir: plain(
        geospatial.trip_distances(prepared(spark, sf_dir)).select("trip_id", *DISTANCES)
    ),
    sql(f"SELECT trip_id, {DISTANCES_SQL} FROM prepared", *BASE),
)
ENTRIES["G4_bearing"] = (
    lambda spark, sf_dir: plain(
        prepared(spark, sf_dir).select(
            "trip_id", geospatial.bearing(*[F.col(c) for c in (*_PU, *_DO)]).alias("bearing")
        )
    ),
    sql("SELECT trip_id, " + sql_round("bearing") + " FROM turned", *BASE, SQL_BEARING),
)
ENTRIES["G5_direction"] = (
    lambda spark, sf_dir: plain(
        geospatial.direction(prepared(spark, sf_dir)).select("trip_id", *DIRECTIONS)
    ),
    sql(f"SELECT trip_id, {DIRECTION_SQL} FROM turned", *BASE, SQL_BEARING),
)
ENTRIES["G6_landmark_distance"] = (
    lambda spark, sf_dir: plain(
        geospatial.landmark_distance(prepared(spark, sf_dir)).select("trip_id", *LANDMARK_COLUMNS)
    ),
    sql(f"SELECT trip_id, {LANDMARK_SQL} FROM prepared", *BASE),
)
ENTRIES["G7_airport_flags"] = (
    lambda spark, sf_dir: geospatial.airport_flags(prepared(spark, sf_dir)).select("trip_id", *FLAGS),
    sql(f"SELECT trip_id, {FLAGS_SQL} FROM prepared", *BASE),
)
ENTRIES["G8_grid_zone"] = (
    lambda spark, sf_dir: geospatial.grid_zone(prepared(spark, sf_dir)).select("trip_id", *ZONES),
    sql(f"SELECT trip_id, {ZONES_SQL} FROM prepared", *BASE),
)
ENTRIES["G9_all_geo"] = (
    lambda spark, sf_dir: plain(
        geospatial.all_geo(prepared(spark, sf_dir)).select(
            "trip_id", *DISTANCES, *DIRECTIONS, *LANDMARK_COLUMNS, *FLAGS, *ZONES
        )
    ),
    sql(
        f"SELECT trip_id, {DISTANCES_SQL}, {DIRECTION_SQL}, {LANDMARK_SQL}, {FLAGS_SQL}, {ZONES_SQL} FROM turned",
        *BASE,
        SQL_BEARING,
    ),
)

# --- trip features --------------------------------------------------------------------------


def _cut_sql(column: str, edges, labels) -> str:
    cases = " ".join(
        f"WHEN {column} > {a} AND {column} <= {b} THEN '{n}'"
        for a, b, n in zip(edges, edges[1:], labels, strict=False)
    )
    return f"CASE {cases} END"


TRIP_PARTS = {
    "price_per_mile": sql_round(
        "greatest(0, least(100, fare_amount / (trip_distance + 0.001::DOUBLE))) AS price_per_mile"
    ),
    "tip_percentage": sql_round(
        "greatest(0, least(100, tip_amount / (fare_amount + 0.001::DOUBLE) * 100)) AS tip_percentage"
    ),
    "cost_per_person": sql_round(
        "CASE WHEN passenger_count <> 0 THEN total_amount / passenger_count END AS cost_per_person"
    ),
    "speed_category": _cut_sql("speed_mph", trip.SPEED_BINS, trip.SPEED_LABELS) + " AS speed_category",
    "distance_category": _cut_sql("trip_distance", trip.DISTANCE_BINS, trip.LENGTH_LABELS)
    + " AS distance_category",
    "duration_category": _cut_sql("trip_duration_minutes", trip.DURATION_BINS, trip.LENGTH_LABELS)
    + " AS duration_category",
}


def _trip_feature(name):
    return lambda spark, sf_dir: plain(
        trip.trip_features(usable(spark, sf_dir)).select("trip_id", name)
    )


for _i, (_name, _text) in enumerate(TRIP_PARTS.items(), 1):
    ENTRIES[f"F{_i}_{_name}"] = (_trip_feature(_name), sql(f"SELECT trip_id, {_text} FROM usable", *USABLE))


def cost_of_all(spark, sf_dir):
    """Also trips without passengers, whose cost per person is unknown."""
    return plain(trip.trip_features(prepared(spark, sf_dir)).select("trip_id", "cost_per_person"))


ENTRIES["F3_cost_per_person"] = (
    cost_of_all,
    sql(f"SELECT trip_id, {TRIP_PARTS['cost_per_person']} FROM prepared", *BASE),
)
INTERACTIONS = "distance_hour_interaction rush_hour_distance weekend_hour".split()
INTERACTIONS_SQL = (
    sql_round(
        "trip_distance * hour AS distance_hour_interaction",
        "CASE WHEN hour IN (7, 8, 9, 17, 18, 19) THEN trip_distance ELSE 0 END AS rush_hour_distance",
    )
    + ", CASE WHEN day_of_week >= 5 THEN hour ELSE 0 END AS weekend_hour"
)
ENTRIES["F7_interactions"] = (
    lambda spark, sf_dir: plain(
        trip.interactions(temporal.all_temporal(prepared(spark, sf_dir))).select("trip_id", *INTERACTIONS)
    ),
    sql(f"SELECT trip_id, {INTERACTIONS_SQL} FROM parts", *TEMPORAL),
)
ENTRIES["F8_polynomial"] = (
    lambda spark, sf_dir: plain(
        trip.polynomial(prepared(spark, sf_dir), ["trip_distance", "fare_amount"], 3).select(
            "trip_id",
            *[f"{c}_pow{d}" for c in ("trip_distance", "fare_amount") for d in (2, 3)],
        ),
        4,
    ),
    sql(
        "SELECT trip_id, "
        + sql_round(
            *[f"pow({c}, {d}) AS {c}_pow{d}" for c in ("trip_distance", "fare_amount") for d in (2, 3)],
            digits=4,
        )
        + " FROM prepared",
        *BASE,
    ),
)

FEATURES = [*PARTS, *CYCLES, *CATEGORIES, *HOLIDAYS, *TRIP_PARTS]
FEATURES_SQL = ", ".join([*PARTS, CYCLES_SQL, CATEGORIES_SQL, HOLIDAYS_SQL, *TRIP_PARTS.values()])


def featured(pieces, source: str):
    parts = f"featured AS (SELECT * EXCLUDE (hour_of_day, day_of_week, month, is_weekend), {PARTS_SQL} FROM {source})"
    return (*pieces, parts)


def all_features(spark, sf_dir):
    df = trip.all_features(usable(spark, sf_dir), with_interactions=True)
    return plain(df.select("trip_id", *FEATURES, *DISTANCES, *ZONES, *INTERACTIONS))


ENTRIES["F9_all_features"] = (
    all_features,
    sql(
        f"SELECT trip_id, {FEATURES_SQL}, {DISTANCES_SQL}, {ZONES_SQL}, {INTERACTIONS_SQL} FROM featured",
        *featured(USABLE, "usable"),
    ),
)


def feature_table(spark, sf_dir):
    """Processed table -> feature table by the job; the features of every cleaned trip."""
    mark = uuid.uuid4().hex
    source, target = f"processed_{mark}", f"features_{mark}"
    cleaned = clean_all(raw_copies(spark, sf_dir)).trips
    write_table(cleaned, source, "fail", path=scratch_path(spark, "processed"))
    feature_job(
        spark,
        source,
        target,
        dictionary_path=scratch_path(spark, "dictionary"),
        path=scratch_path(spark, "features"),
    )
    return plain(spark.table(target).select("trip_id", *FEATURES))


ENTRIES["F10_feature_job"] = (
    feature_table,
    sql(f"SELECT trip_id, {FEATURES_SQL} FROM featured", *featured(SQL_CLEAN, "clean")),
)

_ROUNDED = [*CYCLES, "price_per_mile", "tip_percentage", "cost_per_person"]
DOCUMENTED_TEXT = ["store_and_fwd_flag", "time_of_day", "speed_category", "distance_category", "duration_category"]
_PLAIN = (
    "pickup_datetime dropoff_datetime is_weekend is_rush_hour is_business_hours is_new_years is_july_4th"
    " is_thanksgiving is_christmas is_holiday"
).split()
DOCUMENTED = [
    *"trip_id vendor_id passenger_count trip_distance rate_code pickup_location_id dropoff_location_id payment_type".split(),
    *"fare_amount extra mta_tax tip_amount tolls_amount total_amount".split(),
    *"pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude".split(),
    *"trip_duration trip_duration_minutes speed_mph hour_of_day".split(),
    *PARTS,
    *_ROUNDED,
]


def _documented(spark, sf_dir):
    """All columns of the feature table; what is computed is rounded, as engines differ in last digits."""
    df = trip.all_features(usable(spark, sf_dir), geospatial=False)
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in _ROUNDED})


def _dictionary_sql() -> str:
    parts = []
    for c in [*_PLAIN, *DOCUMENTED, *DOCUMENTED_TEXT]:
        if c in DOCUMENTED:
            stats = ", ".join(
                f"{sql_half_up(f'{f}({c}::DOUBLE)', 4)} AS {n}"
                for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
            )
        else:
            stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "max"))
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
            + sql_half_up(f"(count(*) - count({c})) * 100.0::DOUBLE / count(*)", 2)
            + f" AS null_percentage, count(DISTINCT {c}) AS unique_values, {stats} FROM documented"
        )
    return union(parts)


_DOCUMENTED_CTE = (
    *featured(USABLE, "usable"),
    f"documented AS MATERIALIZED (SELECT featured.*, hour AS hour_of_day, {', '.join([CYCLES_SQL, CATEGORIES_SQL, HOLIDAYS_SQL, *TRIP_PARTS.values()])} FROM featured)",
)
ENTRIES["F11_feature_dictionary"] = (
    lambda spark, sf_dir: features.feature_dictionary(_documented(spark, sf_dir)).drop(
        "position", "data_type"
    ),
    sql(_dictionary_sql(), *_DOCUMENTED_CTE),
)
ENTRIES["F11_top_values"] = (
    lambda spark, sf_dir: features.top_values(_documented(spark, sf_dir)),
    sql(
        "SELECT column_name, value, n, CAST(r AS INT) AS value_rank FROM (SELECT *, row_number() OVER"
        " (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM ("
        + union(
            [
                f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM documented WHERE {c} IS NOT NULL GROUP BY 2"
                for c in DOCUMENTED_TEXT
            ]
        )
        + ")) WHERE r <= 5",
        *_DOCUMENTED_CTE,
    ),
)
STORED = ["trip_distance", "fare_amount", "speed_mph", "price_per_mile"]
_STORED_CTE = (*USABLE, f"stored AS (SELECT trip_id, trip_distance, fare_amount, speed_mph, {TRIP_PARTS['price_per_mile']} FROM usable)")


def _store(spark, sf_dir):
    return features.to_feature_store(trip.trip_features(usable(spark, sf_dir)), "trip_id", "v1", STORED)


ENTRIES["F12_feature_store_long"] = (
    lambda spark, sf_dir: plain(_store(spark, sf_dir)),
    sql(
        union(
            [
                f"SELECT trip_id, '{c}' AS feature_name, {sql_round(f'{c} AS feature_value')}, 'v1' AS feature_version FROM stored"
                for c in STORED
            ]
        ),
        *_STORED_CTE,
    ),
)


def store_back(spark, sf_dir):
    """Long and wide again, for trips whose id is unique."""
    df = trip.trip_features(usable(spark, sf_dir))
    once = df.groupBy("trip_id").agg(*[F.max(c).alias(c) for c in STORED])
    store = features.to_feature_store(once, "trip_id", "v1", STORED)
    return plain(features.from_feature_store(store, "v1", STORED))


ENTRIES["F12_feature_store_wide"] = (
    store_back,
    sql(
        "SELECT trip_id, " + sql_round(*[f"max({c}) AS {c}" for c in STORED]) + " FROM stored GROUP BY 1",
        *_STORED_CTE,
    ),
)

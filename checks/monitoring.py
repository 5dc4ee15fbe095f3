"""Drift, degradation, alternative limits and scales, cross-validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.fixture import SQL_TRIPS, SQL_UNFILLED, USABLE, sql, unfilled, usable
from checks.learning import fare_columns
from checks.output import plain, sql_round
from checks.pieces import COORDINATE_NUMERIC, PREPARED_NUMERIC, RAW_NUMERIC, union
from checks.tracking import METRICS, SQL_METRICS, SQL_RUNS, run_table
from meterline.learn import moments
from meterline.operators import adjust, drift

ENTRIES: dict = {}
UNFILLED = (SQL_TRIPS, SQL_UNFILLED)

# --- O1 drift between two windows ---------------------------------------------------------------

AS_OF = dt.datetime(1996, 3, 1)


def drifted(days):
    def query(spark, sf_dir):
        trips = unfilled(spark, sf_dir)
        seen = drift.two_windows(trips, "pickup_datetime", AS_OF, days, days)
        return plain(drift.drift_ks(seen, columns=PREPARED_NUMERIC))

    return query


def _drift_sql(days: int) -> str:
    at = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
    values = union(
        [f"SELECT '{c}' AS column_name, {c}::DOUBLE AS value, old FROM seen WHERE {c} IS NOT NULL" for c in PREPARED_NUMERIC]
    )
    names = ", ".join(f"'{c}'" for c in PREPARED_NUMERIC)
    return sql(
        f"""SELECT column_name, coalesce(n, 0) AS reference_rows, coalesce(m, 0) AS current_rows,
 round(d, 6) + 0.0 AS statistic, round(p, 6) + 0.0 AS p_value, coalesce(p < 0.05, false) AS drifted
FROM (SELECT unnest([{names}]) AS column_name) LEFT JOIN tested USING (column_name)""",
        *UNFILLED,
        f"seen AS (SELECT *, pickup_datetime < {at} - INTERVAL {days} DAY AS old FROM unfilled"
        f" WHERE pickup_datetime >= {at} - INTERVAL {2 * days} DAY AND pickup_datetime < {at})",
        f"cells AS ({values})",
        "steps AS (SELECT column_name, value, count(*) FILTER (WHERE old) AS a, count(*) FILTER (WHERE NOT old) AS b FROM cells GROUP BY 1, 2)",
        "curves AS (SELECT column_name, sum(a) OVER w AS fa, sum(b) OVER w AS fb, sum(a) OVER (PARTITION BY column_name) AS n,"
        " sum(b) OVER (PARTITION BY column_name) AS m FROM steps WINDOW w AS (PARTITION BY column_name ORDER BY value))",
        "gaps AS (SELECT column_name, any_value(n)::BIGINT AS n, any_value(m)::BIGINT AS m, max(abs(fa / nullif(n, 0) - fb / nullif(m, 0))) AS d FROM curves GROUP BY 1)",
        "scaled AS (SELECT *, sqrt(n::DOUBLE * m / (n + m)) * d AS s FROM gaps)",
        "tested AS (SELECT column_name, any_value(n) AS n, any_value(m) AS m, any_value(d) AS d, CASE WHEN any_value(s) < 0.04 THEN 1.0"
        " WHEN any_value(s) IS NOT NULL THEN greatest(0, 2 * sum(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * j * j * s * s))) END AS p"
        " FROM scaled, range(1, 101) t(j) GROUP BY 1)",
    )


ENTRIES["O1_drift_ks"] = (drifted(drift.WINDOW_DAYS), _drift_sql(drift.WINDOW_DAYS))
ENTRIES["O1_drift_ks_years"] = (drifted(365), _drift_sql(365))

# --- O2 runs that fell behind -------------------------------------------------------------------

_WORSE = "CASE WHEN metric IN ('rmse', 'mae', 'mse', 'mape', 'loss', 'error', 'davies_bouldin_score') THEN value - baseline_value ELSE baseline_value - value END / nullif(abs(baseline_value), 0)"
ENTRIES["O2_degradation_alert"] = (
    lambda spark, sf_dir: plain(
        drift.degradation_alerts(
            run_table(spark, sf_dir).withColumn(
                "run_name", F.concat_ws("-", "model_type", F.coalesce("run_name", F.lit("none")))
            )
        )
    ),
    sql(
        "SELECT run_name, run_id, metric, "
        + sql_round("baseline_value", "value AS current_value", f"{_WORSE} AS worse_share")
        + f", coalesce({_WORSE} > 0.1, false) AS alert FROM (SELECT n.run_name, n.run_id, a.metric, a.value, b.value AS baseline_value"
        " FROM placed n JOIN placed o ON n.run_name = o.run_name AND n.newest = 1 AND o.oldest = 1"
        " JOIN metrics a ON a.run_id = n.run_id JOIN metrics b ON b.run_id = o.run_id AND b.metric = a.metric)",
        SQL_RUNS,
        SQL_METRICS,
        "named AS (SELECT run_id, start_time, model_type || '-' || coalesce(run_name, 'none') AS run_name FROM runs)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY start_time, run_id) AS oldest,"
        " row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) AS newest FROM named)",
    ),
)
assert "davies_bouldin_score" in METRICS

# --- O3 to O5 limits, fills and scales ----------------------------------------------------------

_Z = [
    f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count,"
    f" round(min(lo), 6) + 0.0 AS lower_bound, round(min(hi), 6) + 0.0 AS upper_bound FROM unfilled, (SELECT avg({c}::DOUBLE) - 3 * stddev_pop({c}::DOUBLE) AS lo,"
    f" avg({c}::DOUBLE) + 3 * stddev_pop({c}::DOUBLE) AS hi FROM unfilled)"
    for c in PREPARED_NUMERIC
]
ENTRIES["O3_zscore_outliers"] = (
    lambda spark, sf_dir: plain(adjust.zscore_outliers(unfilled(spark, sf_dir), PREPARED_NUMERIC)),
    sql(union(_Z), *UNFILLED),
)
_FLAGGED = ("passenger_count", "trip_distance", "store_and_fwd_flag", "fare_amount")
ENTRIES["O4_flag_missing"] = (
    lambda spark, sf_dir: adjust.flag_missing(unfilled(spark, sf_dir), _FLAGGED).select(
        "trip_id", *[f"{c}_missing" for c in _FLAGGED]
    ),
    sql(
        "SELECT trip_id, "
        + ", ".join(f"{c} IS NULL AS {c}_missing" for c in _FLAGGED)
        + " FROM unfilled",
        *UNFILLED,
    ),
)
ENTRIES["O4_impute_mean"] = (
    lambda spark, sf_dir: plain(
        adjust.impute_mean(unfilled(spark, sf_dir), RAW_NUMERIC).select("trip_id", *RAW_NUMERIC)
    ),
    sql(
        "SELECT trip_id, "
        + sql_round(
            *[
                f"coalesce({c}::DOUBLE, (SELECT avg({c}::DOUBLE) FROM unfilled)) AS {c}"
                for c in RAW_NUMERIC
            ]
        )
        + " FROM unfilled",
        *UNFILLED,
    ),
)
_REMOVED = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def _inside(method):
    def bound(c, sign):
        if method == "zscore":
            return f"(SELECT avg({c}) {sign} 3 * stddev_pop({c}) FROM unfilled)"
        edge = "0.25" if sign == "-" else "0.75"
        width = f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
        return f"(SELECT quantile_cont({c}, {edge}) {sign} 1.5 * {width} FROM unfilled)"

    return " AND ".join(
        f"({c} IS NULL OR {c} BETWEEN {bound(c, '-')} AND {bound(c, '+')})" for c in _REMOVED
    )


def removed(method):
    return (
        lambda spark, sf_dir: adjust.remove_outliers(
            unfilled(spark, sf_dir), _REMOVED, method
        ).select("trip_id"),
        sql(f"SELECT trip_id FROM unfilled WHERE {_inside(method)}", *UNFILLED),
    )


ENTRIES["O4_remove_outliers"] = removed("iqr")
ENTRIES["O4_remove_outliers_zscore"] = removed("zscore")
_SCALED = [*RAW_NUMERIC[1:3], *RAW_NUMERIC[7:], *COORDINATE_NUMERIC]


def scaled(fit):
    def query(spark, sf_dir):
        df = usable(spark, sf_dir).select("trip_id", *_SCALED)
        return plain(adjust.apply_scales(df, fit(df, _SCALED)))

    return query


def _scaled_sql(centre: str, width: str) -> str:
    parts = []
    for c in _SCALED:
        m, w = centre.format(c=c), width.format(c=c)
        parts.append(
            f"({c} - (SELECT {m} FROM usable)) / (SELECT CASE WHEN {w} = 0 THEN 1 ELSE {w} END FROM usable) AS {c}"
        )
    return sql("SELECT trip_id, " + sql_round(*parts) + " FROM usable", *USABLE)


ENTRIES["O5_minmax"] = (
    scaled(adjust.fit_minmax),
    _scaled_sql("min({c}::DOUBLE)", "(max({c}::DOUBLE) - min({c}::DOUBLE))"),
)
ENTRIES["O5_robust"] = (
    scaled(adjust.fit_robust),
    _scaled_sql(
        "median({c}::DOUBLE)",
        "(quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25))",
    ),
)

# --- O6 cross-validation over grids -------------------------------------------------------------


def cross_validated(spark, sf_dir):
    """Every model, penalty and fold on all features of the fares."""
    df, columns = fare_columns(spark, sf_dir)
    return plain(moments.cross_validate(df, columns, "fare_amount", ["split_key"]))


def chosen(spark, sf_dir):
    df, columns = fare_columns(spark, sf_dir)
    return plain(
        moments.best_parameters(moments.cross_validate(df, columns, "fare_amount", ["split_key"]))
    )


_ONE_GRID = {
    "LinearRegression": ({},),
    "Ridge": ({"alpha": 1.0}, {"alpha": 1e6}),
    "Lasso": ({"alpha": 1.0}, {"alpha": 50.0}, {"alpha": 1e5}),
}
_POINTS = union(
    [
        f"SELECT '{name}' AS model, {params.get('alpha', 'NULL')}::DOUBLE AS alpha"
        for name, grid in _ONE_GRID.items()
        for params in grid
    ]
)
_SLOPE = (
    "CASE model WHEN 'LinearRegression' THEN cxy / vx WHEN 'Ridge' THEN cxy * n / (vx * n + alpha)"
    " ELSE sign(cxy) * greatest(abs(cxy) - alpha, 0) / vx END"
)
_CV = (
    *USABLE,
    "rows_ AS (SELECT fare_amount AS x, total_amount AS y, CAST(('0x' || substr(md5(trip_id::VARCHAR || '-42'), 1, 8)) AS BIGINT) % 5 AS fold FROM usable)",
    "train AS (SELECT k.fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS cxy"
    " FROM range(5) k(fold) JOIN rows_ ON rows_.fold <> k.fold GROUP BY 1)",
    f"points AS ({_POINTS})",
    f"fits AS (SELECT model, alpha, fold, n, {_SLOPE} AS w, my - mx * ({_SLOPE}) AS b FROM train, points)",
    "scores AS (SELECT model, alpha, CAST(fold AS INT) AS fold, any_value(n) AS train_rows, count(*) AS test_rows,"
    " sqrt(avg(pow(y - b - w * x, 2))) AS rmse, 1 - avg(pow(y - b - w * x, 2)) / var_pop(y) AS r2 FROM fits JOIN rows_ USING (fold) GROUP BY 1, 2, 3)",
)


def one_feature_scores(spark, sf_dir):
    df = usable(spark, sf_dir).withColumn("key", F.col("trip_id").cast("string"))
    return moments.cross_validate(df, ["fare_amount"], "total_amount", ["key"], _ONE_GRID)


ENTRIES["O6_cv_grids"] = (cross_validated, None)
ENTRIES["O6_cv_best"] = (chosen, None)
ENTRIES["O6_cv_one_feature"] = (
    lambda spark, sf_dir: plain(one_feature_scores(spark, sf_dir)),
    sql(
        "SELECT model, fold, train_rows, test_rows, " + sql_round("alpha", "rmse", "r2") + " FROM scores",
        *_CV,
    ),
)
ENTRIES["O6_cv_best_one_feature"] = (
    lambda spark, sf_dir: plain(moments.best_parameters(one_feature_scores(spark, sf_dir))),
    sql(
        "SELECT model, folds, "
        + sql_round("alpha", "mean_rmse", "std_rmse")
        + " FROM (SELECT model, alpha, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse, count(*) AS folds FROM scores GROUP BY 1, 2)"
        " QUALIFY row_number() OVER (PARTITION BY model ORDER BY mean_rmse, alpha NULLS FIRST) = 1",
        *_CV,
    ),
)

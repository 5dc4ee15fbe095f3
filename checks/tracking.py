"""Runs, comparison, model cards and batch scoring."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from checks.evaluation import PREDICTED, one, predicted
from checks.fixture import SQL_TRIPS, SQL_UNFILLED, USABLE, sql, table, unfilled, usable
from checks.output import plain, sql_round, sql_time
from checks.pieces import union
from meterline.learn import evaluation, prep
from meterline.operators.temporal import datetime_parts
from meterline.plans.training import Target, run_all, train_family
from meterline.sources.staging import scratch_path
from meterline.sources.tables import write_table
from meterline.tracking import cards, runs, scoring

ENTRIES: dict = {}

METRICS = {
    "rmse": "WHEN kind = 0 AND o_orderkey % 11 <> 0 THEN CAST(o_custkey % 700 AS DOUBLE) / 100",
    "mae": "WHEN kind = 0 THEN CAST(o_custkey % 500 AS DOUBLE) / 100",
    "r2": "WHEN kind = 0 THEN CAST(o_custkey % 101 AS DOUBLE) / 100",
    "accuracy": "WHEN kind = 1 THEN CAST(o_custkey % 101 AS DOUBLE) / 100",
    "precision": "WHEN kind = 1 THEN CAST(o_custkey % 97 AS DOUBLE) / 100",
    "recall": "WHEN kind = 1 THEN CAST(o_custkey % 89 AS DOUBLE) / 100",
    "f1_score": "WHEN kind = 1 AND o_orderkey % 5 <> 0 THEN CAST(o_custkey % 83 AS DOUBLE) / 100",
    "roc_auc": "WHEN kind = 1 THEN CAST(o_custkey % 99 AS DOUBLE) / 100",
    "davies_bouldin_score": "WHEN kind = 2 THEN CAST(o_custkey % 300 AS DOUBLE) / 100",
    "silhouette_sq": "WHEN kind = 2 THEN CAST(o_custkey % 90 AS DOUBLE) / 100",
}
PARAMS = {
    "alpha": "WHEN kind = 0 AND o_orderkey % 2 = 0 THEN CASE o_custkey % 3 WHEN 0 THEN '0.1' WHEN 1 THEN '1.0' ELSE '10.0' END",
    "n_estimators": "WHEN kind < 2 AND o_orderkey % 2 = 1 THEN CAST(o_custkey % 300 AS STRING)",
    "max_depth": "WHEN kind < 2 AND o_orderkey % 2 = 1 THEN CAST(o_custkey % 20 AS STRING)",
    "learning_rate": "WHEN kind = 0 AND o_orderkey % 4 = 1 THEN '0.1'",
    "C": "WHEN kind = 1 AND o_orderkey % 4 = 0 THEN '1.0'",
    "hidden_layer_sizes": "WHEN kind = 1 AND o_orderkey % 4 = 2 THEN CASE o_custkey % 2 WHEN 0 THEN '(100, 50)' ELSE '(64,)' END",
    "n_clusters": "WHEN kind = 2 AND o_orderkey % 2 = 0 THEN '5'",
    "n_components": "WHEN kind = 2 AND o_orderkey % 4 = 1 THEN '5'",
}
RUNS = (
    "SELECT o_orderkey, o_custkey, 'run-' || CAST(o_orderkey AS STRING) AS run_id,"
    " CASE o_orderkey % 3 WHEN 0 THEN 'Trips_Regression' WHEN 1 THEN 'Trips_Classification' ELSE 'Trips_Clustering' END AS experiment_name,"
    " CASE o_orderkey % 3 WHEN 0 THEN 'regression' WHEN 1 THEN 'classification' ELSE 'clustering' END AS model_type,"
    " CASE o_custkey % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'green' END AS run_name,"
    " o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS start_time,"
    " CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate + (o_orderkey % 86400 + o_custkey % 600 + 1) * INTERVAL '1' SECOND END AS end_time, "
    + ", ".join(f"CASE {c} END AS m_{n}" for n, c in METRICS.items())
    + ", "
    + ", ".join(f"CASE {c} END AS p_{n}" for n, c in PARAMS.items())
    + " FROM (SELECT *, o_orderkey % 3 AS kind FROM {orders})"
)
SQL_RUNS = f"runs AS MATERIALIZED ({RUNS.format(orders='orders')})"
SQL_METRICS = "metrics AS MATERIALIZED (" + union(
    [f"SELECT run_id, experiment_name, '{n}' AS metric, m_{n} AS value FROM runs WHERE m_{n} IS NOT NULL" for n in METRICS]
) + ")"
SQL_PARAMS = "params AS MATERIALIZED (" + union(
    [f"SELECT run_id, experiment_name, '{n}' AS param, p_{n} AS value FROM runs WHERE p_{n} IS NOT NULL" for n in PARAMS]
) + ")"


def run_table(spark, sf_dir):
    """A run per order."""
    wide = spark.sql(RUNS, orders=table(spark, sf_dir, "orders"))

    def packed(prefix, names):
        pairs = ", ".join(f"'{n}', {prefix}_{n}" for n in names)
        return F.expr(f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL)")

    return wide.select(
        "experiment_name",
        "run_id",
        "run_name",
        "model_type",
        "start_time",
        "end_time",
        packed("m", METRICS).alias("metrics"),
        packed("p", PARAMS).alias("params"),
    )


def of(spark, sf_dir, experiment):
    return run_table(spark, sf_dir).filter(F.col("experiment_name") == experiment)


def logged(spark, sf_dir):
    """Three runs with the metrics of three fare formulas, logged and read back."""
    name, path = f"runs_{uuid.uuid4().hex}", scratch_path(spark, "runs")
    at = dt.datetime(2024, 1, 1)
    for row in evaluation.compare_regressors(predicted(spark, sf_dir)).collect():
        metrics = {k: row[k] for k in ("mae", "rmse", "r2")} | {"missing": None}
        runs.log_run(
            spark, name, "Trips_Regression", row["model"], row["model"], at, None, metrics, path=path
        )
    return plain(runs.run_metrics(spark.table(name)))


_E = "avg(abs(label - prediction))|sqrt(avg(pow(label - prediction, 2)))|1 - avg(pow(label - prediction, 2)) / var_pop(label)".split("|")
ENTRIES["X1_log_run"] = (
    logged,
    sql(
        union(
            [
                f"SELECT model AS run_id, '{n}' AS metric, {sql_round(f'{e} AS value')} FROM predicted GROUP BY 1"
                for n, e in zip(("mae", "rmse", "r2"), _E, strict=True)
            ]
        ),
        *PREDICTED,
    ),
)
_LATEST = "latest AS (SELECT * FROM runs WHERE experiment_name = 'Trips_Regression' ORDER BY start_time DESC, run_id LIMIT 50)"
ENTRIES["X2_latest_runs"] = (
    lambda spark, sf_dir: plain(
        runs.run_metrics(runs.latest_runs(run_table(spark, sf_dir), "Trips_Regression", 50))
    ),
    sql(
        "SELECT run_id, metric, " + sql_round("value") + " FROM metrics JOIN latest USING (run_id)",
        SQL_RUNS,
        SQL_METRICS,
        _LATEST,
    ),
)


def best(spark, sf_dir):
    table_ = run_table(spark, sf_dir)
    low = runs.best_run(table_, "Trips_Regression", "rmse", "min")
    high = runs.best_run(table_, "Trips_Classification", "f1_score", "max")
    return low.unionByName(high).select("experiment_name", "run_id", "run_name")


ENTRIES["X3_best_run"] = (
    best,
    sql(
        "(SELECT experiment_name, run_id, run_name FROM runs WHERE m_rmse > 0 ORDER BY m_rmse, run_id LIMIT 1)"
        " UNION ALL (SELECT experiment_name, run_id, run_name FROM runs WHERE m_f1_score > 0 ORDER BY m_f1_score DESC, run_id LIMIT 1)",
        SQL_RUNS,
    ),
)
REGISTRY = (
    "SELECT c_custkey AS id, c_mktsegment AS name, CASE c_nationkey % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' ELSE 'Archived' END AS stage,"
    " c_custkey AS version, 'run-' || CAST(c_custkey AS STRING) AS run_id, c_name AS description, c_name AS model_name,"
    " CASE c_nationkey % 2 WHEN 0 THEN 'regression' ELSE 'classification' END AS model_type FROM {customer}"
)
SQL_REGISTRY = f"registry AS ({REGISTRY.format(customer='customer')})"


def registry(spark, sf_dir):
    return spark.sql(REGISTRY, customer=table(spark, sf_dir, "customer"))


ENTRIES["X4_registered_versions"] = (
    lambda spark, sf_dir: runs.registered_versions(registry(spark, sf_dir)),
    sql(
        "SELECT name, stage, version, run_id, description FROM registry WHERE (name, stage, version) IN"
        " (SELECT name, stage, max(version) FROM registry GROUP BY 1, 2)",
        SQL_REGISTRY,
    ),
)
_WIDE_M, _WIDE_P = ("rmse", "mae", "r2"), ("alpha", "n_estimators", "max_depth", "learning_rate")
ENTRIES["X5_compare_runs"] = (
    lambda spark, sf_dir: plain(
        runs.compare_runs(run_table(spark, sf_dir), "Trips_Regression", "rmse", 50)
    ),
    sql(
        "SELECT run_id, run_name, "
        + sql_time("start_time")
        + ", "
        + sql_round(*[f"m_{m} AS metric_{m}" for m in _WIDE_M])
        + ", "
        + ", ".join(f"p_{p} AS param_{p}" for p in _WIDE_P)
        + " FROM latest",
        SQL_RUNS,
        _LATEST,
    ),
)
_LOWER = "metric IN ('rmse', 'mae', 'davies_bouldin_score')"
ENTRIES["X6_metric_spread"] = (
    # at nine digits: a mean of six can end in a tie that the order of summation decides
    lambda spark, sf_dir: plain(runs.metric_spread(run_table(spark, sf_dir)), 9),
    sql(
        f"SELECT metric, count(*) AS runs, CASE WHEN {_LOWER} THEN min(value) ELSE max(value) END AS best,"
        f" CASE WHEN {_LOWER} THEN max(value) ELSE min(value) END AS worst, "
        + sql_round(
            "avg(value) AS mean",
            "stddev_samp(value) AS std",
            "(max(value) - min(value)) / avg(value) * 100 AS spread_percent",
            digits=9,
        )
        + ", CASE WHEN (max(value) - min(value)) / avg(value) < 0.05 THEN 'similar' WHEN (max(value) - min(value)) / avg(value) < 0.2"
        " THEN 'moderate' ELSE 'high' END AS consistency FROM metrics GROUP BY metric",
        SQL_RUNS,
        SQL_METRICS,
    ),
)
ENTRIES["X7_param_usage"] = (
    lambda spark, sf_dir: plain(runs.param_usage(run_table(spark, sf_dir))),
    sql(
        "SELECT param, value, runs, CASE WHEN numbers THEN low END AS range_low, CASE WHEN numbers THEN high END AS range_high FROM"
        " (SELECT param, value, count(*) AS runs FROM params GROUP BY 1, 2) JOIN"
        " (SELECT param, bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) AS numbers, min(TRY_CAST(value AS DOUBLE)) AS low,"
        " max(TRY_CAST(value AS DOUBLE)) AS high FROM params GROUP BY 1 HAVING count(DISTINCT value) > 1) USING (param)",
        SQL_RUNS,
        SQL_PARAMS,
    ),
)


def pairs(spark, sf_dir):
    """Each order's run against the run three orders later, of the same experiment."""
    ids = table(spark, sf_dir, "orders").select("o_orderkey")
    later = ids.select((F.col("o_orderkey") - 3).alias("o_orderkey"))
    return ids.join(later, "o_orderkey").select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("champion_id"),
        F.concat(F.lit("run-"), (F.col("o_orderkey") + 3).cast("string")).alias("challenger_id"),
    )


SQL_PAIRS = (
    "pairs AS MATERIALIZED (SELECT a.run_id AS champion_id, b.run_id AS challenger_id FROM runs a JOIN runs b ON b.o_orderkey = a.o_orderkey + 3)",
    "faced AS MATERIALIZED (SELECT champion_id, challenger_id, metric, a.value AS champion, b.value AS challenger FROM"
    " (SELECT p.*, metric, value FROM pairs p JOIN metrics m ON m.run_id = champion_id) a FULL JOIN"
    " (SELECT p.*, metric, value FROM pairs p JOIN metrics m ON m.run_id = challenger_id) b USING (champion_id, challenger_id, metric))",
    f"judged AS MATERIALIZED (SELECT *, CASE WHEN champion IS NULL OR challenger IS NULL THEN NULL WHEN ({_LOWER} AND challenger < champion)"
    f" OR (NOT {_LOWER} AND challenger > champion) THEN 'challenger' ELSE 'champion' END AS winner FROM faced)",
)
ENTRIES["X8_champion_challenger"] = (
    lambda spark, sf_dir: plain(
        runs.champion_challenger(run_table(spark, sf_dir), pairs(spark, sf_dir))
    ),
    sql(
        "SELECT champion_id, challenger_id, metric, winner, champion, challenger, "
        + sql_round(
            "challenger - champion AS difference",
            "CASE WHEN champion = 0 AND challenger IS NOT NULL THEN 0 ELSE (challenger - champion) / nullif(champion, 0) * 100 END AS difference_percent",
        )
        + " FROM judged",
        SQL_RUNS,
        SQL_METRICS,
        *SQL_PAIRS,
    ),
)


def verdicts(spark, sf_dir):
    faced = runs.champion_challenger(run_table(spark, sf_dir), pairs(spark, sf_dir))
    return plain(runs.champion_verdict(faced))


ENTRIES["X8_champion_verdict"] = (
    verdicts,
    sql(
        "SELECT *, CASE WHEN challenger_wins > champion_wins THEN 'promote' WHEN champion_wins > challenger_wins THEN 'keep' ELSE 'tie' END AS verdict, "
        + sql_round(
            "CASE WHEN champion_wins <> challenger_wins THEN greatest(champion_wins, challenger_wins) * 100.0::DOUBLE / (champion_wins + challenger_wins) END AS win_rate"
        )
        + " FROM (SELECT champion_id, challenger_id, count(*) FILTER (WHERE winner = 'champion') AS champion_wins,"
        " count(*) FILTER (WHERE winner = 'challenger') AS challenger_wins FROM judged GROUP BY 1, 2)",
        SQL_RUNS,
        SQL_METRICS,
        *SQL_PAIRS,
    ),
)
ENTRIES["X8_param_differences"] = (
    lambda spark, sf_dir: runs.param_differences(run_table(spark, sf_dir), pairs(spark, sf_dir)),
    sql(
        "SELECT champion_id, challenger_id, param, max(CASE WHEN side = 1 THEN value END) AS champion, max(CASE WHEN side = 2 THEN value END) AS challenger"
        " FROM (SELECT champion_id, challenger_id, param, value, 1 AS side FROM pairs JOIN params ON run_id = champion_id"
        " UNION ALL SELECT champion_id, challenger_id, param, value, 2 FROM pairs JOIN params ON run_id = challenger_id) GROUP BY 1, 2, 3",
        SQL_RUNS,
        SQL_PARAMS,
        SQL_PAIRS[0],
    ),
)

_TYPE_SQL = """CASE WHEN kind = 0 AND p_alpha IS NOT NULL THEN 'Linear Regression with Regularization (Ridge/Lasso)'
 WHEN kind = 0 AND p_n_estimators IS NOT NULL AND p_learning_rate IS NOT NULL THEN 'Gradient Boosting Regressor (XGBoost)'
 WHEN kind = 0 AND p_n_estimators IS NOT NULL THEN 'Random Forest Regressor' WHEN kind = 0 THEN 'Linear Regression'
 WHEN kind = 1 AND p_C IS NOT NULL THEN 'Logistic Regression Classifier'
 WHEN kind = 1 AND p_hidden_layer_sizes IS NOT NULL THEN 'Multi-Layer Perceptron (Neural Network)'
 WHEN kind = 1 AND p_n_estimators IS NOT NULL THEN 'Tree-based Classifier (Random Forest or XGBoost)' WHEN kind = 1 THEN 'Classification Model'
 WHEN p_n_clusters IS NOT NULL THEN 'K-Means Clustering' WHEN p_n_components IS NOT NULL THEN 'Gaussian Mixture Model' ELSE 'Clustering Model' END"""
_INSIGHTS = {
    "High Complexity": "p_n_estimators::INT > 200",
    "Low Complexity": "p_n_estimators::INT < 50",
    "Deep Trees": "p_max_depth::INT > 15",
    "Shallow Trees": "p_max_depth::INT < 5",
    "Strong Predictive Power": "m_r2 > 0.85",
    "Precision-Recall Tradeoff": "m_f1_score IS NOT NULL AND abs(m_precision - m_recall) > 0.1::DOUBLE",
}
_ADVICE = {
    "Feature Engineering": "kind = 0 AND m_r2 < 0.8",
    "Hyperparameter Tuning": "kind = 0 AND m_r2 < 0.8",
    "Outlier Handling": "kind = 0 AND m_rmse > 5",
    "Data Quality": "kind = 1 AND m_accuracy < 0.75",
    "Feature Selection": "kind = 1 AND m_accuracy < 0.75",
    "Cross-Validation": "true",
    "Ensemble Methods": "true",
    "Monitoring": "true",
}


def _grade_sql(metric, grades):
    cases = " ".join(f"WHEN m_{metric} > {g}::DOUBLE THEN '{n}'" for g, n in grades)
    return f"CASE {cases} ELSE 'Poor' END"


_CARD_PARTS = [
    "SELECT run_id, 'name' AS section, coalesce(run_name, 'Unknown Model') AS text FROM cards",
    "SELECT run_id, 'experiment', experiment_name FROM cards",
    "SELECT run_id, 'training date', strftime(start_time, '%Y-%m-%d %H:%M:%S') FROM cards",
    "SELECT run_id, 'training duration', coalesce(CAST(date_diff('second', start_time, end_time) AS VARCHAR) || '.00 seconds', 'N/A') FROM cards",
    f"SELECT run_id, 'model type', {_TYPE_SQL} FROM cards",
    f"SELECT run_id, 'performance', {_grade_sql('r2', cards.R2_GRADES)} FROM cards WHERE m_r2 > 0",
    f"SELECT run_id, 'performance', {_grade_sql('roc_auc', cards.AUC_GRADES)} FROM cards WHERE m_roc_auc > 0",
    *[f"SELECT run_id, 'insight', '{n}' FROM cards WHERE {c}" for n, c in _INSIGHTS.items()],
    "SELECT run_id, 'insight', 'Model trained successfully' FROM cards WHERE NOT ("
    + " OR ".join(f"coalesce({c}, false)" for c in _INSIGHTS.values())
    + ")",
    *[f"SELECT run_id, 'recommendation', '{n}' FROM cards WHERE {c}" for n, c in _ADVICE.items()],
]
ENTRIES["X9_model_card"] = (
    lambda spark, sf_dir: cards.model_cards(run_table(spark, sf_dir)),
    sql(union(_CARD_PARTS), SQL_RUNS, "cards AS (SELECT *, o_orderkey % 3 AS kind FROM runs)"),
)
ENTRIES["X9_card_values"] = (
    lambda spark, sf_dir: cards.card_values(run_table(spark, sf_dir)),
    sql(
        "SELECT run_id, 'hyperparameters' AS section, param AS name, value FROM params"
        " UNION ALL SELECT run_id, 'metrics', metric, printf('%.6f', value) FROM metrics",
        SQL_RUNS,
        SQL_METRICS,
        SQL_PARAMS,
    ),
)
_IMPORTANCE = (
    "SELECT 'run-' || CAST(l_suppkey AS STRING) AS run_id, 'feature_' || CAST(l_partkey % 50 AS STRING) AS feature,"
    " sum(l_quantity) / 100 AS importance FROM {lineitem} GROUP BY 1, 2"
)
ENTRIES["X10_top_importance"] = (
    lambda spark, sf_dir: plain(
        runs.top_importance(spark.sql(_IMPORTANCE, lineitem=table(spark, sf_dir, "lineitem")))
    ),
    sql(
        "SELECT run_id, feature, "
        + sql_round("importance")
        + ", CAST(r AS INT) AS importance_rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id"
        " ORDER BY importance DESC, feature) AS r FROM importances) WHERE r <= 10",
        f"importances AS ({_IMPORTANCE.format(lineitem='lineitem')})",
    ),
)
_REPORTED = {
    "regression": ("mae", "rmse", "r2"),
    "classification": ("accuracy", "precision", "recall", "f1_score", "roc_auc"),
    "clustering": ("silhouette_sq", "davies_bouldin_score"),
}
ENTRIES["X11_training_report"] = (
    lambda spark, sf_dir: plain(runs.training_report(run_table(spark, sf_dir))),
    sql(
        union(
            [
                f"SELECT model_type, run_id, run_name, '{m}' AS metric, m_{m} AS value FROM runs WHERE model_type = '{t}'"
                for t, names in _REPORTED.items()
                for m in names
            ]
            + [
                "SELECT model_type, run_id, run_name, 'calinski_harabasz_score', NULL FROM runs WHERE model_type = 'clustering'"
            ]
        ),
        SQL_RUNS,
    ),
)
ENTRIES["X12_improvement_hints"] = (
    lambda spark, sf_dir: runs.improvement_hints(of(spark, sf_dir, "Trips_Regression"), "rmse"),
    sql(
        union(
            [
                f"SELECT '{h}' AS hint, '{t}' AS text FROM regressions"
                + (" HAVING count(m_rmse) > 1 AND stddev_samp(m_rmse) / avg(m_rmse) > 0.2" if h == "ensemble" else "")
                + (" HAVING count(p_n_estimators) > 0" if h == "boosting" else "")
                + ("" if h in ("ensemble", "boosting") else " HAVING true")
                for h, t in runs.HINTS.items()
            ]
        ),
        SQL_RUNS,
        "regressions AS (SELECT * FROM runs WHERE experiment_name = 'Trips_Regression')",
    ),
)


def _target(spark, experiment="Trips_Regression"):
    mark = uuid.uuid4().hex
    return Target(
        f"runs_{mark}", scratch_path(spark, "models"), experiment, scratch_path(spark, "runs")
    )


def _fare_table(spark, sf_dir):
    keyed = usable(spark, sf_dir).withColumn("split_key", F.col("trip_id").cast("string"))
    return prep.regression_set(keyed)


def families(spark, sf_dir):
    """All thirteen models of the four families; a wrong name fails and is listed, the others run.

    Forests and boosters have few trees and the net few iterations here: at full size each is a query of
    its own (R4, R5, K2, K3, K4), and this one is about the run over all families.
    """
    where = _target(spark)
    few = {"n_estimators": 10, "max_depth": 4}
    trainers = {
        "regression": {
            "LinearRegression": {},
            "Ridge": {"alpha": 1.0},
            "Lasso": {"alpha": 1.0},
            "RandomForestRegressor": few,
            "GBTRegressor": few,
            "NoSuchModel": {},
        },
        "classification": {
            "LogisticRegression": {},
            "RandomForestClassifier": few,
            "GBTClassifier": few,
            "MLPClassifier": {"max_iter": 20},
        },
    }
    report, failed = run_all(spark, usable(spark, sf_dir), where, trainers=trainers)
    lost = spark.createDataFrame(
        [("failed", n, "failed", None) for n in failed],
        "model_type string, run_name string, metric string, value double",
    )
    return plain(report.drop("run_id").unionByName(lost))


ENTRIES["X13_family_training"] = (families, None)


def _trained(spark, sf_dir):
    where = _target(spark)
    trainers = {"LinearRegression": {}, "Ridge": {"alpha": 1.0}}
    fares = _fare_table(spark, sf_dir).select(*SCORED, "split_key", "fare_amount")
    ids, _ = train_family(spark, fares, "fare_amount", "split_key", "regression", where, trainers)
    return spark.table(where.runs_table), ids


SCORED = ["trip_distance", "passenger_count", "trip_duration_minutes", "hour_of_day"]


def score(spark, sf_dir):
    """The best of two models on every trip; one feature is absent and counts as 0."""
    logged_runs, _ = _trained(spark, sf_dir)
    run_id, model = scoring.best_model(logged_runs, "Trips_Regression", "rmse")
    trips = usable(spark, sf_dir).select("trip_id", "trip_distance", "passenger_count", "hour_of_day")
    return plain(scoring.score_batch(model, trips, SCORED, run_id).drop("model_run_id"))


ENTRIES["B1_score_batch"] = (score, None)


def score_one(spark, sf_dir):
    """A model of one feature, trained, recorded, found as the best run and applied to every trip."""
    where = _target(spark)
    fares = _fare_table(spark, sf_dir).select("trip_distance", "split_key", "fare_amount")
    train_family(
        spark, fares, "fare_amount", "split_key", "regression", where, {"LinearRegression": {}}
    )
    _, model = scoring.best_model(spark.table(where.runs_table), "Trips_Regression", "rmse")
    trips = usable(spark, sf_dir).select("trip_id", "trip_distance")
    scored = scoring.score_batch(model, trips, ["trip_distance"], "run")
    return plain(scored.select("trip_id", "trip_distance", "prediction"))


ENTRIES["B1_score_one_feature"] = (
    score_one,
    sql(
        "SELECT trip_id, "
        + sql_round("trip_distance", "my + (trip_distance - mx) * slope AS prediction")
        + " FROM usable, fit",
        *USABLE,
        "fit AS (SELECT avg(trip_distance) AS mx, avg(fare_amount) AS my, covar_pop(trip_distance, fare_amount) / var_pop(trip_distance) AS slope"
        " FROM usable WHERE fare_amount > 0 AND store_and_fwd_flag IS NOT NULL"
        " AND CAST(('0x' || substr(md5(trip_id::VARCHAR || '-42'), 1, 8)) AS BIGINT) % 1000 >= 300)",
    ),
)


def requests(spark, sf_dir):
    df = datetime_parts(unfilled(spark, sf_dir))
    return df.select(
        "trip_id",
        *[c for c in scoring.LIMITS if c != "pickup_latitude"],
        (F.col("pickup_latitude") + F.when(F.col("trip_id") % 211 == 0, 90).otherwise(0)).alias(
            "pickup_latitude"
        ),
        F.col("trip_distance").alias("distance_miles"),
    )


ENTRIES["B2_score_fare"] = (
    lambda spark, sf_dir: scoring.check_requests(requests(spark, sf_dir)).select("trip_id", "reason"),
    sql(
        "SELECT trip_id, CASE WHEN pickup_latitude + (CASE WHEN trip_id % 211 = 0 THEN 90 ELSE 0 END) > 90 THEN 'pickup_latitude'"
        " WHEN passenger_count IS NULL OR passenger_count NOT BETWEEN 1 AND 6 THEN 'passenger_count'"
        " WHEN trip_distance < 0 THEN 'distance_miles' END AS reason FROM unfilled",
        SQL_TRIPS,
        SQL_UNFILLED,
    ),
)


def fares_scored(spark, sf_dir):
    logged_runs, ids = _trained(spark, sf_dir)
    model = scoring.load_model(logged_runs, run_id=ids[0])
    valid, rejected = scoring.score_fare(model, requests(spark, sf_dir), SCORED, ids[0])
    good = valid.agg(F.lit("scored").alias("outcome"), F.count("*").alias("row_count"))
    return good.unionByName(
        rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("row_count"))
    )


ENTRIES["B2_score_fare_outcome"] = (
    fares_scored,
    sql(
        "SELECT coalesce(reason, 'scored') AS outcome, count(*) AS row_count FROM (" + ENTRIES["B2_score_fare"][1] + ") GROUP BY 1"
    ),
)


def loaded(spark, sf_dir):
    """The same model by run and by name and stage predicts the same."""
    logged_runs, ids = _trained(spark, sf_dir)
    versions = spark.createDataFrame(
        [("Fare", "Production", 1, ids[0]), ("Fare", "Production", 2, ids[1])],
        "name string, stage string, version int, run_id string",
    )
    trips = usable(spark, sf_dir)
    by_run = scoring.load_model(logged_runs, run_id=ids[1])
    by_name = scoring.load_model(logged_runs, versions, name="Fare")
    a = scoring.score_batch(by_run, trips, SCORED, "run").select("model_run_id", "prediction")
    b = scoring.score_batch(by_name, trips, SCORED, "name").select("model_run_id", "prediction")
    return plain(
        a.unionByName(b)
        .groupBy("model_run_id")
        .agg(F.count("*").alias("row_count"), F.sum("prediction").alias("total"))
    )


ENTRIES["B3_load_model"] = (loaded, None)


def prediction_log(spark, sf_dir):
    """The log of one formula's predictions, appended per model, read with the registry."""
    name, path = f"log_{uuid.uuid4().hex}", scratch_path(spark, "log")
    at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    guessed = one(predicted(spark, sf_dir), "per_mile")
    for model_id in (1, 2, 5):
        part = scoring.log_predictions(guessed, model_id, ["trip_id"], at)
        write_table(part, name, "append", path=path)
    named = scoring.named_predictions(spark.table(name), registry(spark, sf_dir))
    return plain(
        named.groupBy("model_name", "model_type").agg(
            F.count("*").alias("row_count"),
            F.sum("prediction").alias("total"),
            F.max(F.get_json_object("input_features", "$.trip_id").cast("bigint")).alias("last_trip"),
        )
    )


ENTRIES["B4_prediction_log"] = (
    prediction_log,
    sql(
        "SELECT model_name, model_type, count(*) AS row_count, "
        + sql_round("sum(prediction) AS total")
        + ", max(trip_id) AS last_trip FROM predicted, registry WHERE model = 'per_mile' AND id IN (1, 2, 5) GROUP BY 1, 2",
        *PREDICTED,
        SQL_REGISTRY,
    ),
)


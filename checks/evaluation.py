"""Model data preparation and evaluation."""

from __future__ import annotations

import re
from statistics import NormalDist

from pyspark.sql import functions as F

from checks.fixture import SQL_TRIPS, SQL_UNFILLED, USABLE, sql, unfilled, usable
from checks.output import plain, sql_round
from checks.pieces import PREPARED_NUMERIC, union
from checks.quality import histogram_sql
from meterline.learn import evaluation, prep
from meterline.operators.quantiles import quantiles

ENTRIES: dict = {}
UNFILLED = (SQL_TRIPS, SQL_UNFILLED)

KEY = ("trip_id",)
_BUCKET = "CAST(('0x' || substr(md5(trip_id::VARCHAR || '-42'), 1, 8)) AS BIGINT) % 1000"
_SPLIT = f"CASE WHEN {_BUCKET} < 200 THEN 'test' WHEN {_BUCKET} < 300 THEN 'val' ELSE 'train' END"


def numeric_block(spark, sf_dir):
    """Which columns enter the feature matrix, and how many values each has."""
    df = usable(spark, sf_dir)
    names = prep.select_numeric(df, "fare_amount")
    return df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "row_count")


_FEATURES = ["trip_id", *[c for c in PREPARED_NUMERIC if c != "fare_amount"]]
_FEATURES += "trip_duration trip_duration_minutes speed_mph hour_of_day day_of_week month".split()
ENTRIES["M1_select_numeric"] = (
    numeric_block,
    sql(
        union([f"SELECT '{c}' AS feature, count({c}) AS row_count FROM usable" for c in _FEATURES]),
        *USABLE,
    ),
)
_FILLED = ("passenger_count", "trip_distance", "fare_amount")


def median_fill(spark, sf_dir):
    df = prep.assign_split(unfilled(spark, sf_dir), KEY)
    medians = prep.fit_medians(df.filter("split = 'train'"), _FILLED)
    return plain(prep.fill_medians(df, medians).select("trip_id", "split", *_FILLED))


ENTRIES["M2_median_fill"] = (
    median_fill,
    sql(
        "SELECT trip_id, split, "
        + sql_round(
            *[
                f"coalesce({c}, (SELECT median({c}) FROM parted WHERE split = 'train')) AS {c}"
                for c in _FILLED
            ]
        )
        + " FROM parted",
        *UNFILLED,
        f"parted AS (SELECT *, {_SPLIT} AS split FROM unfilled)",
    ),
)
ENTRIES["M3_split"] = (
    lambda spark, sf_dir: prep.assign_split(unfilled(spark, sf_dir), KEY).select("trip_id", "split"),
    sql(f"SELECT trip_id, {_SPLIT} AS split FROM unfilled", *UNFILLED),
)
_REGRESSION = "vendor_id trip_distance extra speed_mph pickup_location_id store_and_fwd_flag fare_amount".split()
_LEAK_FREE = "store_and_fwd_flag IS NOT NULL"


def _plain_set(df, columns):
    return plain(df.select(*columns))


ENTRIES["M4_regression_set"] = (
    lambda spark, sf_dir: _plain_set(prep.regression_set(usable(spark, sf_dir)), _REGRESSION),
    sql(
        "SELECT vendor_id, pickup_location_id, store_and_fwd_flag, "
        + sql_round("trip_distance", "extra", "speed_mph", "fare_amount")
        + f" FROM usable WHERE fare_amount > 0 AND {_LEAK_FREE}",
        *USABLE,
    ),
)
_TIP = "vendor_id trip_distance speed_mph pickup_location_id high_tip".split()
_HIGH = "CAST(tip_amount > (SELECT median(tip_amount) FROM usable) AS INT)"
ENTRIES["M5_tip_label"] = (
    lambda spark, sf_dir: _plain_set(prep.tip_label(usable(spark, sf_dir)), _TIP),
    sql(
        "SELECT vendor_id, pickup_location_id, "
        + sql_round("trip_distance", "speed_mph")
        + f", {_HIGH} AS high_tip FROM usable WHERE {_LEAK_FREE}",
        *USABLE,
    ),
)
ENTRIES["M5_class_counts"] = (
    lambda spark, sf_dir: prep.class_counts(prep.tip_label(usable(spark, sf_dir))),
    sql(
        f"SELECT {_HIGH} AS high_tip, count(*) AS row_count FROM usable WHERE {_LEAK_FREE} GROUP BY 1",
        *USABLE,
    ),
)
_CLUSTER = "trip_distance fare_amount tip_amount speed_mph hour_of_day".split()
ENTRIES["M6_cluster_set"] = (
    lambda spark, sf_dir: _plain_set(prep.cluster_set(usable(spark, sf_dir)), _CLUSTER),
    sql(
        "SELECT " + sql_round(*_CLUSTER[:4]) + ", hour_of_day FROM usable WHERE trip_id IS NOT NULL", *USABLE
    ),
)


def standardise(spark, sf_dir):
    df = usable(spark, sf_dir)
    scaled = prep.standardise(df, prep.fit_scales(df, [*_CLUSTER, "mta_tax"]))
    return plain(scaled.select("trip_id", *_CLUSTER, "mta_tax"))


ENTRIES["M7_standardise"] = (
    standardise,
    sql(
        "SELECT trip_id, "
        + sql_round(
            *[
                f"({c} - (SELECT avg({c}) FROM usable)) / (SELECT stddev_pop({c}) FROM usable) AS {c}"
                for c in _CLUSTER
            ],
            "0.0::DOUBLE AS mta_tax",
        )
        + " FROM usable",
        *USABLE,
    ),
)

# --- evaluation: predictions are simple formulas over the trips ------------------------------

_FORMULAS = {
    "per_mile": "3.0 + 2.5 * trip_distance",
    "per_minute": "2.0 + 0.9 * trip_duration_minutes",
    "flat": "44.0 + 0.0 * trip_distance",
}
_SCORES = {
    "by_tip": "least(1.0, tip_amount / 18)",
    "by_fare": "least(1.0, fare_amount / 90)",
    "by_hour": "hour_of_day / 24.0",
}


def _doubles(text: str) -> str:
    """The formula with every decimal literal as a double, in both engines."""
    return re.sub(r"(?<![\w.])(\d+\.\d+)", r"CAST(\1 AS DOUBLE)", text)


PREDICTED_SQL = "predicted AS (" + union(
    [
        f"SELECT '{m}' AS model, trip_id, fare_amount AS label, {_doubles(f)} AS prediction FROM usable"
        for m, f in _FORMULAS.items()
    ]
) + ")"
SCORED_SQL = "scored AS (SELECT model, trip_id, label, score, CAST(score >= 0.5 AS INT) AS prediction FROM (" + union(
    [
        f"SELECT '{m}' AS model, trip_id, {_HIGH} AS label, {_doubles(f)} AS score FROM usable"
        for m, f in _SCORES.items()
    ]
) + "))"
PREDICTED = (*USABLE, PREDICTED_SQL)
SCORED = (*USABLE, SCORED_SQL)


def predicted(spark, sf_dir):
    df = usable(spark, sf_dir)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.expr(_doubles(f)).alias("prediction"))
                for m, f in _FORMULAS.items()
            ]
        )
    ).alias("p")
    return df.select("trip_id", F.col("fare_amount").alias("label"), rows).select(
        "p.model", "trip_id", "label", "p.prediction"
    )


def scored(spark, sf_dir):
    df = usable(spark, sf_dir)
    median = quantiles(df, ["tip_amount"], (0.5,))["tip_amount"][0]
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.expr(_doubles(f)).alias("score"))
                for m, f in _SCORES.items()
            ]
        )
    ).alias("p")
    label = (F.col("tip_amount") > F.lit(median)).cast("int").alias("label")
    return df.select("trip_id", label, rows).select(
        "p.model",
        "trip_id",
        "label",
        "p.score",
        (F.col("p.score") >= 0.5).cast("int").alias("prediction"),
    )


def one(df, model):
    return df.filter(F.col("model") == model)


_E1 = """avg(abs(label - prediction)) AS mae|avg(pow(label - prediction, 2)) AS mse|sqrt(avg(pow(label - prediction, 2))) AS rmse|1 - avg(pow(label - prediction, 2)) / var_pop(label) AS r2""".split("|")
ENTRIES["E1_regression_metrics"] = (
    lambda spark, sf_dir: plain(evaluation.regression_metrics(one(predicted(spark, sf_dir), "per_mile"))),
    sql("SELECT " + sql_round(*_E1) + " FROM predicted WHERE model = 'per_mile'", *PREDICTED),
)
_E2 = [
    *_E1[::2][:1],
    *_E1[2:],
    "avg(CASE WHEN label <> 0 THEN abs((label - prediction) / label) END) * 100 AS mape",
]
ENTRIES["E2_compare_regressors"] = (
    lambda spark, sf_dir: plain(evaluation.compare_regressors(predicted(spark, sf_dir))),
    sql(
        "SELECT model, "
        + sql_round(*_E2)
        + ", count(*) FILTER (WHERE label = 0) AS zero_labels FROM predicted GROUP BY 1",
        *PREDICTED,
    ),
)
_HITS = """coalesce(sum((label = prediction)::INT) / count(*), 0) AS accuracy|coalesce(sum(label * prediction) / nullif(sum(prediction), 0), 0) AS precision|coalesce(sum(label * prediction) / nullif(sum(label), 0), 0) AS recall|coalesce(2 * sum(label * prediction) / nullif(sum(label) + sum(prediction), 0), 0) AS f1_score""".split("|")
_AUC_SQL = """areas AS (SELECT model, sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc FROM
 (SELECT model, score, pos, neg, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
 FROM (SELECT model, score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM scored GROUP BY 1, 2)) GROUP BY 1)"""
_E4_SQL = (
    "SELECT model, "
    + sql_round("accuracy", "precision", "recall", "f1_score", "roc_auc")
    + ", unscored FROM (SELECT model, count(*) FILTER (WHERE score IS NULL) AS unscored, "
    + ", ".join(_HITS)
    + " FROM scored GROUP BY 1) JOIN areas USING (model)"
)
ENTRIES["E3_binary_metrics"] = (
    lambda spark, sf_dir: plain(evaluation.binary_metrics(one(scored(spark, sf_dir), "by_fare"))),
    sql(f"SELECT * EXCLUDE (model) FROM ({_E4_SQL}) WHERE model = 'by_fare'", *SCORED, _AUC_SQL),
)
ENTRIES["E4_compare_classifiers"] = (
    lambda spark, sf_dir: plain(evaluation.compare_classifiers(scored(spark, sf_dir))),
    sql(_E4_SQL, *SCORED, _AUC_SQL),
)
ENTRIES["E5_confusion_matrix"] = (
    lambda spark, sf_dir: evaluation.confusion_matrix(one(scored(spark, sf_dir), "by_tip")),
    sql(
        "SELECT label, prediction, count(*) AS row_count FROM scored WHERE model = 'by_tip' GROUP BY 1, 2",
        *SCORED,
    ),
)
ENTRIES["E6_roc_points"] = (
    lambda spark, sf_dir: plain(evaluation.roc_points(one(scored(spark, sf_dir), "by_tip"))),
    sql(
        """SELECT round(score, 6) + 0.0 AS threshold,
 round(sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(1 - label) FROM only_tip), 6) + 0.0 AS fpr,
 round(sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(label) FROM only_tip), 6) + 0.0 AS tpr
 FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM only_tip GROUP BY 1)""",
        *SCORED,
        "only_tip AS (SELECT * FROM scored WHERE model = 'by_tip')",
    ),
)
_PAYMENT = "CASE WHEN fare_amount < 30 THEN 0 WHEN fare_amount < 60 THEN 1 ELSE 2 END"
_GUESS = "CASE WHEN trip_distance < 4 THEN 0 WHEN trip_distance < 8 THEN 1 ELSE 2 END"


def class_report(spark, sf_dir):
    df = usable(spark, sf_dir).select(
        F.expr(_PAYMENT).alias("label"), F.expr(_GUESS).alias("prediction")
    )
    return plain(evaluation.classification_report(df))


ENTRIES["E7_classification_report"] = (
    class_report,
    sql(
        "SELECT class, " + sql_round("precision", "recall", "f1_score") + ", CAST(support AS BIGINT) AS support FROM ("
        " SELECT class, precision, recall, f1_score, support FROM per_class"
        " UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per_class"
        " UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),"
        " sum(f1_score * support) / sum(support), sum(support) FROM per_class)",
        *USABLE,
        f"guesses AS (SELECT {_PAYMENT} AS label, {_GUESS} AS prediction FROM usable)",
        """per_class AS (SELECT CAST(c AS VARCHAR) AS class,
 coalesce(count(*) FILTER (WHERE label = c AND prediction = c) / nullif(count(*) FILTER (WHERE prediction = c), 0), 0) AS precision,
 coalesce(count(*) FILTER (WHERE label = c AND prediction = c) / nullif(count(*) FILTER (WHERE label = c), 0), 0) AS recall,
 2.0::DOUBLE * count(*) FILTER (WHERE label = c AND prediction = c) / (count(*) FILTER (WHERE label = c) + count(*) FILTER (WHERE prediction = c)) AS f1_score,
 count(*) FILTER (WHERE label = c) AS support FROM guesses, (VALUES (0), (1), (2)) k(c) GROUP BY c)""",
    ),
)
_MINUTE = (*PREDICTED, "residuals AS (SELECT *, label - prediction AS residual FROM predicted WHERE model = 'per_minute')")


def _bin(c: str) -> str:
    lo, hi = (f"(SELECT {f}({c}) FROM residuals)" for f in ("min", "max"))
    return f"CAST(least(floor(({c} - {lo}) / (({hi} - {lo}) / 50)), 49) AS INT)"


ENTRIES["E8_residual_cells"] = (
    lambda spark, sf_dir: evaluation.residual_cells(one(predicted(spark, sf_dir), "per_minute")),
    sql(
        f"SELECT {_bin('prediction')} AS x_bin, {_bin('residual')} AS y_bin, count(*) AS row_count FROM residuals GROUP BY 1, 2",
        *_MINUTE,
    ),
)
ENTRIES["E8_actual_predicted_cells"] = (
    lambda spark, sf_dir: evaluation.residual_cells(
        one(predicted(spark, sf_dir), "per_minute"), "label", "prediction"
    ),
    sql(
        f"SELECT {_bin('label')} AS x_bin, {_bin('prediction')} AS y_bin, count(*) AS row_count FROM residuals GROUP BY 1, 2",
        *_MINUTE,
    ),
)
ENTRIES["E8_residual_histogram"] = (
    lambda spark, sf_dir: plain(evaluation.residual_histogram(one(predicted(spark, sf_dir), "per_minute"))),
    sql(histogram_sql("residuals", ["residual"]), *_MINUTE),
)
_PROBS = [(i + 1) / 100 for i in range(99)]
ENTRIES["E8_normal_qq"] = (
    lambda spark, sf_dir: plain(evaluation.normal_qq(one(predicted(spark, sf_dir), "per_minute"))),
    sql(
        union(
            [
                f"SELECT {p!r}::DOUBLE AS prob, round({NormalDist().inv_cdf(p)!r}::DOUBLE, 6) + 0.0 AS theoretical, round(quantile_cont(residual, {p!r}), 6) + 0.0 AS residual FROM residuals"
                for p in _PROBS
            ]
        ),
        *_MINUTE,
    ),
)


def report(spark, sf_dir):
    comparison = evaluation.compare_regressors(predicted(spark, sf_dir))
    return plain(evaluation.evaluation_report(comparison, ["mae", "rmse", "r2"], "rmse", lower=True))


ENTRIES["E10_evaluation_report"] = (
    report,
    sql(
        "SELECT model, CAST(model_rank AS INT) AS model_rank, metric, value FROM (UNPIVOT (SELECT model, "
        + sql_round(*_E1[:1], *_E1[2:])
        + ", row_number() OVER (ORDER BY sqrt(avg(pow(label - prediction, 2))), model) AS model_rank FROM predicted GROUP BY model)"
        " ON mae, rmse, r2 INTO NAME metric VALUE value)",
        *PREDICTED,
    ),
)

"""Model cards: the facts of a run and what its metrics and parameters suggest, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import seconds_between

# Model type by experiment kind and the parameters present, first match wins.
MODEL_TYPES = (
    ("Regression", ("alpha",), "Linear Regression with Regularization (Ridge/Lasso)"),
    ("Regression", ("n_estimators", "learning_rate"), "Gradient Boosting Regressor (XGBoost)"),
    ("Regression", ("n_estimators",), "Random Forest Regressor"),
    ("Regression", (), "Linear Regression"),
    ("Classification", ("C",), "Logistic Regression Classifier"),
    ("Classification", ("hidden_layer_sizes",), "Multi-Layer Perceptron (Neural Network)"),
    ("Classification", ("n_estimators",), "Tree-based Classifier (Random Forest or XGBoost)"),
    ("Classification", (), "Classification Model"),
    ("Clustering", ("n_clusters",), "K-Means Clustering"),
    ("Clustering", ("n_components",), "Gaussian Mixture Model"),
    ("Clustering", (), "Clustering Model"),
)
OTHER_TYPE = "Machine Learning Model"

# Grades by lower limit.
R2_GRADES = ((0.9, "Excellent"), (0.8, "Good"), (0.6, "Moderate"))
AUC_GRADES = ((0.9, "Excellent"), (0.8, "Good"), (0.7, "Fair"))
GENERAL_ADVICE = ("Cross-Validation", "Ensemble Methods", "Monitoring")


def _experiment(kind: str) -> Column:
    return F.col("experiment_name").contains(kind)


def _param(name: str) -> Column:
    return F.map_contains_key("params", name)


def _whole(name: str) -> Column:
    return F.col("params")[name].try_cast("int")


def _metric(name: str) -> Column:
    """The metric, 0 when the run does not have it."""
    return F.coalesce(F.col("metrics")[name], F.lit(0.0))


def model_type() -> Column:
    label = F.lit(None).cast("string")
    for kind, params, name in reversed(MODEL_TYPES):
        match = _experiment(kind)
        for p in params:
            match = match & _param(p)
        label = F.when(match, name).otherwise(label)
    return F.coalesce(label, F.lit(OTHER_TYPE))


def _grade(value: Column, grades) -> Column:
    label = F.lit("Poor")
    for limit, name in reversed(grades):
        label = F.when(value > limit, name).otherwise(label)
    return F.when(value > 0, label)


def _row(section: str, text: Column, condition: Column | None = None) -> Column:
    shown = text if condition is None else F.when(condition, text)
    return F.struct(F.lit(section).alias("section"), shown.alias("text"))


def model_cards(runs: DataFrame) -> DataFrame:
    """(run_id, section, text) for every run at once."""
    regression, classification = _experiment("Regression"), _experiment("Classification")
    r2, auc, accuracy = _metric("r2"), _metric("roc_auc"), _metric("accuracy")
    trees, depth = _whole("n_estimators"), _whole("max_depth")
    seconds = seconds_between(F.col("start_time"), F.col("end_time")).cast("decimal(20,2)")
    duration = F.concat(seconds.cast("string"), F.lit(" seconds"))
    tradeoff = F.col("metrics")["f1_score"].isNotNull() & (
        F.abs(_metric("precision") - _metric("recall")) > 0.1
    )
    insights = [
        ("High Complexity", trees > 200),
        ("Low Complexity", trees < 50),
        ("Deep Trees", depth > 15),
        ("Shallow Trees", depth < 5),
        ("Strong Predictive Power", F.col("metrics")["r2"] > 0.85),
        ("Precision-Recall Tradeoff", tradeoff),
    ]
    nothing = F.lit(True)
    for _, found in insights:
        nothing = nothing & ~F.coalesce(found, F.lit(False))
    advice = [
        ("Feature Engineering", regression & (r2 < 0.8)),
        ("Hyperparameter Tuning", regression & (r2 < 0.8)),
        ("Outlier Handling", regression & (_metric("rmse") > 5)),
        ("Data Quality", classification & (accuracy < 0.75)),
        ("Feature Selection", classification & (accuracy < 0.75)),
        *[(name, F.lit(True)) for name in GENERAL_ADVICE],
    ]
    rows = [
        _row("name", F.coalesce("run_name", F.lit("Unknown Model"))),
        _row("experiment", F.col("experiment_name")),
        _row("training date", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")),
        _row("training duration", F.coalesce(duration, F.lit("N/A"))),
        _row("model type", model_type()),
        _row("performance", _grade(r2, R2_GRADES), regression),
        _row("performance", _grade(auc, AUC_GRADES), classification),
        *[_row("insight", F.lit(name), found) for name, found in insights],
        _row("insight", F.lit("Model trained successfully"), nothing),
        *[_row("recommendation", F.lit(name), found) for name, found in advice],
    ]
    cards = runs.select("run_id", F.inline(F.array(*rows)))
    return cards.filter(F.col("text").isNotNull())


def card_values(runs: DataFrame) -> DataFrame:
    """(run_id, section, name, value): the parameter and metric tables of the cards."""
    params = runs.select(
        "run_id",
        F.lit("hyperparameters").alias("section"),
        F.explode("params").alias("name", "value"),
    )
    metrics = runs.select(
        "run_id", F.lit("metrics").alias("section"), F.explode("metrics").alias("name", "number")
    ).select("run_id", "section", "name", F.format_string("%.6f", "number").alias("value"))
    return params.unionByName(metrics).filter(F.col("value").isNotNull())

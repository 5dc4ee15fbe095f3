"""Metrics over tables of labels, predictions and scores."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.ordered import running_totals
from meterline.operators.profile import bin_index, histogram
from meterline.operators.quantiles import quantiles

def _regression_aggregates():
    error = F.col("label") - F.col("prediction")
    absolute, squared = F.avg(F.abs(error)), F.avg(error * error)
    return absolute, squared, 1 - F.try_divide(squared, F.var_pop("label"))


def regression_metrics(df: DataFrame) -> DataFrame:
    """mae, mse, rmse and r2 over (label, prediction)."""
    mae, mse, r2 = _regression_aggregates()
    return df.agg(
        mae.alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), r2.alias("r2")
    )


def compare_regressors(df: DataFrame) -> DataFrame:
    """mae, rmse, r2 and mape per model, best rmse first.

    The percentage error skips labels of 0 and reports how many it skipped.
    """
    mae, mse, r2 = _regression_aggregates()
    share = F.abs(F.try_divide(F.col("label") - F.col("prediction"), F.col("label")))
    return (
        df.groupBy("model")
        .agg(
            mae.alias("mae"),
            F.sqrt(mse).alias("rmse"),
            r2.alias("r2"),
            (F.avg(share) * 100).alias("mape"),
            F.count_if(F.col("label") == 0).alias("zero_labels"),
        )
        .orderBy("rmse", "model")
    )


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _hits(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and f1 per model; a zero denominator gives 0."""
    yes, said = F.col("label") == 1, F.col("prediction") == 1
    counts = df.groupBy("model").agg(
        F.count("*").cast("double").alias("n"),
        F.count_if(yes & said).cast("double").alias("tp"),
        F.count_if(~yes & said).cast("double").alias("fp"),
        F.count_if(yes & ~said).cast("double").alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "model",
        _ratio(F.col("n") - fp - fn, F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def roc_auc(df: DataFrame) -> DataFrame:
    """Exact area under the ROC curve per model by the rank sum; null with one class only.

    Rows collapse per score first; the running count of negatives is a distributed prefix sum.
    Rows without a score have no rank and are left out.
    """
    per_score = df.where(F.col("score").isNotNull()).groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    ranked = running_totals(per_score, ["score"], ["neg"], ["model"])
    wins = F.col("pos") * (F.col("neg_running") - F.col("neg") / 2.0)
    return ranked.groupBy("model").agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")
    )


def compare_classifiers(df: DataFrame) -> DataFrame:
    """Metrics and area per model over (model, label, prediction, score), best f1 first.

    ``unscored`` counts the rows without a score; they count for all metrics but the area.
    """
    # both sides have one row per model
    hits = _hits(df).withColumnRenamed("model", "_model")
    both = hits.join(roc_auc(df), F.col("_model").eqNullSafe(F.col("model")), "left")
    unscored = df.groupBy(F.col("model").alias("_name")).agg(
        F.count_if(F.col("score").isNull()).alias("unscored")
    )
    both = both.join(unscored, F.col("_model").eqNullSafe(F.col("_name")))
    named = both.drop("model", "_name").withColumnRenamed("_model", "model")
    return named.orderBy(F.col("f1_score").desc(), "model")


def binary_metrics(df: DataFrame) -> DataFrame:
    one = df.withColumn("model", F.lit("model"))
    return compare_classifiers(one).drop("model")


def confusion_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "prediction").agg(F.count("*").alias("row_count"))


def roc_points(df: DataFrame, bins: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score; rows without a score are left out.

    The rates are running totals from the highest score down, found as distributed prefix sums.
    ``bins`` asks for that many equal bins of scores in 0..1 instead.
    """
    at = F.col("score")
    if bins is not None:
        at = F.least(F.floor(at * bins), F.lit(bins - 1)) / float(bins)
    per_score = (
        df.where(F.col("score").isNotNull())
        .groupBy(at.alias("threshold"))
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") != 1).alias("neg"),
        )
    )
    whole = per_score.agg(F.sum("pos"), F.sum("neg")).first()
    down = running_totals(
        per_score.withColumn("_down", -F.col("threshold")), ["_down"], ["pos", "neg"]
    )

    def rate(name: str, total: int | None):
        return F.try_divide(F.col(f"{name}_running").cast("double"), F.lit(float(total or 0)))

    return down.select(
        "threshold", rate("neg", whole[1]).alias("fpr"), rate("pos", whole[0]).alias("tpr")
    )


def classification_report(df: DataFrame) -> DataFrame:
    """(class, precision, recall, f1_score, support) with macro and weighted means."""
    cells = confusion_matrix(df)
    seen = cells.groupBy(F.col("label").cast("string").alias("class")).agg(
        F.sum("row_count").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("row_count"))).alias("tp"),
    )
    said = cells.groupBy(F.col("prediction").cast("string").alias("class")).agg(
        F.sum("row_count").alias("predicted")
    )
    tp = F.coalesce(F.col("tp"), F.lit(0)).cast("double")
    support = F.coalesce(F.col("support"), F.lit(0))
    predicted = F.coalesce(F.col("predicted"), F.lit(0))
    classes = seen.join(said, "class", "full").select(
        "class",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, predicted + support).alias("f1_score"),
        support.alias("support"),
    )
    names = ("precision", "recall", "f1_score")
    macro = classes.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = classes.agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return classes.unionByName(macro.withColumn("class", F.lit("macro avg"))).unionByName(
        weighted.withColumn("class", F.lit("weighted avg"))
    )


def residual_cells(df: DataFrame, x: str = "prediction", y: str = "residual", bins: int = 50):
    """(x_bin, y_bin, row_count): a scatter plot as counts in a grid."""
    values = df.withColumn("residual", F.col("label") - F.col("prediction"))
    edge = values.agg(
        F.min(x).alias("xl"), F.max(x).alias("xh"), F.min(y).alias("yl"), F.max(y).alias("yh")
    ).first()
    cells = values.select(
        bin_index(F.col(x), edge["xl"], edge["xh"], bins).alias("x_bin"),
        bin_index(F.col(y), edge["yl"], edge["yh"], bins).alias("y_bin"),
    )
    return cells.groupBy("x_bin", "y_bin").agg(F.count("*").alias("row_count"))


def residual_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(
        df.select((F.col("label") - F.col("prediction")).alias("residual")), ["residual"], bins
    )


def normal_qq(df: DataFrame, points: int = 99) -> DataFrame:
    """(prob, theoretical, residual): quantiles of the residuals against the normal ones."""
    residual = df.select((F.col("label") - F.col("prediction")).alias("residual"))
    probs = [(i + 1) / (points + 1) for i in range(points)]
    found = quantiles(residual, ["residual"], probs)["residual"]
    normal = NormalDist()
    rows = [(p, normal.inv_cdf(p), q) for p, q in zip(probs, found, strict=True)]
    return df.sparkSession.createDataFrame(rows, "prob double, theoretical double, residual double")


def rank_importance(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Rank (model, feature, importance) within each model."""
    by = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    ranked = df.withColumn("importance_rank", F.row_number().over(by))
    return ranked if top_n is None else ranked.filter(F.col("importance_rank") <= top_n)


def evaluation_report(comparison: DataFrame, metrics: Sequence[str], primary: str, lower: bool):
    """(model, model_rank, metric, value): the comparison as rows, rank 1 is the best model."""
    order = F.col(primary).asc() if lower else F.col(primary).desc()
    # one row per model
    ranked = comparison.withColumn(
        "model_rank", F.row_number().over(Window.orderBy(order, F.col("model")))
    )
    return ranked.unpivot(["model", "model_rank"], list(metrics), "metric", "value")

"""Linear models from moments against closed forms, and cross-validation against refits."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from meterline.learn import moments


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4)) * [1, 30, 0.5, 2] + [0, 1e6, -74, 3]
    y = x @ [2.0, -0.1, 0.0, 0.5] + 4 + rng.normal(size=500)
    rows = [(f"k{i}", *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "key string, a double, b double, c double, `d.e` double, y double")
    return df.repartition(3).cache(), x, y


COLUMNS = ["a", "b", "c", "d.e"]


def centred(x, y):
    return x - x.mean(axis=0), y - y.mean()


def test_moments_add_up(data):
    df, x, y = data
    fold = moments.fold_of(["key"], 3)
    parts = moments.moments(df, COLUMNS, "y", fold)
    whole = moments.moments(df, COLUMNS, "y")["all"]
    together = moments.total(parts)
    z = np.column_stack([x, y])
    assert whole.n == together.n == 500 and len(parts) == 3
    for m in (whole, together):
        assert m.means == pytest.approx(z.mean(axis=0), rel=1e-12)
        assert m.scatter == pytest.approx(np.cov(z.T, ddof=0) * 500, rel=1e-9)
    assert (together - parts["1"]).n == 500 - parts["1"].n


def test_solvers_reach_their_optimum(data):
    df, x, y = data
    m = moments.moments(df, COLUMNS, "y")["all"]
    xc, yc = centred(x, y)
    for alpha in (0.0, 3.0):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
        assert moments.ridge(m, COLUMNS, alpha).weights == pytest.approx(want, rel=1e-8)
    for alpha in (0.01, 0.5, 3.0, 1e9):
        w = moments.lasso(m, COLUMNS, alpha).weights
        slope = xc.T @ (yc - xc @ w) / 500
        assert np.all(np.abs(slope) <= alpha + 1e-8 * np.abs(xc).max())
        assert slope[w != 0] == pytest.approx(alpha * np.sign(w[w != 0]), abs=1e-6)
    assert not moments.lasso(m, COLUMNS, 1e9).weights.any()


def test_errors_follow_from_moments(data):
    df, x, y = data
    m = moments.moments(df, COLUMNS, "y")["all"]
    fit = moments.lasso(m, COLUMNS, 0.3)
    left = y - x @ fit.weights - fit.intercept
    found = fit.errors(m)
    assert found["rmse"] == pytest.approx(np.sqrt((left**2).mean()), rel=1e-9)
    assert found["r2"] == pytest.approx(1 - (left**2).mean() / y.var(), rel=1e-9)
    assert fit.errors(m - m)["rmse"] is None


def test_singular_and_constant_columns(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=80)
    rows = [(float(v), float(2 * v), 7.0, float(3 * v + 1)) for v in a]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    m = moments.moments(df, ["a", "b", "c"], "y")["all"]
    for fit in (moments.least_squares(m, "abc"), moments.lasso(m, "abc", 0.0), moments.ridge(m, "abc", 1e-9)):
        assert np.isfinite(fit.weights).all() and fit.weights[2] == pytest.approx(0, abs=1e-6)
        assert fit.errors(m)["rmse"] < 1e-4


def test_cross_validation_equals_refits(data):
    df, x, y = data
    folds = {r["key"]: r["f"] for r in df.select("key", moments.fold_of(["key"]).alias("f")).collect()}
    fold = np.array([folds[f"k{i}"] for i in range(500)])
    scores = moments.cross_validate(df, COLUMNS, "y", ["key"])
    found = {(r.model, r.alpha, r.fold): r for r in scores.collect()}
    assert len(found) == 11 * 5
    for f in range(5):
        train, test = fold != f, fold == f
        xc, yc = centred(x[train], y[train])
        for name, alpha in (("LinearRegression", None), ("Ridge", 10.0)):
            w = np.linalg.solve(xc.T @ xc + (alpha or 0) * np.eye(4), xc.T @ yc)
            left = (y[test] - y[train].mean()) - (x[test] - x[train].mean(axis=0)) @ w
            r = found[name, alpha, f]
            assert (r.train_rows, r.test_rows) == (train.sum(), test.sum())
            assert r.rmse == pytest.approx(np.sqrt((left**2).mean()), rel=1e-6)
    best = {r.model: r for r in moments.best_parameters(scores).collect()}
    assert set(best) == set(moments.GRIDS) and best["Lasso"].folds == 5
    means = {}
    for (name, alpha, _), r in found.items():
        means.setdefault((name, alpha), []).append(r.rmse)
    assert best["Lasso"].mean_rmse == pytest.approx(
        min(np.mean(v) for (n, _), v in means.items() if n == "Lasso")
    )


def test_missing_cells(spark, data):
    df, _, _ = data
    holed = df.withColumn("a", F.when(F.col("key") != "k7", F.col("a"))).withColumn(
        "split", F.when(F.col("key").endswith("3"), "test").otherwise("train")
    )
    parts = moments.moments(holed, COLUMNS, "y", F.col("split"))
    assert parts["train"].incomplete == 1 and parts["test"].incomplete == 0
    filled, rows = moments.complete_moments(holed, COLUMNS, "y")
    assert sum(m.n for m in filled.values()) == 500 == rows.where("a IS NOT NULL").count()
    assert moments.moments(df.limit(0), COLUMNS, "y") == {}
    assert moments.cross_validate(df.limit(0), COLUMNS, "y", ["key"]).count() == 0
    with pytest.raises(ValueError, match="groups"):
        moments.MAX_GROUPS, kept = 2, moments.MAX_GROUPS
        try:
            moments.moments(df, COLUMNS, "y", F.col("key"))
        finally:
            moments.MAX_GROUPS = kept


def test_scorer_is_saved_and_loaded(data, tmp_path):
    df, x, y = data
    m = moments.moments(df, COLUMNS, "y")["all"]
    fit = moments.least_squares(m, COLUMNS)
    path = str(tmp_path / "model")
    fit.pipeline().write().overwrite().save(path)
    loaded = PipelineModel.load(path).transform(df).agg(F.avg(F.abs(F.col("y") - F.col("prediction"))))
    want = np.abs(y - x @ fit.weights - fit.intercept).mean()
    assert loaded.first()[0] == pytest.approx(want, rel=1e-9)

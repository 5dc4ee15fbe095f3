import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows
from meterline.learn import clusters, evaluation, lloyd, models, prep, reduction


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(300, 4)) * [1, 3, 0.5, 2]
    y = x @ [2.0, -1.0, 0.0, 0.5] + 4 + rng.normal(size=300)
    data = [([float(v) for v in r], float(t), int(t > 4)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(data, "x array<double>, label double, high int")
    return df.withColumn("features", array_to_vector("x")).repartition(3).cache(), x, y


def test_linear_and_ridge_closed_forms(table):
    df, x, y = table
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for model, penalty in ((models.linear(df), 0.0), (models.ridge(df, 7.0), 7.0)):
        want = np.linalg.solve(xc.T @ xc + penalty * np.eye(4), xc.T @ yc)
        assert model.coefficients.toArray() == pytest.approx(want, abs=1e-8)


def test_lasso_is_at_its_optimum(table):
    df, x, y = table
    w = models.lasso(df, 0.5).coefficients.toArray()
    xc, yc = x - x.mean(axis=0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y)
    assert np.all(np.abs(slope) <= 0.5 + 1e-4)
    assert slope[w != 0] == pytest.approx(0.5 * np.sign(w[w != 0]), abs=1e-4)
    assert (w == 0).any()


def test_logistic_is_at_its_optimum(table):
    df, x, _ = table
    named = df.select("features", F.col("high").cast("double").alias("label"))
    model = models.logistic(named, C=1.0)
    label = np.array([r["label"] for r in named.collect()])
    data = np.array([r["features"].toArray() for r in named.collect()])
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(data @ w + model.intercept)))
    assert data.T @ (p - label) + w == pytest.approx(np.zeros(4), abs=0.05)


def test_trees_score_and_rank(spark, table):
    df, _, _ = table
    model = models.rf_regressor(df, n_estimators=10, max_depth=5)
    found = evaluation.regression_metrics(models.predict(model, df, "rf")).first()
    assert found["r2"] > 0.5
    ranked = evaluation.rank_importance(models.importance(spark, model, list("abcd"), "rf"), 2)
    assert {r["feature"] for r in ranked.collect()} <= {"a", "b", "d"}


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(1)
    data = [("m", int(rng.integers(0, 2)), float(rng.integers(0, 12)) / 12) for _ in range(200)]
    data += [("ties", i % 2, 0.5) for i in range(20)] + [("one", 1, 0.3)]
    df = spark.createDataFrame(data, "model string, label int, score double").repartition(5)
    found = {r["model"]: r["roc_auc"] for r in evaluation.roc_auc(df).collect()}
    pos = [s for m, y, s in data if m == "m" and y == 1]
    neg = [s for m, y, s in data if m == "m" and y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert found["m"] == pytest.approx(wins / len(pos) / len(neg))
    assert found["ties"] == 0.5 and found["one"] is None


def test_labels_of_zero_are_skipped(spark):
    df = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 1.0)], "model string, label double, prediction double")
    found = evaluation.compare_regressors(df).first()
    assert (found["mape"], found["zero_labels"]) == (50.0, 1)


def test_separation_by_brute_force(spark):
    rng = np.random.default_rng(5)
    points = np.vstack([rng.normal(c, 1.0, size=(40, 2)) for c in (0, 6, 15)])
    labels = np.repeat([0, 1, 2], 40)
    df = spark.createDataFrame(
        [(int(k), float(a), float(b)) for k, (a, b) in zip(labels, points, strict=True)],
        "cluster int, a double, b double",
    )
    found = clusters.separation(df, ["a", "b"]).first()
    mids = np.array([points[labels == k].mean(axis=0) for k in range(3)])
    s = [np.linalg.norm(points[labels == k] - mids[k], axis=1).mean() for k in range(3)]
    db = np.mean(
        [max((s[i] + s[j]) / np.linalg.norm(mids[i] - mids[j]) for j in range(3) if j != i) for i in range(3)]
    )
    within = sum(((points[labels == k] - mids[k]) ** 2).sum() for k in range(3))
    between = 40 * ((mids - points.mean(axis=0)) ** 2).sum()
    assert found["davies_bouldin_score"] == pytest.approx(db)
    assert found["calinski_harabasz_score"] == pytest.approx(between / 2 / (within / 117))
    lone = clusters.separation(df.filter("cluster = 1"), ["a", "b"]).first()
    assert lone["davies_bouldin_score"] is None


def test_discriminant_separates_and_agrees_with_numpy(spark):
    rng = np.random.default_rng(9)
    points = np.vstack([rng.normal(c, 1.0, size=(60, 3)) for c in ((0, 0, 0), (3, 1, 0), (0, 4, 1))])
    points = np.hstack([points, np.zeros((180, 1))])  # a constant feature
    labels = np.repeat([0.0, 1.0, 2.0], 60)
    df = spark.createDataFrame(
        [(float(k), [float(v) for v in p]) for k, p in zip(labels, points, strict=True)],
        "label double, x array<double>",
    ).select("label", array_to_vector("x").alias("features"))
    found = reduction.linear_discriminant(df.repartition(4), 4)
    assert found.count == 2 and found.ratios.sum() == pytest.approx(1)
    out = reduction.discriminate(found, df)
    assert reduction.accuracy(out).first()[0] > 0.9
    mids = np.array([points[labels == k].mean(axis=0) for k in range(3)])
    within = sum((points[labels == k] - mids[int(k)]).T @ (points[labels == k] - mids[int(k)]) for k in range(3)) / 177
    solved = np.linalg.pinv(within) @ (mids - points.mean(axis=0)).T
    scores = (points - points.mean(axis=0)) @ solved - 0.5 * np.einsum("ij,ji->i", mids - points.mean(axis=0), solved)
    want = scores.argmax(axis=1)
    got = {tuple(r["features"].toArray()): r["prediction"] for r in out.collect()}
    assert [got[tuple(p)] for p in points] == list(want)


def test_components_reach_the_variance(spark, table):
    df, x, _ = table
    found = reduction.pca(df, list("abcd"), variance=0.9)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    share = np.cumsum(values / values.sum())
    assert found.count == int(np.searchsorted(share, 0.9, side="right")) + 1
    top = reduction.top_features(reduction.loadings(spark, found), 1)
    assert rows(top.filter("component = 1"), "feature") == [("b",)]


def test_split_ignores_partitioning(spark):
    df = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    a = rows(prep.assign_split(df.repartition(1), ["k"]), "id", "split")
    assert a == rows(prep.assign_split(df.repartition(7), ["k"]), "id", "split")
    share = sum(s == "train" for _, s in a) / 5000
    assert math.isclose(share, 0.7, abs_tol=0.03)


def test_constant_columns_scale_by_one(spark):
    df = spark.createDataFrame([(0.3,)] * 7, "x double").repartition(3)
    assert prep.fit_scales(df, ["x"])["x"] == (pytest.approx(0.3), 1.0)


def test_kmeans_restarts_share_their_passes(spark):
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(5, 3)) * 8
    points = np.vstack([rng.normal(m, 0.3, size=(60, 3)) for m in middles])
    df = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["features"]).repartition(4)
    found = lloyd.fit_many(df, [2, 5], restarts=8)
    assert set(found) == {2, 5} and found[5].cost < found[2].cost
    nearest = ((points[:, None] - found[5].points) ** 2).sum(axis=2)
    assert found[5].cost == pytest.approx(nearest.min(axis=1).sum(), rel=1e-6)
    placed = sorted(r["cluster"] for r in clusters.assign(found[5], df).collect())
    assert placed == sorted(nearest.argmin(axis=1).tolist())
    for i in range(5):
        assert found[5].points[i] == pytest.approx(points[nearest.argmin(axis=1) == i].mean(axis=0), abs=0.01)


def test_far_groups_get_clusters_of_their_own(spark):
    """Groups of three rows far away, in a table of which a third is one vector."""
    rng = np.random.default_rng(7)
    far = np.array([[400.0, 0.0], [0.0, -500.0], [-450.0, 450.0]])
    crowd = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.rand(1)).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(2)).alias("b"),
    )
    points = [tuple(map(float, f + d)) for f in far for d in rng.normal(0, 0.1, size=(3, 2))]
    df = crowd.unionByName(spark.createDataFrame(points, "a double, b double"))
    df = prep.assemble(df, ["a", "b"]).select("features")
    found = lloyd.fit_many(df, [4], restarts=3)[4]
    gaps = np.sqrt(((far[:, None] - found.points) ** 2).sum(axis=2)).min(axis=1)
    assert gaps.max() < 1.0
    drawn, weights = lloyd.candidates(lloyd.weighted(df).cache(), 4, 42)
    assert len(drawn) < 3 * lloyd.ROUNDS * lloyd.OVERSAMPLE * 4
    assert weights.sum() == 90_009


def test_kmeans_of_few_distinct_rows(spark):
    df = prep.assemble(spark.createDataFrame([(1.0,), (1.0,), (5.0,)], "a double"), ["a"])
    found = lloyd.fit_many(df, [2, 3], restarts=2)
    assert sorted(found[2].points.ravel()) == [1.0, 5.0] and found[2].cost == 0
    assert set(found[3].points.ravel()) == {1.0, 5.0}
    with pytest.raises(ValueError, match="no rows"):
        lloyd.fit_many(df.limit(0), [2])


def test_a_pass_reads_packed_blocks(spark):
    """Sizes, sums and costs of runs of several widths, from blocks that hold many weighted rows each."""
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(9000, 3)), rng.integers(1, 5, 9000)
    rows = spark.createDataFrame(
        [(p.tolist(), int(n)) for p, n in zip(x, w, strict=True)], "x array<double>, w long"
    ).repartition(2)
    blocks = lloyd.packed(rows).cache()
    assert blocks.count() <= 4
    runs = [rng.normal(size=(k, 3)) for k in (1, 4, 2)]
    for centres, (sizes, sums, cost) in zip(runs, lloyd._pass(blocks, runs), strict=True):
        distance = ((x[:, None] - centres) ** 2).sum(axis=2)
        own = distance.argmin(axis=1)
        assert sizes.tolist() == [w[own == i].sum() for i in range(len(centres))]
        want = [(x * w[:, None])[own == i].sum(axis=0) for i in range(len(centres))]
        assert np.allclose(sums, want)
        assert cost == pytest.approx((distance.min(axis=1) * w).sum())

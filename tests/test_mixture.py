import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meterline.learn import clusters, lloyd, mixture
from meterline.learn.stages import scaled_pipeline


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(5)
    middles = np.array([[0.0, 0.0], [6.0, 1.0], [1.0, 7.0]])
    x = np.vstack([m + random.normal(size=(200, 2)) * [1.0, 0.5] for m in middles])
    # the last column is constant: covariances are singular
    rows = [(float(a), float(b), float(c), 0.0) for (a, b), c in zip(x, random.normal(size=len(x)), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    df = df.withColumn("features", array_to_vector(F.array("a", "b", "c", "d"))).coalesce(2).persist()
    yield df
    df.unpersist()


def test_the_fit_is_that_of_spark(table):
    theirs = GaussianMixture(k=3, maxIter=4, seed=42).fit(table)
    own = clusters.gaussian_mixture(table, 3, max_iter=4)
    assert own.getK() == 3 and own.summary.numIter == theirs.summary.numIter
    assert own.summary.logLikelihood == pytest.approx(theirs.summary.logLikelihood, rel=1e-9)
    assert np.allclose(own.weights, theirs.weights, atol=1e-9)
    for a, b in zip(own.gaussians, theirs.gaussians, strict=True):
        assert np.allclose(a.mean.toArray(), b.mean.toArray(), atol=1e-7)
        assert np.allclose(a.cov.toArray(), b.cov.toArray(), atol=1e-7)
    columns = ["a", "b", "prediction", "probability"]
    for a, b in zip(
        own.transform(table).select(columns).collect(), theirs.transform(table).select(columns).collect(), strict=True
    ):
        assert a[:3] == b[:3] and np.allclose(a[3].toArray(), b[3].toArray(), atol=1e-7)


def test_fits_of_many_k_share_their_passes(table, monkeypatch):
    passes = []
    one_pass = mixture._pass
    monkeypatch.setattr(mixture, "_pass", lambda *a: passes.append(len(a[1])) or one_pass(*a))
    found = mixture.fit_many(table, [2, 3], max_iter=4)
    steps = [m.summary.numIter for m in found.values()]
    assert len(passes) == max(steps) and sum(passes) == sum(steps)
    for k, model in found.items():
        alone = clusters.gaussian_mixture(table, k, max_iter=4)
        assert model.summary.logLikelihood == pytest.approx(alone.summary.logLikelihood, rel=1e-12)


def test_a_saved_mixture_gives_the_same_components(table, tmp_path):
    names = ["a", "b", "c", "d"]
    model = clusters.gaussian_mixture(table, 3, max_iter=2)
    pipeline = scaled_pipeline(model, names, {n: (0.0, 1.0) for n in names})
    pipeline.write().overwrite().save(str(tmp_path / "mixture"))
    loaded = PipelineModel.load(str(tmp_path / "mixture"))
    again = [tuple(r) for r in loaded.transform(table.drop("features")).select("a", "prediction").collect()]
    assert again == [tuple(r) for r in model.transform(table).select("a", "prediction").collect()]


def test_one_centre_takes_no_candidate_rounds(table, monkeypatch):
    monkeypatch.setattr(lloyd, "_drawn", lambda *a: pytest.fail("one cluster needs no candidates"))
    found = lloyd.fit_many(table, [1], restarts=2)[1]
    x = np.array([r["features"].toArray() for r in table.select("features").collect()])
    assert found.passes == 2 and np.allclose(found.points[0], x.mean(axis=0))
    assert found.cost == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())

"""The scan over numbers of clusters: shared silhouettes and ties of a pass."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meterline.learn import clusters, lloyd


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(17)
    x = np.vstack([rng.normal(size=(150, 3)) + 4 * m for m in rng.normal(size=(4, 3))] + [np.full((1, 3), 60.0)])
    rows = [([float(v) for v in p],) for p in [*x, *x[:90]]]  # some rows stand twice
    df = spark.createDataFrame(rows, "x array<double>").select(array_to_vector("x").alias("features")).persist()
    yield df
    df.unpersist()


def test_the_scan_scores_as_the_evaluator_does(table):
    ks = [2, 3, 5, 6]
    found = lloyd.fit_many(table, ks, restarts=3)
    want = {k: clusters.silhouette_sq(clusters.assign(found[k], table)) for k in ks}
    got = {r["k"]: r["silhouette_sq"] for r in clusters.silhouette_scan(table, ks, restarts=3).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_the_scan_scores_all_k_in_two_passes(table, monkeypatch):
    monkeypatch.setattr(clusters, "silhouette_sq", lambda *a: pytest.fail("one k at a time"))
    with lloyd.ready(table) as (rows, blocks):
        found = lloyd.fit_ready(rows, blocks, [2, 3, 4], restarts=2)
        passes, summed = [], lloyd.summed
        monkeypatch.setattr(lloyd, "summed", lambda *a: passes.append(1) or summed(*a))
        assert len(lloyd.silhouettes(blocks, found)) == 3 and len(passes) == 2
    clusters.silhouette_scan(table, [2, 3], restarts=1).collect()


def test_empty_and_single_clusters(table):
    x = np.array([r["features"].toArray() for r in table.select("features").collect()])
    with lloyd.ready(table) as (_, blocks):
        # all rows in one cluster, a far centre without rows, a cluster of one row
        points = {
            2: np.array([x.mean(axis=0), np.full(3, 1e6)]),
            3: np.array([x[:-91].mean(axis=0), np.full(3, 1e6), np.full(3, 60.0)]),
        }
        found = {k: lloyd.Centres(p, 0.0, 1) for k, p in points.items()}
        scores = lloyd.silhouettes(blocks, found)
    assert scores[2] is None
    assert scores[3] == pytest.approx(clusters.silhouette_sq(clusters.assign(found[3], table)), rel=1e-9)


def test_the_first_of_equally_near_centres_takes_a_row(spark):
    df = spark.createDataFrame([([-1.0],), ([0.0],), ([0.0],), ([3.0],)], "x array<double>")
    rows = df.groupBy("x").agg(F.count("*").alias("w"))
    ((sizes, sums, cost),) = lloyd._pass(lloyd.packed(rows), [np.array([[-1.0], [1.0], [1.0]])])
    assert sizes.tolist() == [3, 1, 0] and sums.ravel().tolist() == [-1, 3, 0] and cost == 6

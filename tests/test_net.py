"""The net: slopes against differences, learning, early stopping, saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from meterline.learn import models, net, prep


def test_slope_equals_differences():
    rng = np.random.default_rng(1)
    layers = [4, 6, 5, 3]
    _, loss_and_slope = net.net_functions(layers, penalty=0.1)
    flat = net.start_weights(layers, 2)
    x, y = rng.normal(size=(12, 4)), rng.integers(0, 3, 12)
    _, slope = loss_and_slope(flat, x, y)
    assert len(slope) == len(flat) == net.sizes_of(layers)
    for i in rng.choice(len(flat), 30, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        near = (loss_and_slope(flat + step, x, y)[0] - loss_and_slope(flat - step, x, y)[0]) / 2e-6
        assert slope[i] == pytest.approx(near, abs=1e-6)


@pytest.fixture(scope="module")
def rings(spark):
    """Two classes that no line separates, in columns of very different size."""
    rng = np.random.default_rng(3)
    at = rng.uniform(-1, 1, size=(3000, 2))
    label = ((at**2).sum(axis=1) < 0.5).astype(float)
    rows = [(float(a * 1e5 + 7e6), float(b), 3.0, float(c)) for (a, b), c in zip(at, label, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(4)
    return prep.assemble(df, ["a", "b", "c"]).cache()


def test_net_learns_and_stops(spark, rings, tmp_path, monkeypatch):
    monkeypatch.setattr(net, "BATCH", 20)
    fit = net.fit_net(rings, hidden=(24, 12), max_epochs=60)
    first, last = fit.curve[0], fit.curve[-1]
    assert last[1] < first[1] / 2 and len(fit.curve) <= 60
    assert {r["epoch"] for r in fit.curve_table(spark).collect()} == set(range(1, len(fit.curve) + 1))
    scored = fit.model.transform(rings)
    right = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
    assert right > 0.95 and max(c[3] for c in fit.curve) > 0.94
    total = scored.select((F.abs(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b) - 1)).alias("e"))
    assert total.agg(F.max("e")).first()[0] < 1e-9
    path = str(tmp_path / "net")
    models.Trained("net", "classification", fit.model, ["a", "b", "c"]).pipeline().write().save(path)
    again = PipelineModel.load(path).transform(rings.drop("features"))
    both = scored.select(F.sum("prediction")).first(), again.select(F.sum("prediction")).first()
    assert both[0] == both[1]


def test_net_stops_early_without_signal(spark):
    rng = np.random.default_rng(4)
    rows = [(float(v), float(i % 2)) for i, v in enumerate(rng.normal(size=1200))]
    df = prep.assemble(spark.createDataFrame(rows, "a double, label double").repartition(2), ["a"])
    fit = net.fit_net(df.cache(), hidden=(8,))
    assert net.PATIENCE < len(fit.curve) < 300
    with pytest.raises(ValueError, match="no rows"):
        net.fit_net(df.limit(0))


def test_rows_are_read_once_whatever_the_epochs(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(v):
        seen.add(1)
        return v

    rng = np.random.default_rng(5)
    rows = [(float(v), float(i % 2)) for i, v in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "a double, label double").repartition(2)
    df = prep.assemble(df.withColumn("a", F.udf(note, "double")("a")), ["a"])
    fit = net.fit_net(df, hidden=(4,), max_epochs=6)
    assert len(fit.curve) == 6
    # the check for rows, the scales, and the packing
    assert seen.value <= 3 * len(rows)

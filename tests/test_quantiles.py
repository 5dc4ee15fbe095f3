import numpy as np
import pytest

from meterline.operators import quantiles as q


def frame(spark, values, parts=5):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(parts)


PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("parts", [1024, 3])
def test_quantiles_equal_numpy(spark, monkeypatch, parts):
    """Few and many parts a pass agree with linear interpolation."""
    monkeypatch.setattr(q, "PARTS", parts)
    rng = np.random.default_rng(7)
    values = np.round(rng.lognormal(3, 1, 4001), 6)
    found = q.quantiles(frame(spark, [*values, None, None]), ["x"], PROBS)["x"]
    assert found == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


@pytest.mark.parametrize("parts", [1024, 3])
def test_quantiles_with_a_hot_value(spark, monkeypatch, parts):
    monkeypatch.setattr(q, "PARTS", parts)
    values = [1.0] * 700 + list(np.arange(1300) / 7.0)
    found = q.quantiles(frame(spark, values), ["x"], PROBS)["x"]
    assert found == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_outliers_and_magnitudes(spark):
    """Values over all magnitudes, near-equal ones and the largest doubles take few passes."""
    rng = np.random.default_rng(3)
    values = [
        *rng.uniform(-1, 1, 300) * 10.0 ** rng.integers(-300, 300, 300),
        *(1e9 + rng.uniform(0, 1e-6, 300)),
        1.7e308,
        -1.7e308,
        5e-324,
    ]
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    found = q.quantiles(frame(spark, values), ["x"], probs)["x"]
    want = sorted(values)
    for p, v in zip(probs, found, strict=True):
        at = p * (len(want) - 1)
        low, high = want[int(np.floor(at))], want[int(np.ceil(at))]
        assert min(low, high) <= v <= max(low, high)
    assert found[0] == -1.7e308 and found[-1] == 1.7e308


def test_infinities_are_the_ends(spark):
    values = [float("-inf")] * 2 + [1.0, 2.0, 3.0] + [float("inf")] * 2 + [float("nan"), None]
    found = q.quantiles(frame(spark, values), ["x"], (0.0, 0.5, 1.0))["x"]
    assert found == [float("-inf"), 2.0, float("inf")]


def test_approximate_ranks(spark):
    values = np.random.default_rng(5).normal(size=5000)
    for accuracy in (100, 10_000):
        for p, v in zip(PROBS, q.approx_quantiles(frame(spark, values), ["x"], PROBS, accuracy)["x"], strict=True):
            assert v in values and abs((values < v).mean() - p) <= 1 / accuracy + 1 / 5000


def test_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert q.quantiles(df, ["a", "b"], (0.5,)) == {"a": [None], "b": [2.0]}
    assert q.quantiles(df.filter("b > 9"), ["b"], (0.5,)) == {"b": [None]}
    assert q.iqr_fences(df, ["a"]) == {"a": None}


def test_no_task_gathers_values(spark, monkeypatch):
    """Counts are grouped by (bracket, part): nothing but one row of ranges meets in one task."""
    plans = []
    true = type(frame(spark, [1])).collect

    def seen(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return true(self)

    monkeypatch.setattr(type(frame(spark, [1])), "collect", seen)
    q.quantiles(frame(spark, np.arange(999) ** 1.5), ["x"], PROBS)
    monkeypatch.undo()
    counted = [p for p in plans if "hashpartitioning(path" in p]
    assert counted
    for plan in counted:
        assert "percentile" not in plan and "SinglePartition" not in plan

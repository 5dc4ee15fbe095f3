import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from meterline.operators.ordered import lag_features, ordered_features, rolling_features, running_totals
from meterline.operators.sampling import sample_n


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    data = [
        # one key holds most of the rows
        (i, "hot" if i % 10 < 7 else f"k{i % 3}", int(rng.integers(0, 500)), None if i % 37 == 0 else float(i % 91))
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "id long, key string, t int, value double").repartition(7)


@pytest.mark.parametrize("key", [(), ("key",)])
@pytest.mark.parametrize("run_length", [10, 64, 100_000])
def test_lags_equal_a_plain_window(series, key, run_length):
    got = lag_features(series, "value", ["t", "id"], key, run_length=run_length)
    by = Window.partitionBy(*key).orderBy("t", "id")
    want = series.withColumns({f"value_lag_{p}": F.lag("value", p).over(by) for p in (1, 7, 30)})
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("key", [(), ("key",)])
def test_rolling_equals_a_plain_window(series, key):
    functions = ("mean", "min", "max", "sum")
    got = rolling_features(series, "value", ["t", "id"], key, (3, 8), functions, run_length=50)
    by = Window.partitionBy(*key).orderBy("t", "id")
    plain = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    new = {}
    for w in (3, 8):
        frame = by.rowsBetween(-(w - 1), 0)
        for name in functions:
            new[f"value_rolling_{w}_{name}"] = F.when(
                F.count("value").over(frame) == w, plain[name]("value").over(frame)
            )
    want = series.withColumns(new)
    assert rows(got, *want.columns) == rows(want)


def test_rolling_median(series):
    got = rolling_features(series, "value", ["t", "id"], windows=(4, 5), functions=("median",))
    frame = got.toPandas().sort_values(["t", "id"])
    for w in (4, 5):
        want = frame["value"].rolling(w).median()
        assert (frame[f"value_rolling_{w}_median"] - want).abs().max() == 0
        assert list(frame[f"value_rolling_{w}_median"].isna()) == list(want.isna())


def test_result_does_not_depend_on_partitioning(series):
    one = lag_features(series.repartition(1), "value", ["t", "id"], run_length=40)
    many = lag_features(series.repartition(13), "value", ["t", "id"], run_length=90)
    assert rows(one) == rows(many)


def test_no_task_holds_the_whole_table(series):
    got = ordered_features(series, "value", ["t", "id"], lags=(1,), windows=(7,), run_length=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_unknown_function_and_column(series):
    with pytest.raises(ValueError):
        rolling_features(series, "value", ["id"], functions=("mode",))
    assert lag_features(series, "nothing", ["id"]) is series


@pytest.mark.parametrize("key", [(), ("key",)])
def test_running_totals(series, key):
    data = series.select("id", "key", (F.col("id") % 5).alias("n"))
    got = running_totals(data, ["id"], ["n"], key)
    by = Window.partitionBy(*key).orderBy("id")
    want = data.withColumn("n_running", F.sum("n").over(by))
    assert rows(got, *want.columns) == rows(want)


def test_large_sample_equals_top_k(series):
    ids = series.select("id", "key")
    for n in (1, 400, 2500, 2999, 3000, 5000):
        small = sample_n(ids, n, ["id"])
        large = sample_n(ids, n, ["id"], top_k_limit=0 if n else 1)
        assert rows(small) == rows(large)
        assert small.count() == min(n, 3000)


def test_sample_of_copies_is_exact(spark):
    """A third of the rows are the same row."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    for n in (500, 1500, 2999):
        assert sample_n(df, n, ["id"], top_k_limit=10).count() == n
    again = rows(sample_n(df.repartition(9), 1500, ["id"], top_k_limit=10))
    assert again == rows(sample_n(df.repartition(1), 1500, ["id"], top_k_limit=10))


def test_sample_with_a_hot_key(spark):
    """All rows share the key, so the row hash decides; no row comes twice."""
    df = spark.range(2000).select(F.lit(1).alias("k"), "id")
    for limit in (10, 10_000):
        picked = sample_n(df, 700, ["k"], top_k_limit=limit)
        assert picked.count() == picked.distinct().count() == 700
    assert rows(sample_n(df, 700, ["k"], top_k_limit=10)) == rows(sample_n(df, 700, ["k"]))

"""Training rows are dealt evenly before a fit passes over them many times."""

from pyspark.sql import functions as F

from checks import learning
from meterline.learn import models, prep


def parts(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]


def one_part(spark, rows):
    return spark.range(0, rows, 1, 1).select(
        F.col("id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("label")
    )


def test_one_part_is_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    total = cores * prep.FEW_ROWS
    with prep.dealt(one_part(spark, total)) as rows:
        sizes = parts(rows)
        assert sum(sizes) == total and rows.select("id").distinct().count() == total
        assert not prep.uneven(sizes, cores)


def test_even_and_small_tables_stay(spark):
    cores = spark.sparkContext.defaultParallelism
    even = one_part(spark, cores * prep.FEW_ROWS).repartition(cores)
    with prep.dealt(even) as rows:
        assert rows is even
    small = one_part(spark, 50)
    with prep.dealt(small) as rows:
        assert rows is small and rows.count() == 50
    empty = one_part(spark, 50).filter("id < 0")
    with prep.dealt(empty) as rows:
        assert rows.count() == 0
    assert not prep.uneven([], cores)


def test_a_forest_takes_one_part_a_core(spark):
    cores = spark.sparkContext.defaultParallelism
    df = prep.assemble(one_part(spark, 3000).repartition(cores * 5), ["a"])
    assert models._gathered(df).rdd.getNumPartitions() == cores


def test_metrics_read_staged_predictions(spark, sf_dir, monkeypatch):
    seen = []
    compare = learning.evaluation.compare_classifiers

    def noted(df):
        seen.extend(df.inputFiles())
        return compare(df)

    monkeypatch.setattr(learning.evaluation, "compare_classifiers", noted)
    assert learning.ENTRIES["K1_logistic"][0](spark, sf_dir).count() == 1
    assert seen and all("/tested-" in path for path in seen)

"""Settings that the queries need on a session of any origin."""

from pyspark.sql import functions as F

from checks import properties, registry
from meterline.session import METHOD_LIMIT, tune

KEY = "spark.sql.codegen.hugeMethodLimit"


def test_queries_lower_the_method_limit_of_a_foreign_session(spark, sf_dir):
    before = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, "65535")
        registry.QUERIES["S1_month_paths"](spark, sf_dir)
        assert int(spark.conf.get(KEY)) == METHOD_LIMIT
        spark.conf.set(KEY, "4000")
        tune(spark)
        assert spark.conf.get(KEY) == "4000"
    finally:
        spark.conf.set(KEY, before)


def test_rows_by_vendor_are_cut_into_tasks(spark):
    """One vendor's rows are more than a task should read."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("vendor_id"), F.md5(F.col("id").cast("string")).alias("x"))
    try:
        spark.conf.set(size, "64k")
        part = F.spark_partition_id().alias("p")
        counts = [F.count("*").alias("n"), F.max("x").alias("last")]
        placed = properties.by_vendor(df).groupBy(part).agg(*counts).collect()
    finally:
        spark.conf.set(size, before)
    assert sum(r["n"] for r in placed) == 40_000
    assert len(placed) > 4 and max(r["n"] for r in placed) < 10_000

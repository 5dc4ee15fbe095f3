"""Plans: pushed filters, pruned columns, no Python, no single task over the rows."""

import pytest
from pyspark.sql import functions as F

from checks import fixture, registry
from conftest import rows
from meterline import schemas
from meterline.operators import features, trip, views
from meterline.sources.files import ingest_many
from meterline.streaming.rowlocal import trip_rows


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_feature_plan_has_no_shuffle_and_no_python(spark, sf_dir):
    text = plan(trip.all_features(fixture.usable(spark, sf_dir), with_interactions=True))
    assert "Python" not in text and "BatchEval" not in text
    assert text.count("Exchange") <= text.count("REPARTITION_BY_NUM") * 4


def test_summaries_read_only_their_columns(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    recent = views.recent_rows(
        orders.select("o_orderkey", "o_orderdate"), "o_orderdate", __import__("datetime").datetime(1999, 1, 1), 30, 10
    )
    text = plan(recent)
    assert "TakeOrderedAndProject" in text
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in text


def test_top_values_are_limited_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderstatus", "o_orderpriority")
    assert "WindowGroupLimit" in plan(features.top_values(orders))


def test_no_cross_joins(spark, sf_dir):
    for name in ("C6_cap_iqr", "C3_impute_median", "A4_payment_share", "Q5_histogram", "Q7_daily_counts"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_the_row_flow_accepts_a_stream(spark, sf_dir, tmp_path):
    source = str(tmp_path / "trips")
    batch = fixture.trips(spark, sf_dir)
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = (
        trip_rows(stream, keep=("trip_id",))
        .writeStream.format("memory")
        .queryName("streamed")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    want = trip_rows(spark.read.parquet(source), keep=("trip_id",))
    columns = ["trip_id", "speed_mph", "time_of_day", "distance_category"]
    assert rows(spark.table("streamed"), *columns) == rows(want, *columns)


def test_feature_table_has_52_columns(spark, sf_dir):
    """23 processed columns and 29 features."""
    processed = trip_rows(fixture.trips(spark, sf_dir))
    assert len(processed.columns) == 52


def test_bad_files_do_not_stop_the_others(spark, tmp_path):
    good = spark.createDataFrame([], schemas.SOURCE_TRIPS)
    good.write.parquet(str(tmp_path / "good.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "poor.parquet"))
    (tmp_path / "junk.parquet").write_text("no parquet")
    paths = [str(tmp_path / n) for n in ("good.parquet", "poor.parquet", "junk.parquet", "none.parquet")]
    found = ingest_many(spark, paths)
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in found.rejected.collect()}
    assert set(reasons) == {"poor.parquet", "junk.parquet", "none.parquet"}
    assert reasons["poor.parquet"].startswith("missing tpep_pickup_datetime")
    assert found.trips.count() == 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_every_sql_has_a_query(name):
    assert name in registry.QUERIES


def test_equal_metrics_keep_the_champion(spark):
    from meterline.tracking import runs

    table = spark.createDataFrame(
        [("a", {"rmse": 1.0, "r2": 0.5, "only": 1.0}), ("b", {"rmse": 1.0, "r2": 0.6})],
        "run_id string, metrics map<string,double>",
    )
    pairs = spark.createDataFrame([("a", "b")], "champion_id string, challenger_id string")
    faced = runs.champion_challenger(table, pairs)
    assert rows(faced, "metric", "winner") == [("only", None), ("r2", "challenger"), ("rmse", "champion")]
    assert runs.champion_verdict(faced).first()["verdict"] == "tie"
    assert faced.filter(F.col("metric") == "r2").first()["difference"] == pytest.approx(0.1)

"""Footers of many files: every path in exactly one list, with jobs that don't follow the files."""

import pytest
from pyspark.sql import functions as F

from checks import fixture
from meterline import schemas
from meterline.sources import footers
from meterline.sources.files import ingest_many


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("months")
    trips = fixture.trips(spark, sf_dir).select(*schemas.SOURCE_TRIPS.names).coalesce(1)
    for i in range(6):
        trips.where(F.col("VendorID") + F.col("PULocationID") % 5 == i + 1).write.parquet(
            str(root / f"m{i}.parquet")
        )
    trips.limit(0).write.parquet(str(root / "empty.parquet"))
    trips.drop("airport_fee").limit(7).write.parquet(str(root / "older.parquet"))
    trips.withColumn("passenger_count", F.lit(2).cast("int")).limit(5).write.parquet(
        str(root / "narrow.parquet")
    )
    spark.range(3).write.parquet(str(root / "poor.parquet"))
    (root / "junk.parquet").write_text("no parquet")
    trips.limit(4).write.parquet(str(root / "mixed.parquet"))
    trips.drop("extra").limit(4).write.mode("append").parquet(str(root / "mixed.parquet"))
    return root


def test_each_path_is_in_one_list(spark, folder):
    names = sorted(p.name for p in folder.iterdir()) + ["none.parquet"]
    paths = [str(folder / n) for n in names]
    found = ingest_many(spark, [*paths, paths[0]])
    files = {r["source_file"]: r["total_rows"] for r in found.files.collect()}
    rejected = {r["path"].rsplit("/", 1)[1] for r in found.rejected.collect()}
    assert set(files) | rejected == set(names) and not set(files) & rejected
    assert rejected == {"poor.parquet", "junk.parquet", "none.parquet"}
    assert files["empty.parquet"] == 0 and files["older.parquet"] == 7
    assert sum(files.values()) == found.trips.count()
    assert found.trips.where("source_file = 'narrow.parquet' AND passenger_count = 2").count() == 5


def test_layouts_are_read_once(spark, folder, monkeypatch):
    asked = []
    own = footers._by_spark
    monkeypatch.setattr(footers, "_by_spark", lambda s, p: asked.append(p) or own(s, p))
    paths = [str(folder / f"m{i}.parquet") for i in range(6)]
    found = footers.probe(spark, [*paths, f"file://{folder}/empty.parquet"])
    assert len(asked) == 1 and len({p.schema.json() for p in found}) == 1
    counted = {r["path"]: r["row_count"] for r in footers.footers(spark, paths).collect()}
    assert counted == {p: spark.read.parquet(p).count() for p in paths}


def test_stores_that_only_spark_reads(spark, folder):
    path = f"viewfs://nowhere{folder}/m0.parquet"
    assert footers.footers(spark, [path]).first()["reason"] is not None
    assert footers.probe(spark, [path])[0].schema is None
    assert footers.probe(spark, []) == []

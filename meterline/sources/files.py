"""Reading trip files and writing small exports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schemas
from meterline.functions.columns import nan_to_null
from meterline.sources.footers import file_name, probe

# File name prefixes of the two services.
FILE_PREFIX = {"yellow": "yellow_tripdata_", "green": "green_tripdata_"}


def month_files(year: int, start: int = 1, end: int = 12, service: str = "yellow") -> list[str]:
    """File names of the months start..end of a year."""
    if service not in FILE_PREFIX:
        raise ValueError(f"unknown service {service!r}")
    return [f"{FILE_PREFIX[service]}{year}-{m:02d}.parquet" for m in range(start, end + 1)]


def month_paths(folder: str, year: int, start: int = 1, end: int = 12, service: str = "yellow"):
    return [f"{folder.rstrip('/')}/{name}" for name in month_files(year, start, end, service)]


def scan_parquet(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read parquet files lazily; NaN becomes null."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.parquet(*paths))


@dataclass(frozen=True)
class Ingested:
    trips: DataFrame
    files: DataFrame
    rejected: DataFrame


FILE_REPORT = schemas.struct(("path", schemas.STRING), ("reason", schemas.STRING))


def _as_declared(df: DataFrame) -> DataFrame:
    declared = {f.name: f.dataType for f in schemas.SOURCE_TRIPS.fields}
    return df.select(
        *[
            F.expr(f"try_cast(`{c}` as {declared[c].simpleString()})").alias(c)
            if c in declared
            else F.col(c)
            for c in df.columns
        ]
    )


def ingest_many(spark: SparkSession, paths: Sequence[str]) -> Ingested:
    """Read many files as one table.

    Files are grouped by their footer schema, every group is one scan, and the scans are united
    by column name. A file that cannot be read or lacks an essential column is rejected with the
    reason and does not stop the others. ``files`` counts rows and dates per file, 0 rows for an
    empty one, so each path is in exactly one of ``files`` and ``rejected``. A path given twice counts once.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    rejected: list[tuple[str, str]] = []
    for found in probe(spark, paths):
        if found.schema is None:
            rejected.append((found.path, found.reason))
            continue
        lacking = [c for c in schemas.ESSENTIAL_SOURCE if c not in found.schema.names]
        if lacking:
            rejected.append((found.path, "missing " + ", ".join(lacking)))
            continue
        groups.setdefault(found.schema.json(), (found.schema, []))[1].append(found.path)

    trips = spark.createDataFrame([], schemas.SOURCE_TRIPS).withColumn(
        "source_file", F.lit(None).cast("string")
    )
    for schema, members in groups.values():
        part = spark.read.schema(schema).parquet(*members)
        part = part.withColumn("source_file", file_name(F.col("_metadata.file_path")))
        trips = trips.unionByName(_as_declared(nan_to_null(part)), allowMissingColumns=True)

    counted = trips.groupBy("source_file").agg(
        F.count("*").alias("total_rows"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_pickup_datetime").alias("last_pickup"),
    )
    read = [(p,) for _, members in groups.values() for p in members]
    names = spark.createDataFrame(read, "path string").select(file_name(F.col("path")).alias("source_file"))
    files = names.distinct().join(counted, "source_file", "left")  # a row per file on both sides
    files = files.withColumn("total_rows", F.coalesce("total_rows", F.lit(0)))
    return Ingested(trips, files, spark.createDataFrame(rejected, FILE_REPORT))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)

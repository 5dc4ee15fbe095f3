"""Intermediate tables in the shared folder that the session names for checkpoints."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for an unset local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="meterline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: cuts the lineage and keeps column pruning for later passes.

    Used where several passes follow an expensive shuffle. The files live in the shared
    folder, so a lost executor costs a re-read and not a re-computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are written.

    It does so when the driver collects its garbage, which a quiet driver seldom does.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()

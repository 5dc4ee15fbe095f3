"""Session builder for tests and the benchmark; a cluster job brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Bytes of one generated method beyond which the JVM leaves it uncompiled, so that it runs many times slower.
METHOD_LIMIT = 8000
_METHOD_LIMIT_KEY = "spark.sql.codegen.hugeMethodLimit"


def tune(spark: SparkSession) -> None:
    """Let wide projections of a session fall back to small methods, which the JVM does compile.

    Spark's own limit is 65,535 bytes. A session with a lower limit keeps it.
    """
    if int(spark.conf.get(_METHOD_LIMIT_KEY, "65535")) > METHOD_LIMIT:
        spark.conf.set(_METHOD_LIMIT_KEY, str(METHOD_LIMIT))


def local_session(cpus: int | str = 8, app: str = "meterline", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # small local files: one split per row group, so that all cores read
        .config("spark.sql.files.openCostInBytes", "512k")
        .config(_METHOD_LIMIT_KEY, str(METHOD_LIMIT))
        .config("spark.driver.memory", os.environ.get("METERLINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

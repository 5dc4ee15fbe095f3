"""Tables of the Spark catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline import schemas

WRITE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    df = spark.table(name)
    return df if limit is None else df.limit(limit)


def write_table(
    df: DataFrame,
    name: str,
    if_exists: str = "append",
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write a parquet table; ``if_exists`` is fail, replace or append."""
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(WRITE_MODES)}")
    writer = df.write.format("parquet").mode(WRITE_MODES[if_exists])
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def run_sql(spark: SparkSession, text: str, params: dict | None = None, **tables) -> DataFrame:
    """A parameterised read query: ``:name`` markers are bound, never pasted into the text."""
    return spark.sql(text, args=params or {}, **tables)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


TABLE_INFO = schemas.struct(
    ("position", schemas.INT),
    ("column_name", schemas.STRING),
    ("data_type", schemas.STRING),
    ("nullable", schemas.BOOL),
)


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a table in order; no rows when the table does not exist."""
    rows = []
    if table_exists(spark, name):
        rows = [
            (i, c.name, c.dataType, c.nullable)
            for i, c in enumerate(spark.catalog.listColumns(name))
        ]
    return spark.createDataFrame(rows, TABLE_INFO)

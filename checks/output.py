"""Output conventions shared by the queries: rounded doubles, dates and times as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def plain(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles and print timestamps and dates, so that engines print the same values."""

    def value(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(col, digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(f.name)
        return col.alias(f.name)

    return df.select(*[value(f) for f in df.schema.fields])


def sql_round(*columns: str, digits: int = DIGITS, alias: bool = True) -> str:
    """``round(c, 6) AS c`` for plain column names or ``expr AS name`` entries."""
    out = []
    for column in columns:
        expr, _, name = column.rpartition(" AS ")
        expr, name = (expr, name) if expr else (column, column)
        out.append(f"round({expr}, {digits}) + 0.0 AS {name}")
    return ", ".join(out)


def sql_time(*columns: str) -> str:
    out = []
    for column in columns:
        expr, _, name = column.rpartition(" AS ")
        expr, name = (expr, name) if expr else (column, column)
        out.append(f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}")
    return ", ".join(out)


def sql_half_up(expr: str, digits: int) -> str:
    scale = float(10**digits)
    return f"floor(({expr}) * {scale} + 0.5) / {scale}"

"""Column helpers shared by the operators. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name for use in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def number_literal(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{float(value)!r}' AS DOUBLE)"


def rows_from(row: DataFrame, entries: Sequence[dict[str, str]]) -> DataFrame:
    """Turn a one-row table into several rows; an entry maps output names to SQL text.

    Wide profiles have hundreds of output cells, and one parsed text is far quicker to build
    than as many Column objects.
    """
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {text}" for name, text in entry.items()) + ")"
        for entry in entries
    ]
    return row.select(F.expr(f"inline(array({', '.join(structs)}))"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column, so that only null means missing."""
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clip(col: Column, low: float | None, high: float | None) -> Column:
    """Limit to [low, high]; null stays null (least and greatest alone would skip it)."""
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(col.isNotNull(), out)


def cut_code(col: Column, edges: Sequence[float]) -> Column:
    """Zero-based index of the bin (edge_i, edge_i+1]; null outside all bins."""
    code = F.when(col <= F.lit(float(edges[0])), F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        code = code.when(col <= F.lit(float(edge)), F.lit(i))
    return code


def cut(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edge_i, edge_i+1]; null outside all bins."""
    label = F.when(col <= F.lit(float(edges[0])), F.lit(None).cast("string"))
    for edge, name in zip(edges[1:], labels, strict=True):
        label = label.when(col <= F.lit(float(edge)), F.lit(name))
    return label


def half_up(col: Column, digits: int) -> Column:
    """Round by floor(x * 10^n + 0.5) / 10^n, the same arithmetic in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(col * scale + F.lit(0.5)).cast("double") / scale


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, microseconds kept, independent of the session zone."""
    return (end - start).cast(T.DayTimeIntervalType(3, 3)).cast("decimal(20,6)").cast("double")


def md5_key(columns: Sequence[str | Column], seed: int) -> Column:
    """Hex digest of the key columns and a seed: a stable pseudo-random order."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("-", *texts, F.lit(str(seed))))


def md5_bucket(columns: Sequence[str | Column], seed: int, buckets: int = 1000) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the key digest."""
    head = F.conv(F.substring(md5_key(columns, seed), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(buckets)

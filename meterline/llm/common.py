"""Shared helpers: tables by name, Arrow batches in tasks, salted lookups, staging."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from meterline.sources.staging import stage

#: Into how many parts the rows of one key are dealt before a lookup by that key.
SALTS = 16

#: Bits that announce keys, in rows of 32768; 4 MB are broadcast, whatever the table.
MARKS = 1 << 25
_ROW = 1 << 15

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list | pa.Array] | None], schema: str
) -> DataFrame:
    """``fn`` turns an Arrow batch into columns of ``schema``; no state between batches.

    Nulls stay nulls and 64-bit ids stay integers, which pandas would turn into floats.
    """
    kind = StructType.fromDDL(schema)
    return map_partitions(df, _Each(fn, kind), kind)


def map_partitions(df: DataFrame, fn: Callable, kind: StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; then the path does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return df.mapInArrow(fn, kind)


class _Each:
    def __init__(self, fn, kind: StructType):
        self.fn, self.kind = fn, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.kind)
        for batch in batches:
            if batch.num_rows and (out := self.fn(batch)) is not None:
                yield as_batch(out, schema)


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns[field.name]
        if not isinstance(values, pa.Array):
            values = pa.array(values, field.type)
        elif values.type != field.type:
            values = values.cast(field.type)
        arrays.append(values)
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's texts as bytes, null as empty."""
    return [b"" if v is None else v for v in batch.column(name).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's texts, null as empty; broken UTF-8 becomes U+FFFD."""
    return [v.decode("utf-8", "replace") for v in utf8(batch, name)]


def filter_batches(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` for which ``keep`` says so of each batch; columns may have any names."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return map_partitions(plain, _Filter(keep, df.columns), plain.schema).toDF(*df.columns)


class _Filter:
    def __init__(self, keep, names: list[str]):
        self.keep, self.names = keep, names

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = self.keep(batch.rename_columns(self.names))
                yield batch.filter(pa.array(kept, pa.bool_()))


def quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in names]


def settle(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back, after which the shuffles behind it may go.

    Spark drops the shuffle files of a finished step when the driver collects its garbage, which a
    quiet driver seldom does; an operator of many steps would hold them all on the executors' disks.
    """
    out = stage(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def salt_of(col: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(salts)).cast("int")


def marks(keys: DataFrame, key: str = "doc") -> DataFrame:
    """(row, bits): the bitmap of the documents (or nodes) in ``keys``."""
    at = F.pmod(key, F.lit(MARKS))
    return (
        keys.select(F.floor(at / _ROW).cast("int").alias("row"), (at % _ROW).alias("bit"))
        .groupBy("row")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def with_mark(docs: DataFrame, bitmap: DataFrame, key: str = "_doc") -> DataFrame:
    """Adds ``_marked``: false only for rows whose ``key`` is not in the bitmap."""
    at = F.pmod(key, F.lit(MARKS))
    spot = docs.withColumns({"_row": F.floor(at / _ROW).cast("int"), "_bit": (at % _ROW).cast("int")})
    # MARKS bits in all: 1024 rows of 4 KB at most
    named = F.broadcast(bitmap.select(F.col("row").alias("_row"), F.col("bits").alias("_bits")))
    byte = F.conv(F.hex(F.expr("substring(_bits, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    marked = F.coalesce(F.expr("_b & shiftleft(1, _bit % 8)") != 0, F.lit(False))
    return (
        spot.join(named, "_row", "left")
        .withColumn("_b", byte)
        .withColumn("_marked", marked)
        .drop("_row", "_bit", "_bits", "_b")
    )

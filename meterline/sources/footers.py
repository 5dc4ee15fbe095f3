"""Footers of many parquet files, read in tasks.

A path is a row of a small table, dealt to as many tasks as there are cores to use, so the number of jobs
doesn't follow the number of files. What a task cannot open, because the store is one that only
Spark reads or because the file is missing or broken, is left to Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files of a task, and probes by Spark's reader that wait for each other's jobs at most.
FILES_A_TASK, PROBES = 8, 8

FOOTERS = "path string, layout string, row_count long, reason string"


@dataclass(frozen=True)
class Probe:
    """A readable file's schema, or why it is not readable."""

    path: str
    schema: T.StructType | None
    reason: str | None = None


def _read_footers():
    def layout_of(path: str) -> tuple[str, int]:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        if "://" in path or path.startswith("file:"):
            system, name = fs.FileSystem.from_uri(path)
        else:
            system, name = fs.LocalFileSystem(), path
        info = system.get_file_info(name)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        names = [name]
        if info.type == fs.FileType.Directory:  # part files, without markers and hidden files
            found = system.get_file_info(fs.FileSelector(name, recursive=True))
            names = sorted(
                f.path
                for f in found
                if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
            )
        layouts, rows = set(), 0
        for part in names:
            with system.open_input_file(part) as source:
                footer = pq.read_metadata(source)
            rows += footer.num_rows
            fields = [footer.schema.column(i) for i in range(footer.num_columns)]
            layouts.add(
                ";".join(f"{c.path}:{c.physical_type}:{c.logical_type}:{c.max_definition_level}" for c in fields)
            )
        if len(layouts) != 1:
            raise ValueError("part files differ")
        return layouts.pop(), rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    rows.append((path, *layout_of(path), None))
                except Exception as error:  # Spark's reader says what it is
                    rows.append((path, None, None, type(error).__name__))
            if rows:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["path", "layout", "row_count", "reason"])

    return task


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, layout, row_count, reason): one row per path; ``reason`` where a task could not read it."""
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = max(1, -(-len(paths) // FILES_A_TASK))
    return rows.repartition(tasks, "path").mapInArrow(_read_footers(), FOOTERS)


def _by_spark(spark: SparkSession, path: str) -> Probe:
    try:
        return Probe(path, spark.read.parquet(path).schema)
    except (PySparkException, Py4JJavaError) as error:  # a broken footer is the latter
        return Probe(path, None, type(error).__name__)


def probe(spark: SparkSession, paths: Sequence[str]) -> list[Probe]:
    """Schema or reason of every path, in the given order; repeated paths are probed once.

    Files of one layout have one schema, which Spark reads from one of them.
    """
    paths = list(dict.fromkeys(paths))
    if not paths:
        return []
    found = {r["path"]: r["layout"] for r in footers(spark, paths).collect()}  # a row per path
    first: dict[str, str] = {}
    for path in paths:
        if (layout := found.get(path)) is not None:
            first.setdefault(layout, path)
    asked = list(first.values()) + [p for p in paths if found.get(p) is None]
    with ThreadPoolExecutor(PROBES) as pool:
        read = {p.path: p for p in pool.map(lambda path: _by_spark(spark, path), asked)}
    out = []
    for path in paths:
        own = read.get(path) or read[first[found[path]]]
        out.append(Probe(path, own.schema, own.reason))
    return out


def file_name(path: Column) -> Column:
    """Name of the parquet file, or of the folder of part files, in a path."""
    return F.regexp_extract(path, r"([^/]+\.parquet)(/[^/]+)?$", 1)

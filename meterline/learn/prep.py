"""From feature tables to training tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from meterline import schemas
from meterline.functions.columns import md5_bucket, quoted
from meterline.operators.quantiles import quantiles

# Columns that would give the target away, and shares of the split.
LEAKING = (
    "trip_id",
    "created_at",
    "fare_amount",
    "total_amount",
    "tip_amount",
    "tolls_amount",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
)
IDS = ("trip_id", "created_at")
TEST_SHARE, VALIDATION_SHARE = 0.2, 0.1
SEED = 42


def select_numeric(df: DataFrame, target: str, features: Sequence[str] | None = None) -> list[str]:
    """Feature columns: the numeric ones of those given, or of all but the target."""
    numeric = schemas.numeric_columns(df, (target,))
    return [c for c in features if c in numeric] if features is not None else numeric


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of the training rows, to be applied to every split."""
    return {c: q[0] for c, q in quantiles(train, columns, (0.5,)).items() if q[0] is not None}


def incomplete(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have nulls; the others need no median."""
    row = df.agg(*[F.expr(f"count_if({quoted(c)} IS NULL) AS z{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"z{i}"]]


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    return df.withColumns(filled) if filled else df


def assign_split(
    df: DataFrame,
    key: Sequence[str],
    seed: int = SEED,
    test: float = TEST_SHARE,
    validation: float = VALIDATION_SHARE,
) -> DataFrame:
    """Add ``split``: train, val or test by a digest of the key, whatever the partitioning."""
    bucket = md5_bucket(key, seed)
    first, second = round(test * 1000), round((test + validation) * 1000)
    label = F.when(bucket < first, "test").when(bucket < second, "val").otherwise("train")
    return df.withColumn("split", label)


def regression_set(df: DataFrame, target: str = "fare_amount") -> DataFrame:
    """Trips with a positive fare and every feature known; leaking columns are gone."""
    features = [c for c in df.columns if c not in LEAKING and c != target]
    return df.filter(F.col(target) > 0).select(*features, target).dropna()


def tip_label(df: DataFrame) -> DataFrame:
    """``high_tip``: 1 above the median tip; leaking columns are gone."""
    median = quantiles(df, ["tip_amount"], (0.5,))["tip_amount"][0]
    # without a tip the comparison is false, not unknown
    high = F.coalesce(F.col("tip_amount") > F.lit(median), F.lit(False)).cast("int")
    features = [c for c in df.columns if c not in LEAKING]
    return df.withColumn("high_tip", high).select(*features, "high_tip").dropna()


def class_counts(df: DataFrame, label: str = "high_tip") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("row_count"))


def cluster_set(df: DataFrame) -> DataFrame:
    return df.select(*schemas.numeric_columns(df, IDS)).dropna()


def fit_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column scales by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scales = {}
    for i, c in enumerate(columns):
        mean, std = row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0
        # what is left of a constant after rounding is not a spread
        scales[c] = (mean, std if std > 1e-12 * max(1.0, abs(mean)) else 1.0)
    return scales


def standardise(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()}
    )


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


#: Rows of a cached batch. While a part is written or read, Spark's serializer keeps a hundred batches
#: alive, so batches of Spark's own 10,000 rows fill an executor's heap, whatever its memory for tables.
CACHED_ROWS = 500
#: Bytes of an Arrow batch of blocks, which a task and its worker hold several times over.
ARROW_BYTES = 2 << 20
_CACHED_KEY, _ARROW_KEY = "spark.sql.inMemoryColumnarStorage.batchSize", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is cached or sent to workers meanwhile goes in small batches; lower limits of the session stay."""
    own = spark._jsparkSession.sessionState().conf()
    found = {_CACHED_KEY: own.columnBatchSize(), _ARROW_KEY: own.arrowMaxBytesPerBatch()}
    wanted = {_CACHED_KEY: rows, _ARROW_KEY: ARROW_BYTES}
    lower = {k: v for k, v in wanted.items() if found[k] > v or found[k] <= 0}
    was = {k: spark.conf.get(k, None) for k in lower}
    for k, v in lower.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


@contextmanager
def held(df: DataFrame, cached_rows: int = CACHED_ROWS) -> Iterator[DataFrame]:
    """Hold a training table while it is fitted; it spills to disk and is released at the end."""
    with _small_batches(df.sparkSession, cached_rows):
        df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        try:
            yield df
        finally:
            df.unpersist()


#: Rows a core below which an uneven table is left as it is.
FEW_ROWS = 1000


def uneven(sizes: Sequence[int], cores: int) -> bool:
    """Whether the largest part keeps its task at work for twice as long as an even deal would."""
    return sum(sizes) >= FEW_ROWS * cores and max(sizes) * cores > 2 * sum(sizes)


@contextmanager
def dealt(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a training table in parts of similar size, so that every core takes part in a fit.

    A file of few row groups is read by as few tasks, however many cores there are; a fit passes over
    the rows hundreds of times, which is worth one shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    with held(df) as rows:
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        if not uneven(sizes, cores):
            yield rows
            return
        with held(rows.repartition(max(cores, len(sizes)))) as even:
            even.count()
            rows.unpersist()
            yield even

"""Table-to-table jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import schemas
from meterline.operators import clean, features, profile, trip, validate
from meterline.operators.sampling import sample_n
from meterline.sources.files import Ingested, ingest_many, write_json
from meterline.sources.raw import prepare_raw
from meterline.sources.staging import release_shuffles, stage
from meterline.sources.tables import write_table


def ingest_job(
    spark: SparkSession,
    paths: Sequence[str],
    target: str,
    if_exists: str = "append",
    path: str | None = None,
) -> Ingested:
    """Load monthly files into the raw table."""
    loaded = ingest_many(spark, paths)
    write_table(prepare_raw(loaded.trips), target, if_exists, path=path)
    return loaded


@dataclass(frozen=True)
class CleanReport:
    before: DataFrame
    after: DataFrame
    counters: DataFrame


def clean_job(
    spark: SparkSession,
    source: str,
    target: str,
    sample: int | None = None,
    sample_key: Sequence[str] = (),
    path: str | None = None,
) -> CleanReport:
    """Validate, clean, write the processed table and validate what was written."""
    raw = spark.table(source)
    if sample:
        raw = sample_n(raw, sample, list(sample_key) or raw.columns)
    before = validate.validate_all(raw)
    cleaned = clean.clean_all(raw)
    write_table(cleaned.trips, target, "replace", path=path)
    after = validate.validate_all(spark.table(target))
    return CleanReport(before, after, cleaned.counters)


def feature_job(
    spark: SparkSession,
    source: str,
    target: str,
    dictionary_path: str | None = None,
    sample: int | None = None,
    sample_key: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Derive the features of the processed table; returns the feature dictionary."""
    trips = spark.table(source)
    if sample:
        trips = sample_n(trips, sample, list(sample_key) or trips.columns)
    release_shuffles(spark)  # of the steps that made the source
    write_table(trip.all_features(trips, geospatial=False), target, "replace", path=path)
    written = spark.table(target)
    texts = schemas.string_columns(written)
    others = [c for c in written.columns if c not in texts]
    counts = stage(features.value_counts(written, texts), "values")  # serves both summaries
    unique = features.distinct_values(written, counts=counts)
    dictionary = features.feature_dictionary(
        written, unique=unique.unionByName(features.distinct_in_turns(written, others))
    )
    if dictionary_path:
        write_json(dictionary, dictionary_path)
        write_json(features.top_values(written, counts=counts), f"{dictionary_path}-top-values")
    return dictionary


def quality_job(
    spark: SparkSession,
    table: str,
    metrics_table: str,
    checked_at: dt.datetime,
    path: str | None = None,
) -> DataFrame:
    """Report on a table and append its quality metrics."""
    df = spark.table(table)
    metrics = profile.quality_metrics(df, table, F.lit(checked_at).cast("timestamp_ntz"))
    write_table(metrics, metrics_table, "append", path=path)
    return quality_report(df)


REPORT_COLUMNS = 5


def quality_report(df: DataFrame, with_validation: bool = True) -> DataFrame:
    """(section, name, value) rows: overview, nulls, outliers, failed checks, statistics, advice."""

    def rows(source: DataFrame, section: str, name, value) -> DataFrame:
        return source.select(
            F.lit(section).alias("section"), name.alias("name"), value.cast("string").alias("value")
        )

    number = F.format_string("%.2f", "value")
    stats = profile.summary_stats(df)
    nulls = profile.null_percent(df)
    outliers = profile.outlier_table(df)
    first = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint")]
    report = rows(stats.filter("column_name = '*'"), "overview", F.col("stat"), number)
    report = report.unionByName(
        rows(
            nulls.filter("null_count > 0"),
            "missing",
            F.col("column_name"),
            F.format_string("%d (%.2f%%)", "null_count", "null_percentage"),
        )
    )
    report = report.unionByName(
        rows(
            outliers.filter("outlier_count > 0"),
            "outliers",
            F.col("column_name"),
            F.format_string(
                "%d (%.2f%%) [%.2f, %.2f]",
                "outlier_count",
                "outlier_percentage",
                "lower_bound",
                "upper_bound",
            ),
        )
    )
    if with_validation:
        failed = validate.validate_all(df).filter(~F.col("passed"))
        report = report.unionByName(
            rows(failed, "failed check", F.col("metric_name"), F.col("message"))
        )
    report = report.unionByName(
        rows(
            stats.filter(F.col("column_name").isin(first[:REPORT_COLUMNS])),
            "statistics",
            F.concat_ws(" ", "column_name", "stat"),
            number,
        )
    )
    null_total = nulls.agg(F.sum("null_count").alias("n")).filter("n > 0")
    outlier_total = outliers.agg(F.sum("outlier_count").alias("n")).filter("n > 0")
    return report.unionByName(
        rows(
            null_total,
            "recommendation",
            F.lit("Missing Values"),
            F.format_string("%d null values: consider imputation or removal", "n"),
        )
    ).unionByName(
        rows(
            outlier_total,
            "recommendation",
            F.lit("Outliers"),
            F.format_string("%d outliers in numeric columns: review and cap if necessary", "n"),
        )
    )


def markdown(report: DataFrame, title: str) -> str:
    """The report rows as text; a report has a few rows per table column."""
    lines, section = [f"# {title}"], None
    for r in report.collect():
        if r["section"] != section:
            section = r["section"]
            lines += ["", f"## {section.capitalize()}", "", "| Name | Value |", "|---|---|"]
        lines.append(f"| {r['name']} | {r['value'] if r['value'] is not None else ''} |")
    return "\n".join(lines) + "\n"

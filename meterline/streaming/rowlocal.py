"""The row-local part of the batch flow; the same function serves a stream of raw trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meterline.operators.clean import derive_trip, drop_invalid, fix_types
from meterline.operators.trip import all_features
from meterline.sources.raw import prepare_raw


def trip_rows(df: DataFrame, keep: Sequence[str] = (), geospatial: bool = False) -> DataFrame:
    """Prepare, type, filter and enrich raw trips without looking at any other row."""
    trips = derive_trip(drop_invalid(fix_types(prepare_raw(df, keep=keep))))
    return all_features(trips, geospatial=geospatial)

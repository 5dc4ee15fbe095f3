"""The feature job counts distinct values of a few columns at a time and writes none but texts."""

import datetime as dt

import pytest

from meterline.operators import features, trip
from meterline.plans import jobs
from meterline.sources import staging

from conftest import rows


@pytest.fixture(scope="module")
def odd(spark):
    day = dt.date(2023, 1, 1)
    data = [
        (1, 0.0, "a", True, day, None),
        (1, -0.0, "a", None, day, None),
        (2, float("nan"), "", False, None, None),
        (None, None, None, True, day, None),
    ]
    return spark.createDataFrame(data, "i long, x double, t string, b boolean, d date, e int")


@pytest.mark.parametrize("most", [1, 4, 9])
def test_columns_in_turns_have_the_same_distinct_values(odd, most):
    want = rows(features.distinct_values(odd))
    assert rows(features.distinct_in_turns(odd, odd.columns, most)) == want and want
    assert rows(features.distinct_in_turns(odd, [], most)) == []


def test_a_dictionary_takes_known_distinct_values(odd):
    known = features.distinct_in_turns(odd, odd.columns)
    assert rows(features.feature_dictionary(odd, unique=known)) == rows(features.feature_dictionary(odd))


def test_the_job_holds_the_values_of_few_columns(spark, odd, tmp_path, monkeypatch):
    odd.write.mode("overwrite").saveAsTable("odd_source")
    monkeypatch.setattr(trip, "all_features", lambda trips, geospatial: trips)
    counted, staged, value_counts = [], [], features.value_counts

    def watched(df, columns=None):
        counted.append(list(df.columns if columns is None else columns))
        return value_counts(df, columns)

    monkeypatch.setattr(features, "value_counts", watched)
    for module in (features, jobs):
        monkeypatch.setattr(module, "stage", lambda df, name: staged.append(name) or staging.stage(df, name))
    monkeypatch.setattr(features, "COLUMNS_AT_ONCE", 2)
    monkeypatch.setattr(features.distinct_in_turns, "__defaults__", (2,))
    try:
        found = jobs.feature_job(
            spark, "odd_source", "odd_target", str(tmp_path / "dictionary"), path=str(tmp_path / "target")
        )
        assert rows(found) == rows(features.feature_dictionary(odd))
        top = rows(spark.read.json(str(tmp_path / "dictionary-top-values")), "column_name", "value", "n")
        assert top == [("t", "", 1), ("t", "a", 2)]
    finally:
        spark.sql("DROP TABLE IF EXISTS odd_source")
        spark.sql("DROP TABLE IF EXISTS odd_target")
    job = counted[: 1 + len(staged) - 1]
    assert job == [["t"], ["i", "x"], ["b", "d"], ["e"]] and staged == ["values", "unique", "unique", "unique"]

"""All queries by name, and the SQL of those that have one."""

from __future__ import annotations

import functools
import importlib

from meterline.session import tune

QUERIES: dict = {}
SQL: dict[str, str] = {}

SECTIONS = (
    "ingest",
    "cleaning",
    "quality",
    "features",
    "summaries",
    "evaluation",
    "learning",
    "tracking",
    "monitoring",
    "properties",
)


def _tuned(query):
    """The query on a session whose wide projections are compiled, whoever built the session."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        tune(spark)
        return query(spark, sf_dir)

    return run


for _name in SECTIONS:
    _section = importlib.import_module(f"checks.{_name}")
    for _key, (_query, _text) in _section.ENTRIES.items():
        if _key in QUERIES:
            raise ValueError(f"duplicate query {_key}")
        QUERIES[_key] = _tuned(_query)
        if _text is not None:
            SQL[_key] = _text

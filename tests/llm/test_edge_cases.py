"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables, odd columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import (
    decontaminate,
    language,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    quality,
    token_counts,
    toxicity,
)
from meterline.llm.queries import PIECES, WORD_BPE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PROSE = (
    "the river runs slowly past the old mill and children play on its banks in summer while "
    "their parents talk about work and rain"
)
ROWS = [
    (1, PROSE, "en", "a", 80),
    (1, PROSE, "en", "a", 80),
    (2, None, "en", "a", None),
    (3, "", None, "a", 0),
    (4, " \n\t ", "en", None, 4),
    (None, "an unnamed text of a few words", "en", "b", 30),
    (None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG)),
    (6, "ééé ß 日本 🙂 !!! \x1c x", "de", "b", 9),
    (7, "one", "en", "b", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = {"node": F.lit(1), "key": F.lit("k"), "row": F.lit(2), "item_id": F.lit(3), "n": F.lit(4)}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(odd | {"a.b": F.lit(5)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark, rows=((1, PROSE), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (7, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )


def model(docs):
    return language.fit(docs)


PER_ROW = {
    "quality": lambda s, d: quality.measure(d),
    "license": lambda s, d: license_scan.scan(d),
    "tokens": lambda s, d: token_counts.count_tokens(d, PIECES),
    "language": lambda s, d: language.identify(d, model(d)),
    "toxicity": lambda s, d: toxicity.score(d, labels(s)),
    "near": lambda s, d: near_dedup.classes(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(spark, docs, empty, name):
    got = [r["doc_id"] for r in PER_ROW[name](spark, docs).collect()]
    assert sorted(map(str, got)) == sorted(str(r[0]) for r in ROWS)
    assert PER_ROW[name](spark, empty).collect() == []


def test_packing_covers_every_row(spark, docs, empty):
    got = packing.pack(docs, WORD_BPE).collect()
    assert sum(r["start"] == 0 for r in got) == len(ROWS)
    assert all(r["length"] == len(r["ids"]) for r in got)
    assert packing.pack(empty, WORD_BPE).collect() == []


def test_decontamination(spark, docs, empty):
    found = decontaminate.find_items(spark, docs, items(spark)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 1), (1, 1)]
    kept = decontaminate.remove_contaminated(spark, docs, items(spark))
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    assert decontaminate.find_items(spark, docs, items(spark, [])).collect() == []
    assert decontaminate.remove_contaminated(spark, docs, items(spark, [])).count() == len(ROWS)
    assert decontaminate.find_items(spark, empty, items(spark)).collect() == []


def test_quality_keeps_columns(docs, empty):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.keep_good(empty).collect() == []


def test_near_keeps_one_of_equal_rows(docs, empty):
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(str((r["doc_id"], (r["text"] or "")[:5])) for r in kept.collect())
    want = sorted(str((r[0], (r[1] or "")[:5])) for r in ROWS[1:])
    assert got == want
    assert near_dedup.keep_one(empty).collect() == []


def test_lines_take_columns_of_any_name(spark):
    names = ["positions", "_row", "_b", "_left", "_doc", "_marked", "_p0", "_n", "_bit", "a.b", "node", "first"]
    rows = [(1, PROSE), (2, PROSE + "\none more line"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    out = line_dedup.drop_duplicate_lines(docs.withColumn("n_lines_dropped", F.lit(99)))
    assert out.columns == [*docs.columns, "n_lines_dropped"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[k]["n_lines_dropped"] for k in (1, 2, 3)] == [0, 1, 0] and got[2]["text"] == "one more line"
    assert all(r[c] == c for r in got.values() for c in names)


def test_lines_keep_columns(docs, empty):
    out = line_dedup.drop_duplicate_lines(docs)
    assert out.columns == [*docs.columns, "n_lines_dropped"]
    assert out.count() == len(ROWS)  # equal rows are one document and keep the same lines
    assert line_dedup.drop_duplicate_lines(empty).collect() == []


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, empty, tmp_path, k):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, str(tmp_path))
    if k < 4:
        assert out.dtypes == docs.select("doc_id", "text", "lang", "source", "n_chars").dtypes
    assert out.count() > 0
    assert stage(spark, empty, str(tmp_path)).collect() == []

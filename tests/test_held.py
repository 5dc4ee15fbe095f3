"""Training rows are cached and sent to workers in small batches."""

import numpy as np
import pyarrow as pa
import pytest

from meterline.learn import lloyd, net, prep

KEYS = (prep._CACHED_KEY, prep._ARROW_KEY)


def sizes_of_batches(rows):
    """Rows per cached batch."""
    plan = rows._jdf.queryExecution().withCachedData()
    buffers = plan.collectLeaves().head().cacheBuilder().cachedColumnBuffers()
    return [b.numRows() for b in buffers.collect()]


def test_held_rows_are_cached_in_small_batches(spark):
    before = [spark.conf.get(k) for k in KEYS]
    with prep.held(spark.range(5000).repartition(1)) as rows:
        assert rows.count() == 5000
        assert max(sizes_of_batches(rows)) <= prep.CACHED_ROWS
        # read back from disk, parts must not be gathered as bytes: those are large for the collector
        assert rows.storageLevel.deserialized and rows.storageLevel.useDisk
        assert int(spark.conf.get(KEYS[1]).rstrip("b")) <= prep.ARROW_BYTES
    assert [spark.conf.get(k) for k in KEYS] == before


def test_lower_limits_of_a_session_stay(spark):
    spark.conf.set(KEYS[0], "7")
    try:
        with pytest.raises(KeyError), prep.held(spark.range(20).repartition(1)) as rows:
            assert rows.count() == 20 and max(sizes_of_batches(rows)) <= 7
            raise KeyError
        assert spark.conf.get(KEYS[0]) == "7"
    finally:
        spark.conf.unset(KEYS[0])


def test_packed_rows_are_small_and_make_whole_blocks(spark):
    x = np.random.default_rng(3).normal(size=(9000, 40))
    df = spark.createDataFrame([(v.tolist(), float(i)) for i, v in enumerate(x)], "x array<double>, w double")
    ordered = df.coalesce(1)
    with prep.held(lloyd.packed(ordered), 1) as blocks:
        assert max(sizes_of_batches(blocks)) == 1
        found = blocks.select("x", "w", "left").collect()
        assert max(len(r["x"]) for r in found) <= lloyd.CHUNK * 40 * 8 < len(x) * 40 * 8
    whole = list(net._whole_blocks([pa.RecordBatch.from_pylist([r.asDict()]) for r in found]))
    assert len(whole) == 1 + sum(r["left"] == 0 for r in found[:-1])
    places = np.concatenate([w for _, w in whole]).astype(int)
    assert sorted(places) == list(range(9000))
    assert np.array_equal(np.concatenate([b for b, _ in whole]).reshape(-1, 40), x[places])
    assert [len(w) for _, w in whole] == [r["left"] + len(r["w"]) // 8 for r in starts(found)]


def starts(found):
    """The first row of each block."""
    return [r for i, r in enumerate(found) if not i or not found[i - 1]["left"]]

"""Hard negatives against all pairs; whitening against a dense eigen decomposition."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = ("id", "x", "vec", "bad", "means", "devs", "anchor", "slot", "score", "at", "value", "a.b")


def plain_negatives(rows, low=50, high=95):
    """Of (id, vector, label) rows: what the operator must return, by all pairs in whole numbers."""
    ready = []
    for i, vec, label in rows:
        if i is None or vec is None or label is None:
            continue
        if any(c is None or not math.isfinite(c) for c in vec):
            continue
        ready.append((i, [math.floor(Fraction(np.float32(c).item()) * 256) for c in vec], label))
    out = []
    for i, x, label in ready:
        if i % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(x, y, strict=False)), j, other == label)
            for j, y, other in ready
            if j != i
        ]
        positives = sorted((s, j) for s, j, alike in scored if alike)[:5]
        for s, j in positives:
            fit = sorted(
                (t, k)
                for t, k, alike in scored
                if not alike and low * -s <= 100 * -t <= high * -s
            )[:3]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(df):
    found = hard_negatives.mine(df, F.col("label"), F.col("id") % 50 == 0)
    return sorted(tuple(r) for r in found.drop("positive_rank").collect())


def vectors(seed, n=400, width=24, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    picked = rng.integers(0, labels, n)
    x = centres[picked] * 0.5 + rng.normal(size=(n, width)) * spread
    return [(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, picked, strict=True))]


def test_negatives_equal_all_pairs(spark):
    rows = vectors(1) + vectors(2, n=60)[:60]  # ids stand twice
    rows += [(500, rows[0][1], 1), (550, rows[0][1], 2), (600, [0.0] * 24, 1)]  # ties, no direction
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain_negatives(rows)
    assert want and mined(df) == want


def test_negatives_in_groups_and_blocks(spark, monkeypatch):
    rows = vectors(3, n=300)
    monkeypatch.setattr(hard_negatives, "GROUP_VALUES", 64)  # two anchors a group
    monkeypatch.setattr(hard_negatives, "BLOCK_PAIRS", 16)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df) == plain_negatives(rows)


def test_negatives_of_odd_rows(spark):
    rows = vectors(4, n=120)
    rows += [
        (650, None, 1),
        (700, [None, 1.0], 1),
        (750, [float("nan")], 1),
        (751, [float("inf"), 1.0], 1),
        (None, [1.0] * 24, 1),
        (800, [1.0] * 24, None),
        (850, [], 1),
        (900, [0.5, 0.25], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ODD})
    assert mined(df) == plain_negatives(rows)
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id = 3")) == []


def test_negatives_of_huge_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i * 10, [float(v) for v in rng.normal(size=4) * 4e6], i % 3) for i in range(40)]
    rows = [(i, [float(np.float32(v)) for v in x], c) for i, x, c in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain_negatives(rows)


def test_bounds_close_only_pairs_outside(spark):
    rng = np.random.default_rng(6)
    layout = hard_negatives.Layout(64, "<i2")

    def block(n, rough):
        x = np.floor(np.cumsum(rng.normal(size=(n, 64)), axis=1) * 20 + rng.normal(size=(n, 64)) * rough)
        means, devs = hard_negatives.summaries(x)
        packed = [[r.tobytes() for r in m] for m in (x.astype("<i2"), means.astype("<f4"), devs.astype("<f4"))]
        return hard_negatives.block_of(range(n), [0] * n, *packed, layout)

    rows, anchors = block(300, 5), block(20, 5)
    scores = rows.vecs @ anchors.vecs.T
    low, high = np.quantile(scores, 0.9, axis=0), np.quantile(scores, 0.97, axis=0)
    alive = hard_negatives.open_pairs(rows, anchors, np.ones(scores.shape, bool), low, high)
    inside = (scores >= low) & (scores <= high)
    assert not (inside & ~alive).any()
    assert alive.mean() < 0.4  # on smooth vectors most pairs never reach exact scoring


def dense(rows):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r] for r in rows], float)
    centred = x - x.mean(0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return x.astype(int), centred, values[::-1], turn[:, ::-1]


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    rows = (rng.normal(size=(700, 48)) * np.linspace(1.5, 0.4, 48)) @ basis.T
    rows = rows.astype(np.float32).astype(float)
    df = spark.createDataFrame(
        [(i, [float(c) for c in r], 0) for i, r in enumerate(rows)], SCHEMA
    ).repartition(4)
    got = {(r.vec_id, r.component): r for r in whitening.whitened_table(df).collect()}
    x, centred, values, turn = dense(rows)
    assert len(got) == 700 * 8
    for k in range(8):
        want = centred @ turn[:, k] / math.sqrt(values[k])
        have = np.array([got[i, k + 1].whitened for i in range(700)])
        assert np.abs(have * np.sign(have @ want) - want).max() < 1e-9
        assert got[0, k + 1].explained == pytest.approx(values[k] / values.sum(), rel=1e-10)
    sums = x.sum(0)
    for i in (0, 13, 699):
        assert int(got[i, 1].deviation) == sum((700 * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))
    assert got[0, 1].n == 700 and got[0, 1].identity_error < 1e-10


def test_whitening_of_odd_tables(spark):
    rows = [
        (1, [0.5, 0.25, 1.0], 0),
        (1, [0.5, 0.25, 1.0], 0),
        (None, [0.1, -3.0, 2.0], None),
        (2, None, 0),
        (3, [None, 1.0, 1.0], 0),
        (4, [float("nan"), 1.0, 1.0], 0),
        (5, [float("-inf"), 1.0, 1.0], 0),
        (6, [2.0], 0),  # counts as 2, 0, 0
        (7, [], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ODD})
    got = whitening.whitened_table(df).collect()
    kept = [[0.5, 0.25, 1.0]] * 2 + [[np.float32(0.1), -3.0, 2.0], [2.0, 0, 0], [0, 0, 0]]
    _, _, values, _ = dense(np.array(kept, float))
    assert {r.n for r in got} == {5} and len(got) == 5 * 3
    assert {round(r.explained, 9) for r in got} == {round(v, 9) for v in values / values.sum()}
    assert sorted({r.vec_id for r in got}, key=str) == [1, 6, 7, None]
    assert whitening.whitened_table(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.5], 0) for i in range(4)], SCHEMA)
    assert whitening.whitened_table(same).count() == 0  # no variance, no component
    flat = spark.createDataFrame([(i, [float(i), 0.5], 0) for i in range(4)], SCHEMA)
    assert {r.component for r in whitening.whitened_table(flat).collect()} == {1}


def test_deviations_are_exact_beyond_64_bits():
    centre = whitening._Centred(10**9, (100_000 * 10**9, 5))
    batch = pa.record_batch({"x": pa.array([[10**13, -7], [100_000, 0]], pa.list_(pa.int64()))})
    scaled = centre.scaled(batch)
    want = [(10**9 * (10**13 - 100_000)) ** 2 + (7 * 10**9 + 5) ** 2, 25]
    assert centre.deviations(scaled) == want
    near = whitening._Centred(3, (1, 1))
    scaled = near.scaled(pa.record_batch({"x": pa.array([[2**50, -(2**50)]], pa.list_(pa.int64()))}))
    assert near.deviations(scaled) == [(3 * 2**50 - 1) ** 2 + (3 * 2**50 + 1) ** 2]

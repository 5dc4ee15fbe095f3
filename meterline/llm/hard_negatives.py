"""Hard negatives by segment summaries.

Vectors are whole numbers. Every row's vector is cut into segments, at several lengths, and the mean and the
deviation (root of the sum of squares about the mean) of each segment are stored beside it. For two vectors
the products of means, times the segment length, plus or minus the products of deviations bound the
inner product from both sides. Bounds of long segments come first; only pairs that they leave open are
refined with shorter ones, and only pairs that all levels leave open are scored exactly.

Anchors are a stated set of rows. They go to the tasks in groups of a bounded size, and each group takes
two passes over the stored rows, which never move: the first keeps the best rows of the same label, the second
the best rows of another label within the band that a positive's score opens. A task keeps the first
few per anchor (per anchor and positive), so what is shuffled is tasks x anchors x few, and a hot label
costs a task no more than its share of rows.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part;
a shorter vector counts its missing components as 0; a repeated row counts for itself, and rows of one id
are never each other's positives; equal scores go to the smaller id; an empty table, or one without
anchors, gives no rows; scores are exact at any size, and those beyond 64 bits are reported as the
nearest 64-bit number; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DecimalType, IntegerType, LongType, StructType

from meterline.llm.common import as_batch, map_batches, map_partitions
from meterline.sources.staging import scratch_path, stage

#: Segment lengths, longest first. Vectors are padded with zeros to a multiple of the longest.
LENGTHS = (16, 4, 2)
#: Numbers of anchor vectors sent to the tasks at once (8 MB), and pairs of a block of one task.
GROUP_VALUES, BLOCK_PAIRS = 2**20, 2**21
#: Share of open pairs below which pairs are scored one by one instead of as a block.
SPARSE = 0.02
#: Means and deviations are stored in single precision; this share of the norms covers it.
MARGIN = 4e-6

POSITIVES, NEGATIVES = 5, 3


@dataclass(frozen=True)
class Layout:
    """Padded width, and the type in which whole components are stored."""

    width: int
    kind: str


def store(
    rows: DataFrame,
    label: Column,
    vector: str = "embedding",
    id_column: str = "vec_id",
    scale: int = 256,
) -> tuple[DataFrame, Layout]:
    """(id, label, vec, means, devs) of the rows that take part, written once."""
    vec = F.col(vector)
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    part = rows.select(
        F.col(id_column).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(vec, lambda c: c.cast("double")).alias("vec"),
        F.coalesce(bad, F.lit(True)).alias("bad"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND NOT bad")
    width, most = part.agg(
        F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", F.abs)))
    ).first()
    longest = LENGTHS[0]
    width = max(-(-(width or 1) // longest), 1) * longest
    most = (most or 0.0) * scale + 1
    layout = Layout(width, "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8")
    schema = "id long, label long, vec binary, means binary, devs binary"
    return stage(map_batches(part, _Summarise(layout, scale), schema), "segments"), layout


class _Summarise:
    def __init__(self, layout: Layout, scale: int):
        self.layout, self.scale = layout, scale

    def __call__(self, batch: pa.RecordBatch) -> dict:
        column = batch.column("vec")
        lengths = np.diff(column.offsets.to_numpy())
        x = np.zeros((len(lengths), self.layout.width))
        x[np.arange(self.layout.width) < lengths[:, None]] = column.flatten().to_numpy()
        with np.errstate(over="ignore"):
            scaled = np.floor(x * self.scale)
        # beyond 2**53 a component is a whole number already, but its product may overflow
        x = np.clip(scaled, -np.finfo(float).max, np.finfo(float).max)
        means, devs = summaries(x)
        return {
            "id": batch.column("id"),
            "label": batch.column("label"),
            "vec": [r.tobytes() for r in x.astype(self.layout.kind)],
            "means": [r.tobytes() for r in means.astype("<f4")],
            "devs": [r.tobytes() for r in devs.astype("<f4")],
        }


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, side by side."""
    means, devs = [], []
    with np.errstate(over="ignore", invalid="ignore"):
        for length in LENGTHS:
            parts = x.reshape(len(x), -1, length)
            mean = parts.mean(axis=2)
            means.append(mean)
            devs.append(np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2)))
        return np.concatenate(means, axis=1), np.concatenate(devs, axis=1)


@dataclass
class Block:
    """Rows as matrices: whole components, summaries of all levels, norms."""

    ids: np.ndarray
    labels: np.ndarray
    vecs: np.ndarray
    means: np.ndarray
    devs: np.ndarray
    norms: np.ndarray

    def take(self, at) -> Block:
        return Block(*(getattr(self, n)[at] for n in self.__dataclass_fields__))

    def __len__(self) -> int:
        return len(self.ids)


def _matrix(values: list[bytes], kind: str, columns: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(-1, columns).astype(np.float64)


def block_of(ids, labels, vecs, means, devs, layout: Layout) -> Block:
    segments = sum(layout.width // length for length in LENGTHS)
    x = _matrix(vecs, layout.kind, layout.width)
    with np.errstate(over="ignore"):
        norms = np.sqrt((x * x).sum(axis=1))
    return Block(
        np.asarray(ids, np.int64),
        np.asarray(labels, np.int64),
        x,
        _matrix(means, "<f4", segments),
        _matrix(devs, "<f4", segments),
        norms,
    )


def open_pairs(rows: Block, anchors: Block, alive: np.ndarray, low, high) -> np.ndarray:
    """Pairs whose score may lie in [low, high] of their anchor, after all levels.

    ``alive`` marks the pairs to look at. Each level works on the rows and anchors that still have one.
    """
    at = 0
    for length in LENGTHS:
        segments = rows.vecs.shape[1] // length
        level = slice(at, at + segments)
        at += segments
        r, a = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(r):
            break
        with np.errstate(over="ignore", invalid="ignore"):
            middle = length * (rows.means[r, level] @ anchors.means[a, level].T)
            reach = rows.devs[r, level] @ anchors.devs[a, level].T
            reach += MARGIN * np.outer(rows.norms[r], anchors.norms[a]) + MARGIN
            # a bound that overflowed is no number, and closes nothing
            closed = (middle + reach < low[a]) | (middle - reach > high[a])
        alive[np.ix_(r, a)] &= ~closed
    return alive


def exact_scores(rows: Block, anchors: Block, alive: np.ndarray):
    """(row, anchor, score) of the pairs marked: exact integers."""
    most = np.abs(rows.vecs).max(initial=0) * np.abs(anchors.vecs).max(initial=0)
    if not most * rows.vecs.shape[1] < 2.0**53:  # sums of whole numbers are exact below that
        r, a = np.nonzero(alive)
        wide = [[int(v) for v in row] for row in rows.vecs], [
            [int(v) for v in row] for row in anchors.vecs
        ]
        scores = [
            sum(x * y for x, y in zip(wide[0][i], wide[1][j], strict=True))
            for i, j in zip(r, a, strict=True)
        ]
        return r, a, np.array(scores, dtype=object)
    used_r, used_a = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    inner = alive[np.ix_(used_r, used_a)]
    r, a = np.nonzero(inner)
    if len(r) < SPARSE * inner.size:
        r, a = used_r[r], used_a[a]
        scores = np.einsum("ij,ij->i", rows.vecs[r], anchors.vecs[a])
        return r, a, scores.astype(np.int64)
    dense = rows.vecs[used_r] @ anchors.vecs[used_a].T
    return used_r[r], used_a[a], dense[r, a].astype(np.int64)


class Best:
    """The first ``few`` (score falling, id rising) of every key, with the score to beat."""

    def __init__(self, keys: int, few: int):
        self.few = few
        self.key, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.floor = np.full(keys, -np.inf)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        key, ids = np.concatenate([self.key, key]), np.concatenate([self.id, ids])
        score = np.concatenate([self.score, score])
        if score.dtype == object:
            order = np.array(sorted(range(len(key)), key=lambda i: (key[i], -score[i], ids[i])))
        else:
            order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        kept = rank < self.few
        self.key, self.score, self.id = key[kept], score[kept], ids[kept]
        full = rank == self.few - 1
        # a float may lie above a score of more than 53 bits
        self.floor[key[full]] = np.nextafter(score[full].astype(np.float64), -np.inf)


def found_kind(key: str) -> StructType:
    return (
        StructType().add(key, IntegerType()).add("score", DecimalType(38, 0)).add("id", LongType())
    )


class _Pass:
    """One pass of a task over its rows against a group of anchors."""

    kind: StructType

    def __init__(self, layout: Layout, anchors):
        self.layout, self.anchors = layout, anchors

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.begin()
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(i).to_pylist() for i in range(5)]
                self.meet(block_of(*columns, self.layout))
        for out in self.results():
            yield as_batch(out, to_arrow_schema(self.kind))


class _Positives(_Pass):
    """The best rows of an anchor's label in this task."""

    kind = found_kind("anchor")

    def begin(self) -> None:
        self.group: Block = self.anchors.value
        self.best = Best(len(self.group), POSITIVES)

    def meet(self, rows: Block) -> None:
        for label in np.unique(rows.labels):
            at = np.flatnonzero(self.group.labels == label)
            if not len(at):
                continue
            anchors, same = self.group.take(at), rows.take(rows.labels == label)
            step = max(1, BLOCK_PAIRS // len(at))
            for start in range(0, len(same), step):
                block = same.take(slice(start, start + step))
                alive = block.ids[:, None] != anchors.ids[None, :]
                low, high = self.best.floor[at], np.full(len(at), np.inf)
                r, a, scores = exact_scores(
                    block, anchors, open_pairs(block, anchors, alive, low, high)
                )
                good = scores >= low[a]
                self.best.add(at[a[good]], scores[good], block.ids[r[good]])

    def results(self):
        best = self.best
        yield {"anchor": best.key, "score": _decimals(best.score), "id": best.id}


class _Negatives(_Pass):
    """The best rows of other labels in this task, for every positive of an anchor.

    ``anchors`` holds the group and, per slot (an anchor's positive): anchor, lowest and highest score.
    """

    kind = found_kind("slot")

    def begin(self) -> None:
        self.group, self.owner, self.lowest, self.highest = self.anchors.value
        self.best = Best(len(self.owner), NEGATIVES)
        exact = self.highest.dtype != object
        self.low = self.lowest.astype(np.float64) - (0 if exact else np.abs(self.lowest) * 1e-9)
        self.high = self.highest.astype(np.float64) + (0 if exact else np.abs(self.highest) * 1e-9)
        # slots by anchor: owners come in order, and -1 stands for none
        self.slots = np.full((len(self.group), POSITIVES), -1)
        first = np.searchsorted(self.owner, self.owner)
        self.slots[self.owner, np.arange(len(self.owner)) - first] = np.arange(len(self.owner))

    def meet(self, rows: Block) -> None:
        anchors = self.group
        step = max(1, BLOCK_PAIRS // max(len(anchors), 1))
        for start in range(0, len(rows), step):
            block = rows.take(slice(start, start + step))
            low, high = np.full(len(anchors), np.inf), np.full(len(anchors), -np.inf)
            np.minimum.at(low, self.owner, np.maximum(self.low, self.best.floor).astype(float))
            np.maximum.at(high, self.owner, self.high.astype(float))
            alive = (block.labels[:, None] != anchors.labels[None, :]) & (low <= high)[None, :]
            r, a, scores = exact_scores(
                block, anchors, open_pairs(block, anchors, alive, low, high)
            )
            for slot_of in self.slots.T:  # the i-th positive of every anchor that has one
                slot = slot_of[a]
                good = slot >= 0
                good[good] &= (
                    (scores[good] >= self.lowest[slot[good]])
                    & (scores[good] <= self.highest[slot[good]])
                    & (scores[good] >= self.best.floor[slot[good]])
                )
                self.best.add(slot[good], scores[good], block.ids[r[good]])

    def results(self):
        best = self.best
        yield {"slot": best.key, "score": _decimals(best.score), "id": best.id}


def _decimals(scores: np.ndarray) -> pa.Array:
    top = 10**38 - 1
    return pa.array([Decimal(max(-top, min(top, int(s)))) for s in scores], pa.decimal128(38, 0))


def first_of(found: DataFrame, key: str, few: int) -> DataFrame:
    """The first ``few`` of every key over all tasks, with ``rank`` from 1."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= few)


def groups_of(anchors: DataFrame, layout: Layout) -> Iterator[Block]:
    """Anchors in blocks of a bounded size, read partition by partition."""
    most, held = max(1, GROUP_VALUES // layout.width), []
    for row in anchors.toLocalIterator():
        held.append(tuple(row))
        if len(held) == most:
            yield block_of(*zip(*held, strict=True), layout)
            held = []
    if held:
        yield block_of(*zip(*held, strict=True), layout)


def mine(
    rows: DataFrame,
    label: Column,
    is_anchor: Column,
    low: int = 50,
    high: int = 95,
    vector: str = "embedding",
    id_column: str = "vec_id",
) -> DataFrame:
    """Hard negatives of every anchor and each of its first ``POSITIVES`` positives.

    A negative has another label and ``low`` to ``high`` per cent of the positive's score. ``is_anchor`` is a
    condition on the column ``id``. Columns: anchor_id, positive_id, positive_rank, rank, negative_id,
    positive_score, negative_score.
    """
    spark = rows.sparkSession
    table, layout = store(rows, label, vector, id_column)
    anchors = stage(table.where(is_anchor), "anchors")
    path = scratch_path(spark, "negatives")
    schema = (
        "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    spark.createDataFrame([], schema).write.parquet(path)  # no anchors, no rows
    for group in groups_of(anchors, layout):
        sent = spark.sparkContext.broadcast(group)
        task = _Positives(layout, sent)
        found = first_of(map_partitions(table, task, task.kind), "anchor", POSITIVES)
        # POSITIVES rows at most per anchor of a bounded group come to the driver
        positives = sorted(map(tuple, found.select("anchor", "rank", "score", "id").collect()))
        sent.destroy()
        if not positives:
            continue
        scores = [int(score) for _, _, score, _ in positives]
        lowest, highest = [-(-low * s // 100) for s in scores], [high * s // 100 for s in scores]
        small = all(abs(v) < 2**53 for v in [*lowest, *highest])
        whole = np.int64 if small else object
        owner = np.array([a for a, _, _, _ in positives], np.int64)
        sent = spark.sparkContext.broadcast(
            (group, owner, np.array(lowest, whole), np.array(highest, whole))
        )
        task = _Negatives(layout, sent)
        found = first_of(map_partitions(table, task, task.kind), "slot", NEGATIVES)
        slots = spark.createDataFrame(
            [
                (slot, int(group.ids[a]), int(i), int(rank), score)
                for slot, (a, rank, score, i) in enumerate(positives)
            ],
            "slot int, anchor_id long, positive_id long, positive_rank int,"
            " positive_score decimal(38,0)",
        )
        found.join(F.broadcast(slots), "slot").select(  # as few rows as were collected
            "anchor_id",
            "positive_id",
            "positive_rank",
            "rank",
            F.col("id").alias("negative_id"),
            as_long(F.col("positive_score")).alias("positive_score"),
            as_long(F.col("score")).alias("negative_score"),
        ).write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


def as_long(score: Column) -> Column:
    """The nearest 64-bit number."""
    top, bottom = F.lit(2**63 - 1), F.lit(-(2**63 - 1))
    return F.least(F.greatest(score, bottom), top).cast("long")
